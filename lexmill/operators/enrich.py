"""Summaries and outcomes of extracted laws."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions.documents import (
    build_legal_act, no_relations, parse_response, prompt, request_json,
)


def is_enrichable() -> Column:
    """Page fetched, law not abrogated, text not empty. Never null.

    Each condition stands for itself, so that those on the page can run before a join.
    """
    return (
        F.col("error_type").isNull()
        & F.coalesce(~F.col("abrogated"), F.lit(False))
        & F.coalesce(F.col("text_content") != "", F.lit(False))
    )


def enrichable(extracted: DataFrame) -> DataFrame:
    return extracted.where(is_enrichable())


def summary_requests(
    extracted: DataFrame,
    text_chars: int | None = K.TEXT_CHARS,
    prompt_chars: int | None = K.PROMPT_TEXT_CHARS,
) -> DataFrame:
    """Requests for the model: ``document_id, prompt, request``, one per enrichable law.

    Only the request is cut, to the lengths of its contract; see :func:`prompt`.
    """
    text = prompt("title", "text_content", text_chars, prompt_chars)
    return enrichable(extracted).select("document_id", text.alias("prompt")).select("document_id", "prompt", request_json(F.col("prompt")).alias("request"))


def summaries(responses: DataFrame) -> DataFrame:
    """One summary per document from ``document_id, response``; unusable ones are left out.

    Several usable responses for a document are reduced to the smallest text, map-side
    first, so the later join cannot multiply rows.
    """
    parsed = responses.select("document_id", parse_response("response").alias("summary"))
    return (
        parsed.where(F.col("summary").isNotNull())
        .groupBy("document_id")
        .agg(F.min("summary").alias("summary"))
    )


def attach_summaries(extracted: DataFrame, responses: DataFrame) -> DataFrame:
    """Add ``summary``; null where no usable response came back."""
    return extracted.join(summaries(responses), "document_id", "left")


def outcomes(extracted: DataFrame) -> DataFrame:
    """Document or error per law, in one pass: the columns of ``OUTCOMES``.

    Needs the columns of an extracted law with ``error_type``, ``message`` and ``summary``.
    """
    failed = F.col("error_type").isNotNull()
    abrogated = F.coalesce(F.col("abrogated"), F.lit(False))
    reason = (
        F.when(failed & (F.col("error_type") == "permanent"), K.PERMANENT)
        .when(failed, K.TRANSIENT)
        .when(abrogated, K.ABROGATED)
    )
    decided = extracted.withColumn("reason", reason)
    is_document = F.col("reason").isNull()
    return decided.select(
        F.when(is_document, "document").otherwise("error").alias("kind"),
        "document_id",
        "reason",
        F.when(failed, F.col("message")).when(abrogated, K.ABROGATED).alias("message"),
        F.when(is_document, build_legal_act()).alias("legal_act"),
        F.when(is_document, no_relations()).alias("legal_act_relations"),
    )


def documents(outcome_rows: DataFrame) -> DataFrame:
    """Only the documents of outcomes."""
    return outcome_rows.where(F.col("kind") == "document").select(
        "legal_act", "legal_act_relations"
    )


def merge_outcomes(*branches: DataFrame) -> DataFrame:
    """Union of outcome branches by name; columns a branch lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def dedup_outcomes(outcome_rows: DataFrame) -> DataFrame:
    """One outcome per document: a document before an error, one with a summary first.

    Needed when an aborted run wrote a document but not its progress, so that the resumed
    run wrote it again. Parse errors have no id and all stay.
    """
    has_id = F.col("document_id").isNotNull()
    rank = F.struct(
        (F.col("kind") == "document").alias("d"),
        F.col("legal_act.summary").isNotNull().alias("s"),
        "reason",
        F.xxhash64("legal_act", "message").alias("t"),
    )
    keep = [c for c in outcome_rows.columns if c != "document_id"]
    single = (
        outcome_rows.where(has_id)
        .groupBy("document_id")
        .agg(F.max_by(F.struct(*keep), rank).alias("_row"))
        .select(*[
            F.col(c) if c == "document_id" else F.col(f"_row.{c}").alias(c)
            for c in outcome_rows.columns
        ])
    )
    return single.unionByName(outcome_rows.where(~has_id))
