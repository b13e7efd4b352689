"""Relational form of nested documents, and back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill import schemas as S

TEXT_FIELDS = ["url", "title", "title_short", "summary", "abbreviation"]


def split_act_text(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Act table, and text table per language: two projections without a shuffle."""
    act_fields = [f.name for f in S.LEGAL_ACT if f.name not in TEXT_FIELDS + ["language"]]
    acts = documents.select(*[F.col(f"legal_act.{name}") for name in act_fields])
    texts = documents.select(
        *[F.col(f"legal_act.{name}") for name in ["document_id", "language"] + TEXT_FIELDS]
    )
    return acts, texts


def flatten_relations(documents: DataFrame) -> DataFrame:
    """One row per relation and section. No sections: the whole document is affected."""
    relations = documents.select(F.inline("legal_act_relations"))
    return relations.select(
        "source_document_id",
        "target_document_id",
        "relation_type",
        F.explode_outer("concerned_sections").alias("_section"),
    ).select(
        "source_document_id",
        "target_document_id",
        "relation_type",
        F.col("_section.subdivision_concerned").alias("subdivision_concerned"),
        F.col("_section.comment").alias("comment"),
        F.col("_section").isNull().alias("whole_document"),
    )


def nest_documents(acts: DataFrame, relations: DataFrame, parts: int) -> DataFrame:
    """Documents ``part, legal_act, legal_act_relations`` from acts and flat relations.

    ``acts`` has ``legal_act``; ``relations`` the form of :func:`flatten_relations`. The grain is
    (document, part) for every document, whatever its size: its relation rows are dealt to
    ``parts`` parts by a hash of the row, so a document with very many relations is not
    gathered in one place. Part 0 is always there, other parts where they have relations. Equal
    rows stay as many as they are. Choose ``parts`` by the largest document; 1 gives one row
    per document.

    One scan, and one shuffle by document and part that both groupings and the join share.
    """
    names = ["source_document_id", "target_document_id", "relation_type"]
    content = names + ["subdivision_concerned", "comment", "whole_document"]
    share = F.pmod(F.xxhash64(*content), F.lit(parts)).cast("int")
    section = F.when(~F.col("whole_document"), F.struct("subdivision_concerned", "comment"))
    grouped = (
        relations.select(*content, share.alias("part"))
        .repartition("source_document_id", "part")
        .groupBy(*names, "whole_document", "part")
        .agg(F.sort_array(F.collect_list(section)).alias("_sections"), F.count(F.lit(1)).alias("_n"))
    )
    concerned = F.when(~F.col("whole_document"), F.col("_sections"))
    relation = F.struct(*names, concerned.alias("concerned_sections"))
    # a relation with the whole document has no sections; it is listed as often as it was given
    times = F.when(F.col("whole_document"), F.col("_n")).otherwise(1).cast("int")
    nested = (
        grouped.select("source_document_id", "part", F.array_repeat(relation, times).alias("_same"))
        .groupBy("source_document_id", "part")
        .agg(F.sort_array(F.flatten(F.collect_list("_same"))).alias("_list"))
    )
    places = acts.select("legal_act", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_place"))
    joined = places.join(
        nested,
        (F.col("legal_act.document_id") == F.col("source_document_id")) & (F.col("_place") == F.col("part")),
        "left",
    ).where((F.col("_place") == 0) | F.col("_list").isNotNull())
    return joined.select(
        F.col("_place").cast("int").alias("part"),
        "legal_act",
        F.coalesce(F.col("_list"), F.array().cast(S.RELATIONS)).alias("legal_act_relations"),
    )
