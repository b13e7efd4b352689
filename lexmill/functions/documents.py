"""Column functions that build documents, summary requests and summaries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill import schemas as S
from lexmill.functions.text import falsy_to_null, strip


def build_legal_act() -> Column:
    """``legal_act`` struct from the columns of an extracted law."""
    url = falsy_to_null("url")
    abbreviation = falsy_to_null("abbreviation")
    values = {
        "document_id": F.col("document_id"),
        "jurisdiction": F.lit(K.JURISDICTION),
        "entity_type": F.lit(K.ENTITY_TYPE),
        "is_in_force": F.lit(True),
        "language": F.lit(K.LANGUAGE),
        "url": url,
        "canonical_source_url": url,
        "title": falsy_to_null("title"),
        "title_short": abbreviation,
        "abbreviation": abbreviation,
        "type": falsy_to_null("legal_type"),
        "summary": falsy_to_null("summary"),
        "entry_into_force_date": falsy_to_null("entry_date"),
        "enactment_date": falsy_to_null("enactment_date"),
        "last_amendment_date": falsy_to_null("last_amendment_date"),
        "publication_date": falsy_to_null("publication_date"),
    }
    return F.struct(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in S.LEGAL_ACT
        ]
    )


def no_relations() -> Column:
    return F.array().cast(S.RELATIONS)


def prompt(
    title, text, text_chars: int | None = K.TEXT_CHARS, prompt_chars: int | None = K.PROMPT_TEXT_CHARS
) -> Column:
    """User text of a summary request.

    The request's contract takes the first ``text_chars`` of a text, and ``prompt_chars`` at
    most of whatever stands for it. Stored texts are whole; None sends them whole.
    """
    kept = falsy_to_null(text)
    if text_chars is not None:
        kept = F.substring(kept, 1, text_chars)
    kept = F.coalesce(kept, F.lit(K.NO_TEXT))
    if prompt_chars is not None:
        kept = F.substring(kept, 1, prompt_chars)
    return F.concat(
        F.lit("Titel: "),
        F.coalesce(falsy_to_null(title), F.lit(K.NO_TITLE)),
        F.lit("\n\nText:\n"),
        kept,
    )


def request_json(prompt_text: Column) -> Column:
    """Body of a summary request as JSON."""

    def parts(text: Column) -> Column:
        return F.struct(F.array(F.struct(text.alias("text"))).alias("parts"))

    return F.to_json(
        F.struct(
            parts(F.lit(K.SYSTEM_INSTRUCTION)).alias("system_instruction"),
            F.array(parts(prompt_text)).alias("contents"),
            F.struct(
                F.lit(K.MAX_OUTPUT_TOKENS).alias("maxOutputTokens"),
                F.lit(K.TEMPERATURE).alias("temperature"),
            ).alias("generationConfig"),
        )
    )


def parse_response(response) -> Column:
    """Summary text of a response; null if it is blank, missing or not JSON."""
    body = F.try_parse_json(F.col(response) if isinstance(response, str) else response)
    return falsy_to_null(strip(F.try_variant_get(body, K.SUMMARY_PATH, "string")))
