"""Column functions around the small fixed lookup tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions.text import strip

FIXED_ROWS = 200  # a lookup table of this module never grows beyond this


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A constant table as inline VALUES, so that its size is known to the optimizer."""
    if len(rows) > FIXED_ROWS:
        raise ValueError(f"{len(rows)} rows: read a table this large from storage")
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def eli_types(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, ["eli_key", "act_type"], K.pairs(K.ELI_TYPES))


def language_policy(spark: SparkSession) -> DataFrame:
    columns = [
        "policy_key", "source_text_language", "generation_language", "translation_target",
    ]
    return fixed_table(spark, columns, K.pairs(K.LANGUAGE_POLICY))


def jurisdictions(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, ["slug"], [(slug,) for slug in K.JURISDICTIONS])


def map_legal_type(doc_type) -> Column:
    """Act type for the type segment of an address; 'law' for every other segment."""
    c = _col(doc_type)
    mapped = F.when(F.lit(False), None)
    for segment, act_type in K.pairs(K.DOC_TYPES):
        mapped = mapped.when(c == segment, act_type)
    return mapped.otherwise(K.DEFAULT_LEGAL_TYPE)


def normalize_key(c) -> Column:
    """Trimmed lower-case key, '' for null."""
    return F.coalesce(F.lower(strip(c)), F.lit(""))


def normalize_key_list(c) -> Column:
    """As :func:`normalize_key`, for the first element of an array."""
    return normalize_key(F.try_element_at(_col(c), F.lit(1)))


def translation_pair(content_language) -> Column:
    """(source, target) struct for a content language: de to en, everything else en to de."""
    german = normalize_key(content_language) == "de"
    return F.when(
        german, F.struct(F.lit("de").alias("source"), F.lit("en").alias("target"))
    ).otherwise(F.struct(F.lit("en").alias("source"), F.lit("de").alias("target")))
