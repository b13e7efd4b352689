"""Lookup joins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions.lookups import (
    eli_types, language_policy, normalize_key, normalize_key_list,
)
from lexmill.functions.text import falsy_to_null


def lookup(
    df: DataFrame, dim: DataFrame, key: Column, dim_key: str, defaults: dict[str, str | None],
    fixed: bool = False,
) -> DataFrame:
    """Left join that adds the columns of ``defaults``, with the default where no key fits.

    ``dim`` must hold each key once. ``fixed`` marks the constant tables of this package,
    which are broadcast. Any other table is left to the optimizer: it broadcasts only below
    its size threshold and otherwise sort-merges, where adaptive execution splits hot keys
    of ``df``.
    """
    dim = dim.select(F.col(dim_key).alias("_dim_key"), *defaults)
    joined = df.withColumn("_key", key).join(
        F.broadcast(dim) if fixed else dim, F.col("_key") == F.col("_dim_key"), "left"
    )
    added = [F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in defaults.items()]
    return joined.select(*df.columns, *added)


def act_type_from_eli(df: DataFrame, column: str = "eli_type") -> DataFrame:
    """Add ``act_type``: null for a blank ELI type, 'other' for an unknown one."""
    key = normalize_key(column)
    blank = F.coalesce(falsy_to_null(column), F.lit("")) == ""
    found = lookup(
        df, eli_types(df.sparkSession), key, "eli_key", {"act_type": K.DEFAULT_ACT_TYPE},
        fixed=True,
    )
    return found.withColumn("act_type", F.when(~blank, F.col("act_type")))


def jurisdiction_languages(
    df: DataFrame, column: str = "jurisdiction", is_list: bool = False
) -> DataFrame:
    """Add the language policy of a jurisdiction, or of the first one of a list.

    Content language is the generation language; the translation pair runs from it to the
    translation target.
    """
    key = normalize_key_list(column) if is_list else normalize_key(column)
    source, generation, target = K.DEFAULT_LANGUAGES
    found = lookup(
        df, language_policy(df.sparkSession), key, "policy_key",
        {
            "source_text_language": source,
            "generation_language": generation,
            "translation_target": target,
        },
        fixed=True,
    )
    return found.withColumns(
        {
            "content_language": F.col("generation_language"),
            "pair_source": F.col("generation_language"),
            "pair_target": F.col("translation_target"),
        }
    )


def in_set(column: str, allowed: list[str]) -> Column:
    """Membership in a closed set; false for null."""
    return F.coalesce(F.col(column).isin(allowed), F.lit(False))


def fill_publication_date(extracted: DataFrame, issues: DataFrame) -> DataFrame:
    """Publication date from the page, else from the gazette issue it cites.

    ``issues`` has ``year, number, first_page, last_page, issue_date``. A page cites a year and an
    issue number (``Nr.``), or a year and a page (``S.``); a page belongs to the issue whose
    range holds it, of several to the earliest. Rows that need no lookup get a key of their own instead of null, so that a sort-merge
    join spreads them and does not put them all in one partition.
    """
    needed = F.col("publication_date").isNull() & F.col("issue_year").isNotNull()
    key = (
        F.when(needed & F.col("issue_number").isNotNull(), F.concat_ws("/", "issue_year", "issue_number"))
        .when(needed & F.col("issue_page").isNotNull(), F.concat_ws("/S/", "issue_year", "issue_page"))
        .otherwise(F.concat(F.lit("none/"), F.xxhash64("document_id")))
    )
    # an issue has a bounded number of pages; each is a key of its own, so both forms are one equi-join
    numbers = issues.select(F.concat_ws("/", "year", "number").alias("issue"), "issue_date")
    paged = issues.where("first_page <= last_page").select(
        "year", F.explode(F.sequence("first_page", "last_page")).alias("_page"), "issue_date"
    )
    by_page = paged.select(F.concat_ws("/S/", "year", "_page").alias("issue"), "issue_date")
    dim = numbers.unionByName(by_page).groupBy("issue").agg(F.min("issue_date").alias("issue_date"))
    found = lookup(extracted, dim, key, "issue", {"issue_date": None})
    return found.withColumn(
        "publication_date", F.coalesce("publication_date", "issue_date")
    ).drop("issue_date")
