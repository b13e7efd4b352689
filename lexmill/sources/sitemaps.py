"""Sitemap XML to entries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill.functions.text import (
    compute_once, ddmmyyyy_to_iso, falsy_to_null, law_path, parse_law_path, strip,
)


def count_sitemaps(index_xml, default: int = K.DEFAULT_SITEMAPS) -> Column:
    """Number of sitemaps an index lists; the default if it is missing or lists none."""
    found = F.regexp_count(index_xml, F.lit("<sitemap>"))
    return F.coalesce(F.nullif(found, F.lit(0)), F.lit(default))


def _blocks(pages: DataFrame) -> DataFrame:
    """``page, pos, block``: the text of each ``<url>`` block."""
    blocks = F.regexp_extract_all("xml", F.lit(K.URL_BLOCK), F.lit(1))
    return pages.select("page", F.posexplode(blocks).alias("pos", "block"))


def _loc() -> Column:
    return strip(F.regexp_extract("block", K.LOC, 1))


def _lastmod() -> Column:
    return strip(F.regexp_extract("block", K.LASTMOD, 1))


def explode_sitemap(pages: DataFrame) -> DataFrame:
    """One row per ``<url>`` block with a location: ``page, pos, loc, lastmod``.

    ``pos`` is the place of the block in its page, so it does not depend on partitioning.
    """
    return (
        compute_once(_blocks(pages), loc=_loc(), _lastmod=_lastmod())
        .where(F.col("loc") != "")
        .select("page", "pos", "loc", falsy_to_null("_lastmod").alias("lastmod"))
    )


def keep_law_urls(entries: DataFrame) -> DataFrame:
    """Only entries whose location is a law address."""
    loc = F.col("loc")
    # the substring test is cheap and spares most other addresses the regex
    return entries.where(loc.contains(K.LAW_PATH) & (law_path(loc) != ""))


def law_entries(pages: DataFrame) -> DataFrame:
    """Entries of law versions: sitemap position, address parts, entry date and slug.

    A block without the law path has no law address; it is left out before any field is taken.
    """
    near = _blocks(pages).where(F.col("block").contains(K.LAW_PATH))
    located = compute_once(near, url=_loc(), _lastmod=_lastmod())
    laws = compute_once(located, _path=law_path("url")).where(F.col("_path") != "")
    parsed = laws.select(
        "page", "pos", "url", falsy_to_null("_lastmod").alias("lastmod"),
        *[c.alias(name) for name, c in parse_law_path("_path").items()],
    )
    return parsed.select(
        "*",
        ddmmyyyy_to_iso("date_str").alias("entry_date"),
        F.col("slug").alias("document_id"),
    )


def read_sitemap_xml(spark, path: str) -> DataFrame:
    """Alternate scan with Spark's XML source: ``loc, lastmod``, without positions.

    Use it where the tie between equal dates of a slug does not matter.
    """
    return (
        spark.read.schema("loc STRING, lastmod STRING")
        .option("rowTag", "url")
        .format("xml")
        .load(path)
        .select(strip("loc").alias("loc"), strip("lastmod").alias("lastmod"))
        .where("loc is not null")
    )
