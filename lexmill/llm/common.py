"""Shared helpers: tables, word splitting, batches of whole texts, stored intermediates."""

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import run_path

SPACES = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` parts at exactly these bytes."""
    return (text or "").encode("utf-8", "replace").split()


_ALNUM = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def alnum_words(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters as UTF-8, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").translate(_ALNUM).split()


def held_out(doc_id: str, folds: int, fold: int):
    """True where crc32 of the id as text leaves ``fold`` modulo ``folds``; null id: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def sized(items: Iterable, size, limit: int = BATCH_BYTES) -> Iterator[list]:
    """Consecutive items in lists of about ``limit`` bytes; a larger item comes alone."""
    group, total = [], 0
    for item in items:
        n = size(item)
        if group and total + n > limit:
            yield group
            group, total = [], 0
        group.append(item)
        total += n
    if group:
        yield group


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of links ``a, b`` (long): ``node, root`` with root the smallest node.

    Alternates large-star and small-star steps. Every step is an aggregation with map-side
    combine and a join whose one side has a row per node, so a hub is never gathered. Only
    nodes that have a link to another node come out. Each round is stored.
    """
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    links = stored(links.distinct(), name)
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        links = stored(small, name)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
