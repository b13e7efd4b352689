"""Which version of a law counts: filters, latest version, order and history."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill import constants as K

SEEN = ("page", "pos")
KEY = ("document_id",)


def first_seen_key(place: str) -> Column:
    """Rank by which the smaller place is the greater, as a last key of an order."""
    return -F.col(place)


def drop_future(entries: DataFrame, today: str) -> DataFrame:
    """Drop versions that start after ``today``; ISO strings compare as text."""
    return entries.where(F.col("entry_date") <= F.lit(today))


def changed_since(
    entries: DataFrame, last_run: str | Column, buffer_days: int = K.LATE_BUFFER_DAYS
) -> DataFrame:
    """Entries whose ``lastmod`` day is at most ``buffer_days`` before ``last_run``, or later.

    ``lastmod`` is cut to its day. Entries without one are dropped.
    """
    last = F.lit(last_run) if isinstance(last_run, str) else last_run
    cutoff = F.date_sub(last.cast("date"), buffer_days).cast("string")
    day = F.substring("lastmod", 1, 10)
    return entries.withColumn("lastmod", day).where(F.col("lastmod") >= cutoff)


def resume(entries: DataFrame, processed: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Drop entries whose key was processed before.

    The key of this join is also the key of :func:`latest_version`, so both orders give the
    same rows. Run it after the aggregation: one row per key is left then, it is already
    partitioned by the key, and no key is hot.
    """
    return entries.join(processed.select(*key), list(key), "left_anti")


def latest_version(
    entries: DataFrame,
    key: tuple[str, ...] = KEY,
    order: tuple[str, ...] = ("entry_date",),
    seen: tuple[str, ...] = SEEN,
    first_seen: bool = False,
) -> DataFrame:
    """Per key the row with the greatest ``order``; on a tie the one seen first.

    One aggregation with map-side combine: a key that holds a large share of all rows
    leaves every map task as one row. ``first_seen=True`` adds ``first_<seen>``, the place
    where the key turned up first, from the same aggregation.
    """
    rank = F.struct(*order, *[(-F.col(c)).alias(c) for c in seen])
    payload = F.struct(*[c for c in entries.columns if c not in key])
    aggregates = [F.max_by(payload, rank).alias("_row")]
    if first_seen:
        aggregates.append(F.min(F.struct(*seen)).alias("_first"))
    grouped = entries.groupBy(*key).agg(*aggregates)
    columns = [
        F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in entries.columns
    ]
    if first_seen:
        columns += [F.col(f"_first.{c}").alias(f"first_{c}") for c in seen]
    return grouped.select(*columns)


def rank_versions(
    entries: DataFrame, keep: int | None = 1, key: tuple[str, ...] = KEY,
    order: tuple[str, ...] = ("entry_date",), seen: tuple[str, ...] = SEEN,
) -> DataFrame:
    """``version_rank`` within the key, newest first, for ranks up to ``keep``.

    With ``keep`` Spark cuts each map task's groups to that many rows before the shuffle.
    ``keep=None`` ranks everything; then first reduce the rows, as :func:`version_history`
    does, if one key may be hot.
    """
    window = W.partitionBy(*key).orderBy(*[F.desc(c) for c in order], *seen)
    ranked = entries.withColumn("version_rank", F.row_number().over(window))
    return ranked if keep is None else ranked.where(F.col("version_rank") <= keep)


def sample_laws(entries: DataFrame, n: int = 0) -> DataFrame:
    """Current versions of the first ``n`` laws in order of appearance; 0 means all."""
    laws = latest_version(entries, first_seen=True)
    ordered = laws.orderBy("first_page", "first_pos")
    return ordered.limit(n) if n else ordered


def widening_range(pages: DataFrame, n: int, entries_of, growth: int = 4) -> int | None:
    """Number of the last sitemap page that has to be read until ``n`` laws are known.

    Pages are read in ranges that grow, each from the first page on and pruned at the scan, so what
    is read in all is a constant factor more than that page needs. None if all pages hold fewer.
    """
    ends = pages.agg(F.min("page").alias("low"), F.max("page").alias("high")).first()  # from the page numbers alone
    if ends["low"] is None:
        return None
    width = n
    while True:
        top = ends["low"] + width - 1
        laws = entries_of(pages.where(F.col("page") <= top)).groupBy(*KEY).agg(F.min(F.struct(*SEEN)).alias("_first"))
        first = laws.orderBy("_first").limit(n).agg(F.count(F.lit(1)).alias("laws"), F.max("_first.page").alias("page")).first()
        if first["laws"] >= n:
            return first["page"]
        if top >= ends["high"]:
            return None
        width *= growth


def version_history(entries: DataFrame) -> DataFrame:
    """All versions with validity ``[valid_from, valid_to)``; ``valid_to`` null for the last.

    Versions with the same start are first reduced to the one seen first, with map-side
    combine. What is left per law is at most one row per calendar day, so the window's
    groups are bounded however many entries a law has.
    """
    versions = latest_version(entries, key=("document_id", "entry_date"), order=())
    window = W.partitionBy("document_id").orderBy("entry_date")
    return versions.select(
        "*",
        F.col("entry_date").alias("valid_from"),
        F.lead("entry_date").over(window).alias("valid_to"),
        F.lit("consolidated_act").alias("entity_type"),
    )


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without a second pass; read ``observation.get['rows']``."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


class RowCounts:
    """Counts of rows by name, taken as a run's own writes pull the rows through."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[DataFrame, Observation]] = {}

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        counted, observation = observe_counts(df, name)
        self._seen[name] = (df, observation)
        return counted

    def get(self) -> dict[str, int]:
        """The counts, after the write. Where adaptive execution cut an empty stage out of the plan,
        and its counts with it, the rows are counted on their own."""
        found = {}
        for name, (df, observation) in self._seen.items():
            try:
                found[name] = observation.get["rows"]
            except (Py4JJavaError, PySparkException):
                found[name] = df.count()
        return found


def uncounted(df: DataFrame, name: str) -> DataFrame:
    return df
