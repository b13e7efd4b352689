"""Structured Streaming forms of the runs. Every job works off what is there and stops."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexmill import constants as K
from lexmill.operators.reports import error_rate
from lexmill.operators.versions import latest_version
from lexmill.sources.files import rows_or_none

BATCH = "batch_id"
PUBLISHED = T.StructType([T.StructField(c, T.LongType()) for c in ("rows", "errors", BATCH)])


class BatchRejected(RuntimeError):
    """A batch had too many errors; its offsets are not committed."""


def ingest_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files under ``path`` as a stream; new files since the last start come in."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_late_buffer(
    stream: DataFrame, ts: str = "lastmod", delay: str = f"{K.LATE_BUFFER_DAYS} days"
) -> DataFrame:
    """Accept rows up to ``delay`` behind the newest. For change feeds, not for backfills."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedup_stream(
    stream: DataFrame, keys: tuple[str, ...] = ("document_id", "entry_date", "lastmod")
) -> DataFrame:
    """Drop repeated deliveries within the late buffer.

    ``lastmod`` is a key, so a corrected text of the same version comes through.
    """
    return stream.dropDuplicatesWithinWatermark(list(keys))


def error_rate_windows(stream: DataFrame, ts: str, failed, width: str = "1 day") -> DataFrame:
    """Rows fetched and failed per tumbling window, with map-side partial counts."""
    return stream.groupBy(F.window(ts, width).alias("window")).agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(failed).alias("errors")
    )


def guarded_batch(batch: DataFrame, batch_id: int, limit: float = K.COMMIT_ERROR_RATE) -> tuple[int, int]:
    """Rows and errors of a batch; raises if their rate reaches ``limit``. Call it before it is published.

    The query then fails, and its next start replays the same batch.
    """
    row = batch.agg(
        F.count_if(F.col("kind") != "document").alias("errors"),
        F.count(F.lit(1)).alias("fetched"),
    ).select("errors", "fetched", error_rate().alias("rate")).first()
    if row["rate"] >= limit:
        raise BatchRejected(f"batch {batch_id}: {row['errors']} of {row['fetched']} failed")
    return row["fetched"], row["errors"]


def each_batch(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], output_mode: str = "append"
) -> StreamingQuery:
    """Work off the stream and call ``write(batch, batch_id)`` for each batch."""
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batches(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    guard: float | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Work off the stream; each batch goes to its own folder ``batch_id=N`` under ``out``.

    A replayed batch overwrites its own folder, so every row is stored once. With ``guard``
    the transformed batch must have outcome rows. It is written once, below ``out/data``, and checked
    there; only then is it named in the manifest below ``out/published``. Readers go by the manifest
    (:func:`read_published`), so a rejected batch is never seen; a listed one is not written again.
    """
    base = out.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, name = transform(batch), f"{BATCH}={batch_id}"
        if guard is None:
            rows.write.mode("overwrite").parquet(f"{base}/{name}")
            return
        spark = batch.sparkSession
        if not read_manifest(spark, base).where(F.col(BATCH) == batch_id).isEmpty():
            return
        rows.write.mode("overwrite").parquet(f"{base}/data/{name}")
        stored = spark.read.schema(rows.schema).parquet(f"{base}/data/{name}")
        fetched, errors = guarded_batch(stored, batch_id, guard)
        listed = spark.range(1).select(F.lit(fetched).alias("rows"), F.lit(errors).alias("errors"))
        listed.coalesce(1).write.mode("overwrite").parquet(f"{base}/published/{name}")

    return each_batch(stream, checkpoint, write, output_mode)


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """``rows, errors, batch_id`` of each batch that a guarded stream published."""
    return rows_or_none(spark, f"{out.rstrip('/')}/published", PUBLISHED)


def read_published(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Rows of all published batches, with ``batch_id``; the manifest has a row per batch."""
    base = f"{out.rstrip('/')}/data"
    full = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])
    listed = [f"{base}/{BATCH}={r[BATCH]}" for r in read_manifest(spark, out).select(BATCH).collect()]
    if not listed:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", base).parquet(*listed)


def read_batches(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """All batches written so far, with ``batch_id``."""
    full = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).option("basePath", out).parquet(out)


def latest_stream(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    key: tuple[str, ...] = ("document_id",),
    order: tuple[str, ...] = ("entry_date", "lastmod"),
    seen: tuple[str, ...] = ("page", "pos"),
) -> StreamingQuery:
    """Keep each batch's latest version per key in a change log.

    A batch costs only its own rows; the state is merged on read, by :func:`latest_state`.
    """
    return write_batches(
        stream, out, checkpoint, lambda batch: latest_version(batch, key, order, seen)
    )


def latest_state(
    changes: DataFrame,
    key: tuple[str, ...] = ("document_id",),
    order: tuple[str, ...] = ("entry_date", "lastmod"),
    seen: tuple[str, ...] = (BATCH, "page", "pos"),
) -> DataFrame:
    """Latest version per key over all batches of a change log."""
    return latest_version(changes, key, order, seen).drop(BATCH)


def compact_latest(spark: SparkSession, out: str, snapshots: str, schema: T.StructType) -> None:
    """Merge a change log into a new snapshot ``upto=N``; later reads need no older batch.

    Run it between starts of the stream, every so many batches. Older snapshots and the log
    stay, so a lost writer loses nothing.
    """
    log = read_batches(spark, out, schema)
    upto = log.agg(F.max(BATCH)).first()[0]  # one number
    if upto is not None:
        state = latest_state(_since_snapshot(spark, log, snapshots, schema))
        state.write.mode("overwrite").parquet(f"{snapshots.rstrip('/')}/upto={upto}")


def read_latest(spark: SparkSession, out: str, snapshots: str, schema: T.StructType) -> DataFrame:
    """State of a change log: its newest snapshot and the batches after it."""
    return latest_state(_since_snapshot(spark, read_batches(spark, out, schema), snapshots, schema))


def _since_snapshot(
    spark: SparkSession, log: DataFrame, snapshots: str, schema: T.StructType
) -> DataFrame:
    full = T.StructType(schema.fields + [T.StructField("upto", T.LongType())])
    try:
        stored = spark.read.schema(full).parquet(snapshots)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return log
    upto = stored.agg(F.max("upto")).first()[0]  # one number
    if upto is None:
        return log
    # rows of a snapshot count as seen before those of any later batch
    old = stored.where(F.col("upto") == upto).drop("upto").withColumn(BATCH, F.lit(-1).cast("long"))
    return old.unionByName(log.where(F.col(BATCH) > upto))


def latest_update(changes: DataFrame, key: str) -> DataFrame:
    """Last state of each key of an update-mode result."""
    values = [c for c in changes.columns if c not in (key, BATCH)]
    grouped = changes.groupBy(key).agg(F.max_by(F.struct(*values), BATCH).alias("_row"))
    return grouped.select(key, *[F.col(f"_row.{c}").alias(c) for c in values])
