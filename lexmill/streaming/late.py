"""Late rows of a stream: kept apart and counted, where Spark's own watermark drops them unseen.

A batch's watermark is the newest time of all batches before it, less the delay. It is worked out
from a stored mark per batch, so a restart or a replay of a batch comes to the same decision.
Everything is stored below one folder:

    rows/batch_id=N/late=false|true    the batch, each row once
    marks/batch_id=N                   its newest time, its watermark, its numbers of rows
    rates/batch_id=N, alerts/batch_id=N    counts per window, alerts of closed windows
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexmill import constants as K
from lexmill.operators.reports import alerts as report_alerts
from lexmill.sources.files import rows_or_none
from lexmill.streaming.jobs import each_batch

BATCH = "batch_id"
DELAY = f"{K.LATE_BUFFER_DAYS} days"

MARKS = T.StructType([
    T.StructField("newest", T.TimestampType()), T.StructField("watermark", T.TimestampType()),
    T.StructField("rows", T.LongType()), T.StructField("late", T.LongType()),
    T.StructField(BATCH, T.LongType()),
])
WINDOW = T.StructType([T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType())])
RATES = T.StructType(
    [T.StructField("window", WINDOW)]
    + [T.StructField(c, T.LongType()) for c in ("fetched", "errors", "late", BATCH)]
)
ALERTS = T.StructType([
    T.StructField("alert", T.StringType()), T.StructField("runId", T.StringType()),
    T.StructField("errors", T.LongType()), T.StructField("fetched", T.LongType()),
    T.StructField("error_rate", T.StringType()), T.StructField(BATCH, T.LongType()),
])


def read_marks(spark: SparkSession, out: str) -> DataFrame:
    """``newest, watermark, rows, late`` of each batch written so far."""
    return rows_or_none(spark, f"{out.rstrip('/')}/marks", MARKS)


def read_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """All stored rows with ``batch_id`` and ``late``; a filter on them reads those folders only."""
    full = T.StructType(
        schema.fields + [T.StructField(BATCH, T.LongType()), T.StructField("late", T.BooleanType())]
    )
    return rows_or_none(spark, f"{out.rstrip('/')}/rows", full)


def watermark_before(spark: SparkSession, out: str, batch_id: int, delay: str):
    """Newest time of the batches before ``batch_id``, less ``delay``; None for the first."""
    newest = read_marks(spark, out).where(F.col(BATCH) < batch_id).agg(F.max("newest").alias("t"))
    return newest.select((F.col("t") - F.expr(f"INTERVAL {delay}")).alias("t")).first()["t"]  # one number


def split_batch(
    batch: DataFrame, batch_id: int, out: str, ts: str, delay: str
) -> DataFrame:
    """Store a batch once, its late rows apart, and its mark; returns the stored rows.

    A row is late if its time is before the batch's watermark. A row without a time can't be placed
    and counts as late. A replayed batch overwrites its own folders with the same rows.
    """
    spark, base = batch.sparkSession, out.rstrip("/")
    mark = watermark_before(spark, base, batch_id, delay)
    time = F.col(ts).cast("timestamp")
    late = time.isNull() if mark is None else time.isNull() | (time < F.lit(mark))
    path = f"{base}/rows/{BATCH}={batch_id}"
    batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(path)
    schema = T.StructType([*batch.schema.fields, T.StructField("late", T.BooleanType())])
    # counted from what is stored, so a stage that ran twice counts once
    stored = rows_or_none(spark, path, schema)
    counts = stored.agg(
        F.max(time).alias("newest"), F.lit(mark).cast("timestamp").alias("watermark"),
        F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late"),
    )
    counts.coalesce(1).write.mode("overwrite").parquet(f"{base}/marks/{BATCH}={batch_id}")
    return stored


def split_stream(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    ts: str = "lastmod",
    delay: str = DELAY,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    then: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Work off the stream: rows in time and late rows are stored apart, every row once.

    ``then`` gets the rows in time of each batch, as stored, for instance to put them into a
    snapshot. Kept and late rows of all batches together are the input.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = split_batch(transform(batch), batch_id, out, ts, delay)
        if then is not None:
            then(stored.where(~F.col("late")).drop("late"), batch_id)

    return each_batch(stream, checkpoint, write)


def window_counts(rows: DataFrame, ts: str, failed: Column, width: str) -> DataFrame:
    """``window, fetched, errors, late`` of stored rows; late rows count in ``late`` only."""
    in_time = ~F.col("late")
    return (
        rows.where(F.col(ts).isNotNull())
        .groupBy(F.window(F.col(ts).cast("timestamp"), width).alias("window"))
        .agg(
            F.count_if(in_time).alias("fetched"), F.count_if(in_time & failed).alias("errors"),
            F.count_if("late").alias("late"),
        )
    )


def read_rates(spark: SparkSession, out: str, delay: str = DELAY) -> DataFrame:
    """``window, fetched, errors, late, closed`` over all batches.

    A window is closed once the next batch's watermark has passed its end: rows in time can't
    change it any more.
    """
    base = out.rstrip("/")
    totals = rows_or_none(spark, f"{base}/rates", RATES).groupBy("window").agg(
        *[F.sum(c).alias(c) for c in ("fetched", "errors", "late")]
    )
    newest = read_marks(spark, base).agg(F.max("newest").alias("t"))
    mark = newest.select((F.col("t") - F.expr(f"INTERVAL {delay}")).alias("t")).first()["t"]  # one number
    closed = F.lit(False) if mark is None else F.col("window.end") <= F.lit(mark)
    return totals.withColumn("closed", closed)


def read_alerts(spark: SparkSession, out: str) -> DataFrame:
    """Stored alerts of closed windows: ``alert, runId, errors, fetched, error_rate``."""
    return rows_or_none(spark, f"{out.rstrip('/')}/alerts", ALERTS)


def watch_error_rate(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    ts: str,
    failed: Column,
    width: str = "1 day",
    delay: str = DELAY,
    limit: float = K.ALERT_ERROR_RATE,
) -> StreamingQuery:
    """Error rate per window, with late rows counted and alerts written.

    A batch stores its own counts per window; they are added up on read, so no state grows and a
    replay changes nothing. The alert of a window is written once, by the batch that closes it, if
    more than ``limit`` of its rows in time failed; its ``runId`` is the window's start.
    """
    base = out.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = split_batch(batch, batch_id, base, ts, delay)
        window_counts(stored, ts, failed, width).write.mode("overwrite").parquet(f"{base}/rates/{BATCH}={batch_id}")
        before = watermark_before(spark, base, batch_id, delay)
        after = watermark_before(spark, base, batch_id + 1, delay)
        end = F.col("window.end")
        open_before = F.lit(True) if before is None else end > F.lit(before)
        closing = F.lit(False) if after is None else end <= F.lit(after)
        counted = rows_or_none(spark, f"{base}/rates", RATES).where((F.col(BATCH) <= batch_id) & open_before & closing)
        sums = counted.groupBy(F.date_format("window.start", "yyyy-MM-dd'T'HH:mm:ss").alias("runId")).agg(
            F.sum("fetched").alias("fetched"), F.sum("errors").alias("errors")
        )
        report_alerts(sums, limit).coalesce(1).write.mode("overwrite").parquet(f"{base}/alerts/{BATCH}={batch_id}")

    return each_batch(stream, checkpoint, write)
