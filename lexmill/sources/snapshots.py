"""Snapshots in buckets: a change rewrites the buckets it touches, all others keep their files.

    data/in_batch=N/bucket=K    rows of bucket K as batch N left them
    manifest/batch_id=N         which batch holds the newest files of each bucket

A batch writes its buckets into a folder of its own and then its manifest. Until the manifest is
there readers see the state before, so a lost writer leaves a whole snapshot behind; replacing
the old files in place would delete them before the new ones are moved in. Batch ids rise. A
batch that has a manifest, or follows one that has, was applied: to apply it again does nothing.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.session import run_path
from lexmill.sources.files import rows_or_none

BUCKETS = 64
MANIFEST = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("in_batch", T.LongType()),
    T.StructField("buckets", T.IntegerType()), T.StructField("batch_id", T.LongType()),
])


def bucket_of(key: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifests: ``bucket, in_batch, buckets, batch_id``; bucket -1 is in every one."""
    return rows_or_none(spark, f"{path.rstrip('/')}/manifest", MANIFEST)


def applied_batch(spark: SparkSession, path: str) -> int | None:
    """Number of the batch that was applied last; None for a snapshot without one."""
    return read_manifests(spark, path).agg(F.max("batch_id")).first()[0]  # one number


def _newest_files(spark: SparkSession, path: str, upto: int | None = None) -> tuple[dict[int, int], int | None, int | None]:
    """Batch per bucket, number of buckets and batch id of the newest manifest; a row per bucket at most."""
    manifests = read_manifests(spark, path)
    if upto is not None:
        manifests = manifests.where(F.col("batch_id") <= upto)
    last = manifests.agg(F.max("batch_id")).first()[0]
    if last is None:
        return {}, None, None
    rows = manifests.where(F.col("batch_id") == last).collect()
    return {r.bucket: r.in_batch for r in rows if r.bucket >= 0}, rows[0].buckets, last


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None, only: set[int] | None = None
) -> DataFrame:
    """Rows of the snapshot, with ``bucket`` and ``in_batch``; as of batch ``upto``, or of the buckets ``only``."""
    newest, _, _ = _newest_files(spark, path, upto)
    full = T.StructType(
        schema.fields + [T.StructField("in_batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
    )
    base = f"{path.rstrip('/')}/data"
    paths = [f"{base}/in_batch={n}/bucket={k}" for k, n in newest.items() if only is None or k in only]
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", base).parquet(*paths)


def apply_changes(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    batch_id: int,
    key: tuple[str, ...] = ("document_id",),
    order: tuple[str, ...] = (),
    buckets: int = BUCKETS,
) -> bool:
    """Put the rows of a batch into the snapshot by key; false if the batch was applied before.

    A key's row with the greatest ``order`` stays; on a tie, and without ``order``, a new row
    replaces the old one, and of equal new rows one. Only buckets that hold a changed key are
    read and written: one shuffle by bucket serves the merge and the write. The number of buckets
    is that of the first batch.
    """
    base = path.rstrip("/")
    newest, known, last = _newest_files(spark, base)
    if last is not None and batch_id <= last:
        return False
    buckets = known or buckets
    staged = run_path(spark, "changes")
    changes.withColumn("bucket", bucket_of(key, buckets)).write.parquet(staged)
    schema = changes.schema
    new = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(staged)
    touched = {r.bucket for r in new.select("bucket").distinct().collect()}  # one row per bucket at most
    if touched:
        old = read_snapshot(spark, base, schema, only=touched).drop("in_batch")
        both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        others = [c for c in schema.names if c not in key]
        rank = F.struct(*order, "_new", F.xxhash64(*others) if others else F.lit(0))
        payload = F.struct(*(others or ["_new"]))
        merged = (
            both.repartition("bucket")
            .groupBy("bucket", *key)
            .agg(F.max_by(payload, rank).alias("_row"))
            .select("bucket", *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in schema.names])
        )
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/data/in_batch={batch_id}")
    files = {**newest, **dict.fromkeys(touched, batch_id)}
    rows = [(-1, batch_id, buckets), *((k, n, buckets) for k, n in sorted(files.items()))]
    manifest = spark.createDataFrame(rows, T.StructType(MANIFEST.fields[:3]))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/batch_id={batch_id}")
    return True


def snapshot_writer(
    path: str, key: tuple[str, ...] = ("document_id",), order: tuple[str, ...] = (), buckets: int = BUCKETS
):
    """What a stream calls for each batch; a batch that comes again is a no-op."""

    def write(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch.sparkSession, path, batch, batch_id, key, order, buckets)

    return write


def compact_snapshot(spark: SparkSession, path: str, to: str, schema: T.StructType) -> None:
    """The snapshot as it is, in a new folder without older files. The number of buckets and the
    batch id go along, so a stream can go on there."""
    newest, buckets, last = _newest_files(spark, path)
    if last is None:
        return
    base = to.rstrip("/")
    rows = read_snapshot(spark, path, schema).drop("in_batch")
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/data/in_batch={last}")
    manifest = [(-1, last, buckets), *((k, last, buckets) for k in sorted(newest))]
    spark.createDataFrame(manifest, T.StructType(MANIFEST.fields[:3])).coalesce(1).write.mode("overwrite").parquet(
        f"{base}/manifest/batch_id={last}"
    )
