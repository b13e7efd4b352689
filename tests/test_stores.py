"""Late rows and bucketed snapshots, batch by batch."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators import snapshots as U
from lexmill.sources import snapshots as S
from lexmill.streaming import jobs, late

TIMED = "id INT, ts TIMESTAMP, ok BOOLEAN"
DOCS = "document_id STRING, version INT"


def at(day, hour=0):
    return dt.datetime(2026, 4, day, hour) if day else None


def timed(spark, *data):
    return spark.createDataFrame([(i, at(d, h), ok) for i, d, h, ok in data], TIMED)


class Feed:
    """A folder that a stream reads; every ``more`` adds a file and works it off."""

    def __init__(self, spark, path, run):
        self.spark, self.path, self.run = spark, str(path / "in"), run

    def more(self, frame):
        frame.coalesce(1).write.mode("append").parquet(self.path)
        self.run(jobs.ingest_stream(self.spark, self.path, frame.schema)).awaitTermination()


def test_late_rows_are_kept_apart_and_counted(spark, tmp_path):
    out = str(tmp_path / "out")
    feed = Feed(spark, tmp_path, lambda s: late.split_stream(s, out, str(tmp_path / "check"), "ts"))
    feed.more(timed(spark, (1, 10, 0, True), (2, 1, 0, True), (3, None, 0, True)))
    # two days behind the newest is in time, a moment more is late
    feed.more(timed(spark, (4, 8, 0, True), (5, 7, 23, True), (6, 20, 0, True)))
    feed.more(timed(spark, (7, 17, 0, True), (8, 19, 0, True)))
    stored = late.read_rows(spark, out, spark.createDataFrame([], TIMED).schema)
    assert rows(stored, "id", "late", "batch_id") == [
        (1, False, 0), (2, False, 0), (3, True, 0), (4, False, 1), (5, True, 1), (6, False, 1), (7, True, 2), (8, False, 2),
    ]
    marks = late.read_marks(spark, out).orderBy("batch_id").collect()
    assert [(m.rows, m.late, m.newest, m.watermark) for m in marks] == [
        (3, 1, at(10), None), (3, 1, at(20), at(8)), (2, 1, at(19), at(18)),
    ]
    plan = stored.where("late AND batch_id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "late" in plan.split("PartitionFilters")[1].split("]")[0]


def test_replayed_batch_is_split_alike(spark, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    failing = {"after": True}

    def then(batch, number):
        if failing["after"] and number == 1:
            raise RuntimeError("lost")

    feed = Feed(spark, tmp_path, lambda s: late.split_stream(s, out, check, "ts", then=then))
    feed.more(timed(spark, (1, 10, 0, True)))
    with pytest.raises(StreamingQueryException, match="lost"):
        feed.more(timed(spark, (2, 30, 0, True), (3, 1, 0, True)))
    failing["after"] = False
    feed.more(timed(spark, (4, 30, 0, True)))
    # batch 1 came again as it was: its own newest time does not count for itself
    stored = late.read_rows(spark, out, spark.createDataFrame([], TIMED).schema)
    assert rows(stored, "id", "late", "batch_id") == [(1, False, 0), (2, False, 1), (3, True, 1), (4, False, 2)]


def test_alerts_of_closed_windows_are_written_once(spark, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    feed = Feed(spark, tmp_path, lambda s: late.watch_error_rate(s, out, check, "ts", ~F.col("ok"), limit=0.4))
    feed.more(timed(spark, (1, 1, 1, False), (2, 1, 2, True), (3, 2, 1, True)))
    assert late.read_alerts(spark, out).count() == 0
    feed.more(timed(spark, (4, 1, 3, False), (5, 4, 0, True)))
    assert rows(late.read_alerts(spark, out), "runId", "errors", "fetched", "error_rate", "batch_id") == [
        ("2026-04-01T00:00:00", 2, 3, "66.7%", 1)
    ]
    feed.more(timed(spark, (6, 1, 4, False), (7, 9, 0, False)))
    assert rows(late.read_alerts(spark, out), "runId", "batch_id") == [("2026-04-01T00:00:00", 1)]
    rates = late.read_rates(spark, out)
    assert rows(rates.select(F.dayofmonth("window.start"), "fetched", "errors", "late", "closed")) == [
        (1, 3, 2, 1, True), (2, 1, 0, 0, True), (4, 1, 0, 0, True), (9, 1, 1, 0, False),
    ]


def docs(spark, *data):
    return spark.createDataFrame(list(data), DOCS)


def bucket_files(spark, path):
    stored = S.read_snapshot(spark, path, docs(spark).schema)
    return {r[0]: r[1] for r in stored.select("bucket", "_metadata.file_path").distinct().collect()}


def test_upsert_equals_the_full_rewrite(spark, tmp_path):
    path, full = str(tmp_path / "s"), docs(spark)
    batches = [
        [(f"d{i}", 1) for i in range(300)], [("d5", 2), ("new", 1)], [], [("d5", 3), ("d6", 0), (None, 1)],
    ]
    for number, data in enumerate(batches):
        new = docs(spark, *data)
        before = bucket_files(spark, path) if number else {}
        assert S.apply_changes(spark, path, new, number, buckets=16)
        state = S.read_snapshot(spark, path, new.schema)
        full = U.upsert(full, new)
        assert rows(state, "document_id", "version") == rows(full)
        after = bucket_files(spark, path)
        touched = {r[0] for r in new.select(S.bucket_of(("document_id",), 16)).collect()}
        assert {k: v for k, v in before.items() if k not in touched} == {k: v for k, v in after.items() if k not in touched}
        assert all(before.get(k) != after[k] for k in touched)
    # older states can still be read; the number of buckets is that of the first batch
    assert S.read_snapshot(spark, path, new.schema, upto=0).count() == 300
    assert S.applied_batch(spark, path) == 3
    S.compact_snapshot(spark, path, str(tmp_path / "c"), new.schema)
    moved = S.read_snapshot(spark, str(tmp_path / "c"), new.schema)
    assert rows(moved, "document_id", "version") == rows(full) and S.applied_batch(spark, str(tmp_path / "c")) == 3
    assert not S.apply_changes(spark, str(tmp_path / "c"), docs(spark, ("x", 1)), 3)


def test_applied_batches_and_lost_writers(spark, tmp_path):
    path = str(tmp_path / "s")
    assert S.apply_changes(spark, path, docs(spark, ("a", 1), ("b", 1)), 4)
    for number in (3, 4):
        assert not S.apply_changes(spark, path, docs(spark, ("a", 9)), number)
    # files without a manifest, as a writer leaves them that was lost
    docs(spark, ("a", 7)).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/data/in_batch=5")
    schema = docs(spark).schema
    assert rows(S.read_snapshot(spark, path, schema), "document_id", "version") == [("a", 1), ("b", 1)]
    assert S.apply_changes(spark, path, docs(spark, ("a", 2)), 5)
    assert rows(S.read_snapshot(spark, path, schema), "document_id", "version") == [("a", 2), ("b", 1)]


def test_order_decides_between_old_and_new(spark, tmp_path):
    path = str(tmp_path / "s")
    S.apply_changes(spark, path, docs(spark, ("a", 5), ("b", 5), ("b", 6)), 0, order=("version",))
    S.apply_changes(spark, path, docs(spark, ("a", 3), ("b", 7)), 1, order=("version",))
    assert rows(S.read_snapshot(spark, path, docs(spark).schema), "document_id", "version") == [("a", 5), ("b", 7)]


def test_merge_needs_one_shuffle(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "s"), []
    S.apply_changes(spark, path, docs(spark, *[(f"d{i}", i) for i in range(50)]), 0, buckets=8)
    import pyspark.sql.classic.dataframe as classic

    write = classic.DataFrame.write
    monkeypatch.setattr(classic.DataFrame, "write", property(lambda self: (
        plans.append(self._jdf.queryExecution().executedPlan().toString()), write.fget(self))[1]))
    S.apply_changes(spark, path, docs(spark, ("d1", 99)), 1)
    merge = [p for p in plans if "max_by" in p]
    assert len(merge) == 1 and merge[0].count("Exchange") == 1


def test_stream_into_snapshot(spark, tmp_path):
    path = str(tmp_path / "s")
    write = S.snapshot_writer(path)
    number = {"check": 0}
    feed = Feed(spark, tmp_path, lambda s: jobs.each_batch(s, str(tmp_path / f"check{number['check']}"), write))
    feed.more(docs(spark, ("a", 1), ("b", 1)))
    feed.more(docs(spark, ("a", 2)))
    number["check"] = 1  # the checkpoint is lost: batch 0 is now all rows, and comes again
    feed.more(docs(spark))
    schema = docs(spark).schema
    assert rows(S.read_snapshot(spark, path, schema), "document_id", "version") == [("a", 2), ("b", 1)]
    assert S.applied_batch(spark, path) == 1
    assert isinstance(S.MANIFEST, T.StructType)
