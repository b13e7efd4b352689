"""Streams over several batches and restarts."""

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.pages import extract_laws
from lexmill.streaming import jobs

PAGES = T.StructType([T.StructField("document_id", T.StringType()), T.StructField("html", T.StringType())])
ENTRIES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("document_id", "entry_date", "lastmod")]
    + [T.StructField("page", T.IntegerType()), T.StructField("pos", T.IntegerType())]
)


def put(spark, path, schema, *data):
    """Add one file to a folder."""
    spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(path)


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        stream = jobs.ingest_stream(spark, source, PAGES, files_per_batch=1)
        jobs.write_batches(stream, out, check, extract_laws).awaitTermination()
        return spark.read.parquet(out)

    put(spark, source, PAGES, ("a", "<h1>A</h1>"))
    put(spark, source, PAGES, ("b", "<h1>B</h1>"))
    assert rows(run(), "document_id", "title", "batch_id") in (
        [("a", "A", 0), ("b", "B", 1)], [("a", "A", 1), ("b", "B", 0)],
    )
    assert run().count() == 2
    put(spark, source, PAGES, ("c", "<h1>C</h1>"))
    assert rows(run().where("batch_id = 2"), "document_id") == [("c",)]


def test_compacted_log_has_the_same_state(spark, tmp_path):
    source, out, check, shots = (str(tmp_path / n) for n in ("in", "out", "check", "shots"))
    for n, row in enumerate([("a", "2020", "1", 1, 0), ("b", "2020", "1", 2, 0), ("a", "2021", "1", 3, 0)]):
        put(spark, source, ENTRIES, row)
        jobs.latest_stream(jobs.ingest_stream(spark, source, ENTRIES), out, check).awaitTermination()
        if n != 1:
            jobs.compact_latest(spark, out, shots, ENTRIES)
        state = jobs.read_latest(spark, out, shots, ENTRIES)
        assert rows(state) == rows(jobs.latest_state(jobs.read_batches(spark, out, ENTRIES)))
    assert rows(state, "document_id", "entry_date") == [("a", "2021"), ("b", "2020")]


def test_bad_batch_is_replayed(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    good = {"pages": False}
    put(spark, source, PAGES, ("a", "<h1>A</h1>"), ("b", "<h1>B</h1>"))

    def outcomes(batch):
        is_document = F.lit(good["pages"]) | (F.col("document_id") == "a")
        return batch.select("document_id", F.when(is_document, "document").otherwise("error").alias("kind"))

    def run():
        stream = jobs.ingest_stream(spark, source, PAGES)
        jobs.write_batches(stream, out, check, outcomes, guard=0.5).awaitTermination()

    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="1 of 2 failed"):
            run()
    schema = T.StructType([T.StructField("document_id", T.StringType()), T.StructField("kind", T.StringType())])
    # written once and not listed
    assert (tmp_path / "out" / "data" / "batch_id=0").exists()
    assert jobs.read_published(spark, out, schema).count() == 0
    good["pages"] = True
    run()
    assert rows(jobs.read_published(spark, out, schema)) == [("a", "document", 0), ("b", "document", 0)]
    assert rows(jobs.read_manifest(spark, out)) == [(2, 0, 0)]
    # the checkpoint is lost: the batch comes again with other rows, but it is listed already
    good["pages"] = False
    jobs.write_batches(
        jobs.ingest_stream(spark, source, PAGES), out, str(tmp_path / "check2"), outcomes, guard=0.5
    ).awaitTermination()
    assert rows(jobs.read_published(spark, out, schema), "document_id", "kind") == [("a", "document"), ("b", "document")]


def test_dedup_over_batches(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(spark, source, ENTRIES, ("a", "2020", "2026-04-01", 1, 0), ("a", "2020", "2026-04-01", 1, 0))

    def run():
        stream = jobs.with_late_buffer(jobs.ingest_stream(spark, source, ENTRIES, 1))
        jobs.write_batches(jobs.dedup_stream(stream), out, check).awaitTermination()
        return rows(spark.read.parquet(out).select("document_id", F.col("lastmod").cast("date").cast("string")))

    assert run() == [("a", "2026-04-01")]
    # delivered again, and a corrected text of the same version
    put(spark, source, ENTRIES, ("a", "2020", "2026-04-01", 1, 0), ("a", "2020", "2026-04-02", 1, 0))
    assert run() == [("a", "2026-04-01"), ("a", "2026-04-02")]
    # one day late is in the buffer
    put(spark, source, ENTRIES, ("b", "2020", "2026-04-01", 1, 0))
    assert run() == [("a", "2026-04-01"), ("a", "2026-04-02"), ("b", "2026-04-01")]


def test_latest_over_batches(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        stream = jobs.ingest_stream(spark, source, ENTRIES, 1)
        jobs.latest_stream(stream, out, check).awaitTermination()
        changes = jobs.read_batches(spark, out, ENTRIES)
        return rows(jobs.latest_state(changes), "document_id", "entry_date", "lastmod")

    put(spark, source, ENTRIES, ("a", "2020", "1", 1, 0), ("a", "2021", "1", 1, 1), ("b", "2020", "1", 1, 2))
    assert run() == [("a", "2021", "1"), ("b", "2020", "1")]
    put(spark, source, ENTRIES, ("a", "2019", "9", 1, 0), ("b", "2020", "2", 1, 0), ("c", "2020", "1", 1, 1))
    assert run() == [("a", "2021", "1"), ("b", "2020", "2"), ("c", "2020", "1")]


def test_error_rate_windows(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = T.StructType([T.StructField("ts", T.StringType()), T.StructField("ok", T.BooleanType())])

    def run():
        stream = jobs.with_late_buffer(jobs.ingest_stream(spark, source, schema, 1), "ts")
        rates = jobs.error_rate_windows(stream, "ts", ~F.col("ok"))
        jobs.write_batches(rates, out, check, output_mode="update").awaitTermination()
        state = jobs.latest_update(spark.read.parquet(out), "window")
        return rows(state.select(F.date_format("window.start", "yyyy-MM-dd"), "fetched", "errors"))

    put(spark, source, schema, ("2026-04-01 01:00", True), ("2026-04-01 02:00", False))
    assert run() == [("2026-04-01", 2, 1)]
    put(spark, source, schema, ("2026-04-01 23:00", False), ("2026-04-02 00:00", True))
    assert run() == [("2026-04-01", 3, 2), ("2026-04-02", 1, 0)]
