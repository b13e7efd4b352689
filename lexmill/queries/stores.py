"""Queries over stores that grow: late rows, bucketed snapshots, guarded commits, array files.

Each query stands beside its SQL, which is computed from the given tables alone.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill import schemas as S
from lexmill.operators import quality as Q
from lexmill.operators import reports as R
from lexmill.operators.versions import first_seen_key
from lexmill.plans import runs
from lexmill.queries import raw
from lexmill.queries.checks import CHECKS, DAILY, ENTRIES, ISO, LAST_RUN, O, SLASH, TODAY, _latest, _url
from lexmill.queries.registry import after_checkpoint, page_fields_table, query
from lexmill.session import run_path
from lexmill.sources import files, sinks, snapshots
from lexmill.streaming import jobs, late

DAYS = K.LATE_BUFFER_DAYS
ARRAY_RANGES = 128

# --- late rows -----------------------------------------------------------------------


def _in_two_files(spark, sf, run) -> None:
    """Call ``run(stream)`` after every third event is missing, and again when these have come."""
    events = raw.table(spark, sf, "events")
    path = run_path(spark, "events")
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        events.where(part).write.mode("append").parquet(path)
        run(jobs.ingest_stream(spark, path, events.schema)).awaitTermination()


@query
def stream_late_rows(spark, sf):
    """Events in two files: all of the first are kept, those of the second that come late lie apart."""
    base = run_path(spark, "late")
    _in_two_files(spark, sf, lambda s: late.split_stream(s, f"{base}/out", f"{base}/checkpoint", "ts"))
    rows = late.read_rows(spark, f"{base}/out", raw.table(spark, sf, "events").schema)
    return rows.select("event_id", "late", "batch_id")


LATE = f"""e AS (
  SELECT *, event_id % 3 = 0 AS second,
    event_id % 3 = 0 AND ts < (SELECT max(ts) FROM events WHERE event_id % 3 <> 0) - INTERVAL {DAYS} DAY AS late
  FROM events)"""
CHECKS["stream_late_rows"] = f"WITH {LATE} SELECT event_id, late, CAST(second AS BIGINT) AS batch_id FROM e"


@query
def stream_late_counts(spark, sf):
    """What the marks of the same two batches say: rows and late rows, counted as stored."""
    base = run_path(spark, "marks")
    _in_two_files(spark, sf, lambda s: late.split_stream(s, f"{base}/out", f"{base}/checkpoint", "ts"))
    return late.read_marks(spark, f"{base}/out").select(
        "batch_id", "rows", "late", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss").alias("watermark")
    )


CHECKS["stream_late_counts"] = f"""WITH {LATE}
  SELECT CAST(second AS BIGINT) AS batch_id, count(*) AS rows, count(*) FILTER (WHERE late) AS late,
    CASE WHEN second THEN (SELECT strftime(max(ts) - INTERVAL {DAYS} DAY, '%Y-%m-%d %H:%M:%S') FROM events
      WHERE event_id % 3 <> 0) END AS watermark FROM e GROUP BY second"""


@query
def stream_rate_alerts(spark, sf):
    """Error rate a day over the two batches, late rows counted apart, alerts of closed days as stored."""
    base = run_path(spark, "alerts")
    failed = F.col("event_type") == "error"
    _in_two_files(
        spark, sf, lambda s: late.watch_error_rate(s, f"{base}/out", f"{base}/checkpoint", "ts", failed, limit=0.2)
    )
    alerts = late.read_alerts(spark, f"{base}/out").select(F.substring("runId", 1, 10).alias("day"), "error_rate")
    rates = late.read_rates(spark, f"{base}/out")
    days = rates.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "fetched", "errors", "late", "closed")
    return days.join(alerts, "day", "left")


CHECKS["stream_rate_alerts"] = f"""WITH {LATE}, d AS (
    SELECT strftime(ts, {ISO}) AS day, count(*) FILTER (WHERE NOT late) AS fetched,
      count(*) FILTER (WHERE NOT late AND event_type = 'error') AS errors, count(*) FILTER (WHERE late) AS late,
      date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL {DAYS} DAY AS closed
    FROM e GROUP BY day)
  SELECT *, CASE WHEN closed AND errors * 5 > fetched THEN
    ((2000 * errors + fetched) // (2 * fetched)) // 10 || '.' || ((2000 * errors + fetched) // (2 * fetched)) % 10 || '%'
    END AS error_rate FROM d"""


# --- snapshots -----------------------------------------------------------------------


def _law_rows(spark, sf) -> DataFrame:
    return raw.table(spark, sf, "customer").select(
        raw.text("law-", F.col("c_custkey")).alias("document_id"), F.col("c_name").alias("title"), F.lit(1).alias("version")
    )


@query
def bucketed_upsert(spark, sf):
    """A day that touches few buckets: the snapshot, and whether all other buckets kept their files."""
    path = run_path(spark, "snapshot")
    old = _law_rows(spark, sf)
    new = old.where("document_id IN ('law-1', 'law-2', 'law-3')").select(
        "document_id", F.upper("title").alias("title"), F.lit(2).alias("version")
    )
    added = raw.table(spark, sf, "supplier").where("s_suppkey <= 2").select(
        raw.text("new-", F.col("s_suppkey")).alias("document_id"), F.col("s_name").alias("title"), F.lit(2).alias("version")
    )
    files = []
    for number, rows in enumerate((old, new.unionByName(added))):
        snapshots.apply_changes(spark, path, rows, number)
        stored = snapshots.read_snapshot(spark, path, old.schema)
        files.append(stored.select("bucket", "in_batch", F.col("_metadata.file_path").alias("file")).distinct())
    before, after = files
    untouched, touched = after.where("in_batch = 0").count(), after.where("in_batch = 1").count()
    kept = before.join(after, ["bucket", "file"]).count()
    state = snapshots.read_snapshot(spark, path, old.schema).select("document_id", "title", "version")
    return state.withColumn("others_kept", F.lit(kept == untouched > 0 < touched <= 6))


CHECKS["bucketed_upsert"] = """
  SELECT 'law-' || c_custkey AS document_id, CASE WHEN c_custkey BETWEEN 1 AND 3 THEN upper(c_name) ELSE c_name END AS title,
    CASE WHEN c_custkey BETWEEN 1 AND 3 THEN 2 ELSE 1 END AS version, true AS others_kept FROM customer
  UNION ALL SELECT 'new-' || s_suppkey, s_name, 2, true FROM supplier WHERE s_suppkey <= 2"""


@query
def stream_snapshot_replay(spark, sf):
    """Latest version per law, put into a snapshot batch by batch; then all batches once more.

    The third start has lost its checkpoint and gets every row again; the snapshot stays as it is.
    """
    base = run_path(spark, "replay")
    orders = raw.table(spark, sf, "orders").select(
        raw.text("law-", F.col("o_custkey")).alias("document_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("entry_date"),
        F.col("o_orderkey").alias("page"), first_seen_key("o_orderkey").alias("seen"),
    )
    write = snapshots.snapshot_writer(f"{base}/snapshot", order=("entry_date", "seen"))
    parts = [F.col("page") % 2 == 0, F.col("page") % 2 == 1, F.lit(False)]
    for part, checkpoint in zip(parts, "aab", strict=True):
        orders.where(part).write.mode("append").parquet(f"{base}/in")
        jobs.each_batch(
            jobs.ingest_stream(spark, f"{base}/in", orders.schema), f"{base}/checkpoint-{checkpoint}", write
        ).awaitTermination()
    state = snapshots.read_snapshot(spark, f"{base}/snapshot", orders.schema)
    applied = snapshots.read_manifests(spark, f"{base}/snapshot").select("batch_id").distinct().count()
    return state.select("document_id", "entry_date", "page").withColumn("batches", F.lit(applied))


CHECKS["stream_snapshot_replay"] = CHECKS["stream_latest"].replace(
    "entry_date, page FROM", "entry_date, page, CAST(2 AS INT) AS batches FROM", 1
)


@query
def stream_dedup_snapshot(spark, sf):
    """Events delivered twice over two batches, late ones left out, in a snapshot by event."""
    base = run_path(spark, "dedup")
    events = raw.table(spark, sf, "events")
    write = snapshots.snapshot_writer(f"{base}/snapshot", key=("event_id",))
    for part in (F.col("event_id") % 3 != 0, F.lit(True)):
        events.where(part).write.mode("append").parquet(f"{base}/in")
        late.split_stream(
            jobs.ingest_stream(spark, f"{base}/in", events.schema), f"{base}/rows", f"{base}/checkpoint", "ts", then=write
        ).awaitTermination()
    state = snapshots.read_snapshot(spark, f"{base}/snapshot", events.schema)
    return state.select("event_id", "user_id", "event_type")


CHECKS["stream_dedup_snapshot"] = f"WITH {LATE} SELECT event_id, user_id, event_type FROM e WHERE NOT late"


# --- runs ----------------------------------------------------------------------------


@query
def concurrent_runs(spark, sf):
    """Two daily runs that began from one checkpoint: the first to commit moves it, the second does not."""
    out = after_checkpoint(spark, "concurrent", raw.LAST_RUN)
    head = files.checkpoint_head(spark, f"{out}/checkpoint").first()
    pages, fields = raw.sitemap_pages(spark, sf), page_fields_table(spark, sf)
    given = {"attempts": raw.fetch_attempts(spark, sf, "law-"), "head": head}
    reports = [runs.run_daily(spark, pages, fields, out, r, raw.TODAY, **given) for r in ("daily_a", "daily_b")]
    now = files.checkpoint_head(spark, f"{out}/checkpoint").first()
    both = reports[0].unionByName(reports[1]).select("runId", "fetched")
    committed = files.read_commits(spark, f"{out}/checkpoint").select("runId", F.lit(True).alias("claimed"))
    return both.join(committed, "runId", "left").select(
        "runId", "fetched", F.coalesce("claimed", F.lit(False)).alias("claimed"),
        (F.col("runId") == F.lit(now["run_id"])).alias("counts"), F.lit(now["last_run"]).alias("checkpoint"),
    )


CHECKS["concurrent_runs"] = f"""WITH {DAILY}, n AS (
    SELECT count(*) AS fetched, count(*) FILTER (WHERE kind <> 'document') * 2 < count(*) OR count(*) = 0 AS good
    FROM r)
  SELECT runId, fetched, good AS claimed, good AND runId = 'daily_a' AS counts,
    CASE WHEN good THEN '{TODAY}' ELSE '{LAST_RUN}' END AS checkpoint
  FROM n, (VALUES ('daily_a'), ('daily_b')) v(runId)"""


@query
def backfill_counts(spark, sf):
    """What a backfill saw after the laws of a market segment had been processed before."""
    out = run_path(spark, "counts")
    done = raw.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        raw.text("law-", F.col("c_custkey")).alias("document_id")
    )
    runs.run_backfill(
        spark, raw.sitemap_pages(spark, sf), page_fields_table(spark, sf), out, "backfill_1", raw.TODAY, processed=done
    )
    return runs.run_counts(spark, out, "backfill_1")


CHECKS["backfill_counts"] = f"""WITH {ENTRIES}, l AS (SELECT DISTINCT document_id FROM past),
  s AS (SELECT document_id FROM l WHERE document_id IN (
    SELECT 'law-' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
  SELECT 'backfill_1' AS runId, (SELECT count(*) FROM past) AS entries, (SELECT count(*) FROM l) AS laws,
    (SELECT count(*) FROM l) - (SELECT count(*) FROM s) AS remaining, (SELECT count(*) FROM s) AS skipped"""


@query
def widening_sample(spark, sf):
    """The first 25 laws of stored sitemap pages, read up to the page that brings the 25th."""
    path = run_path(spark, "sitemaps")
    pages = raw.sitemap_pages(spark, sf)
    pages.repartitionByRange("page").sortWithinPartitions("page").write.parquet(path)
    stored = spark.read.schema(pages.schema).parquet(path)
    return runs.sample_versions(stored, raw.TODAY, 25).select("document_id", "url", "entry_date")


CHECKS["widening_sample"] = f"""WITH {ENTRIES}, f AS (
    SELECT document_id, min(page * 10 + pos) AS first FROM past GROUP BY 1 ORDER BY first LIMIT 25),
  seen AS (SELECT past.* FROM past WHERE page <= (SELECT max(first) // 10 FROM f)),
  l AS ({_latest('seen')})
  SELECT document_id, url, entry_date FROM l JOIN f USING (document_id)"""


# --- files ---------------------------------------------------------------------------


def array_lines(acts: DataFrame) -> DataFrame:
    """Acts by order key as the lines of one JSON array file.

    One file is one task to write, but not to read or to sort: ranges of the key are sorted and stored
    by a task each, and the one that writes takes their lines as they stand, one range after another.
    """
    spark, path = acts.sparkSession, run_path(acts.sparkSession, "array_ranges")
    elements = acts.select(
        F.expr("bigint(substring(legal_act.document_id, 7))").alias("k"),
        F.to_json(F.struct("legal_act", "legal_act_relations")).alias("value"),
    )
    dealt = elements.repartitionByRange(ARRAY_RANGES, "k").withColumn("range", F.spark_partition_id())
    dealt.sortWithinPartitions("range", "k").select("value", "range").write.partitionBy("range").text(path)
    kept = spark.read.schema("value STRING, range INT").text(path).select("range").distinct().collect()  # a row per range
    lines = spark.range(0).select(F.lit("").alias("value"))
    for number in sorted(r["range"] for r in kept):
        lines = lines.unionByName(spark.read.text(f"{path}/range={number}"))
    mark = F.when(F.monotonically_increasing_id() == 0, "[").otherwise(",")
    return lines.unionByName(spark.range(1).select(F.lit("]").alias("value"))).coalesce(1).select(
        F.when(F.col("value") == "]", F.col("value")).otherwise(F.concat(mark, "value")).alias("value")
    )


@query
def array_documents(spark, sf):
    """All acts as one JSON array file, read back in byte ranges."""
    path = run_path(spark, "array")
    acts = raw.order_acts(spark, sf).withColumn("legal_act_relations", F.array().cast(S.RELATIONS))
    array_lines(acts).write.text(path)
    act = F.from_json("raw", S.DOCUMENT)["legal_act"]
    return files.read_documents(spark, path).select(
        "root_ok", "pos", act["document_id"].alias("document_id"), act["url"].alias("url")
    )


CHECKS["array_documents"] = f"""WITH {O}
  SELECT true AS root_ok, CAST(row_number() OVER (ORDER BY k) - 1 AS INT) AS pos, 'order-' || k AS document_id,
    {_url('d', 't', SLASH)} AS url FROM o"""


@query
def named_reports(spark, sf):
    """Reports under their exchange names, an example among them that is left out, and their verdicts."""
    path = run_path(spark, "named")
    outcomes = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    for run, mode in (("a", "backfill"), ("b", "daily"), ("example", "daily")):
        sinks.write_report_file(R.nest_report(R.run_report(outcomes, mode, run, raw.LAST_RUN)), path, run)
    read = files.read_run_reports(spark, path)
    parsed = F.from_json("raw", S.RUN_REPORT)
    fields = [parsed[c].alias(c) for c in ("runId", "mode", "newDocuments", "errors")]
    return read.select("file", *fields).join(Q.report_verdicts(read).select("file", "verdict"), "file")


CHECKS["named_reports"] = f"SELECT * REPLACE (file || '.json' AS file) FROM ({CHECKS['stored_reports']})"
