"""Whole runs: backfill, daily and sample.

Pages are looked at once, by :func:`ingest_pages`, which stores their fields and text without the
HTML. Runs join that narrow table and never read a page again.

A run works its list off in lots. Each lot is written under a token of the attempt, and its
progress names the token once it is whole; a resumed run leaves out the documents of finished lots
and does the rest, whatever an aborted attempt left behind.
"""

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lexmill import schemas as S
from lexmill.functions.text import falsy_to_null
from lexmill.operators import enrich as E
from lexmill.operators import reports as R
from lexmill.operators.pages import extract_laws, fetch_outcome, with_legal_type
from lexmill.operators.snapshots import processed_ids
from lexmill.operators.versions import RowCounts, drop_future, resume as leave_out, sample_laws, widening_range
from lexmill.plans.versions import changed_versions, current_versions
from lexmill.session import run_path
from lexmill.sources import files, sinks
from lexmill.sources.sitemaps import count_sitemaps, law_entries

ROWS_PER_LOT = 1_000_000


def ingest_pages(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Extract stored pages ``url, html`` once and store the result: ``url``, fields, whole text.

    With a ``fetched_at`` column the newest fetch of an address counts, otherwise, and among
    equal times, the fetch with the greatest fields. The HTML stays behind before any shuffle. What
    is fetched once, as most are, is stored as it comes; only addresses that repeat are compared,
    and which these are is asked of the addresses alone.
    """
    when = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None).cast("timestamp")
    extracted = extract_laws(pages.select("url", "html", when.alias("fetched_at")))
    fields = [c for c in extracted.columns if c not in ("url", "fetched_at")]
    narrow = extracted.select("url", "fetched_at", *fields)
    counted = pages.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = _stored(spark, counted.select(F.col("url").alias("again")), "repeated")
    if not repeated.isEmpty():
        rows = _stored(spark, narrow, "fetches")
        same = F.col("url").eqNullSafe(F.col("again"))
        row = F.struct("fetched_at", *fields)
        latest = rows.join(repeated, same, "left_semi").groupBy("url").agg(F.max(row).alias("_row"))
        narrow = rows.join(repeated, same, "left_anti").unionByName(latest.select("url", "_row.*"))
    narrow.write.mode("overwrite").parquet(path)
    return spark.read.schema(narrow.schema).parquet(path)


def _stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back."""
    path = run_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def page_loads(sitemap_pages: DataFrame) -> DataFrame:
    """Load log of sitemap pages: a page without content was not loaded."""
    return sitemap_pages.select("page", falsy_to_null("xml").isNotNull().alias("loaded"))


def require_sources(sitemap_pages: DataFrame, index: DataFrame | None = None) -> None:
    """Stop a run, before it writes anything, if too many sitemap pages failed or are absent.

    ``index`` has one row ``index_xml``; without it the pages that are there are counted.
    """
    expected = None
    if index is not None:
        row = index.select(count_sitemaps("index_xml").alias("n")).first()  # one control row
        expected = row["n"] if row else None
    R.require_quorum(page_loads(sitemap_pages), expected=expected)


def work_list(spark: SparkSession, versions: DataFrame, path: str) -> DataFrame:
    """Store the versions of a run and read them back, so the sitemaps are read once."""
    versions.write.mode("overwrite").parquet(path)
    return spark.read.schema(versions.schema).parquet(path)


def with_fields(
    versions: DataFrame, fields: DataFrame, attempts: DataFrame | None = None, with_text: bool = True
) -> DataFrame:
    """Versions with the fields of their page, and what went wrong with its fetch.

    ``fields`` is the table of :func:`ingest_pages`. The attempt log decides first; a version
    that was fetched, or has no attempt, but has no page is a transient failure.
    """
    known = fields.drop("fetched_at") if with_text else fields.drop("fetched_at", "text_content")
    joined = versions.join(known, "url", "left")
    no_page = F.col("abrogated").isNull()
    error, message = F.when(no_page, "transient"), F.when(no_page, "no stored page")
    if attempts is not None:
        logged = fetch_outcome(attempts).select(
            "document_id", "fetch_outcome", F.col("message").alias("_said")
        )
        joined = joined.join(logged, "document_id", "left")
        failed = F.col("fetch_outcome") != "ok"
        error = F.when(failed, F.col("fetch_outcome")).otherwise(error)
        message = F.when(failed, F.col("_said")).otherwise(message)
    return with_legal_type(joined).withColumns({"error_type": error, "message": message})


def run_requests(
    versions: DataFrame, fields: DataFrame, attempts: DataFrame | None = None
) -> DataFrame:
    """Summary requests of a run, to be answered before its outcomes are built."""
    return E.summary_requests(with_fields(versions, fields, attempts))


def run_outcomes(
    versions: DataFrame,
    fields: DataFrame,
    responses: DataFrame | None = None,
    attempts: DataFrame | None = None,
) -> DataFrame:
    """Outcome per version. Without responses every summary is null.

    Summaries join the versions first, while the rows are small. If the versions come
    straight out of their aggregation, that join needs no shuffle of its own. Then one
    shuffle by address brings in the page fields.
    """
    if responses is None:
        summarised = versions.withColumn("summary", F.lit(None).cast("string"))
    else:
        summarised = E.attach_summaries(versions, responses)
    return E.outcomes(with_fields(summarised, fields, attempts, with_text=False))


def _progress(out: str, run_id: str) -> str:
    return f"{out.rstrip('/')}/progress/{run_id}"


def stored_outcomes(spark: SparkSession, out: str, run_id: str) -> DataFrame:
    """Outcomes of all lots a run has finished so far; empty before the first."""
    done = files.read_progress(spark, _progress(out, run_id))
    return files.read_outcomes(spark, f"{out.rstrip('/')}/outcomes/{run_id}", done)


def begin_work(spark: SparkSession, out: str, run_id: str) -> str:
    """Note a new start of a run; lots of earlier starts count no longer."""
    start = uuid.uuid4().hex
    sinks.write_progress(spark, _progress(out, run_id), start, None, None)
    return start


def write_work(
    spark: SparkSession,
    work: DataFrame,
    fields: DataFrame,
    out: str,
    run_id: str,
    responses: DataFrame | None = None,
    attempts: DataFrame | None = None,
    rows_per_lot: int = ROWS_PER_LOT,
    only: list[int] | None = None,
) -> None:
    """Write a run's outcomes lot by lot; lots are picked by a hash of the document.

    Their number follows from the rows of the stored work list. A lot is finished once its progress
    is noted, so an aborted run loses one lot's work at most. ``only`` picks lots.
    """
    progress, path = _progress(out, run_id), f"{out.rstrip('/')}/outcomes/{run_id}"
    start = files.last_start(spark, progress) or begin_work(spark, out, run_id)
    last = files.read_progress(spark, progress).agg(F.max("lot")).first()[0]  # one number
    before = 0 if last is None else last + 1
    lots = max(-(-work.count() // rows_per_lot), 1)
    for number in only if only is not None else range(lots):
        own = work.where(F.pmod(F.xxhash64("document_id"), F.lit(lots)) == number)
        outcomes = run_outcomes(own, fields, responses, attempts)
        token = uuid.uuid4().hex
        sinks.append_outcomes(outcomes, path, before + number, token)
        sinks.write_progress(spark, progress, start, before + number, token)


def finish_run(
    spark: SparkSession, out: str, run_id: str, mode: str, last_run: str | None = None
) -> DataFrame:
    """Write documents, reasons, report and alerts of a run's stored outcomes; returns the report.

    Of several outcomes of a document, as an aborted and a resumed start may leave, one counts.
    That choice is stored once and everything else reads it.
    """
    out = out.rstrip("/")
    decided = f"{out}/decided/{run_id}"
    E.dedup_outcomes(stored_outcomes(spark, out, run_id)).write.mode("overwrite").parquet(decided)
    stored = spark.read.schema(S.OUTCOMES).parquet(decided)
    sinks.write_documents(E.documents(stored), f"{out}/documents", run_id)
    sinks.write_reasons(R.error_reasons(stored), f"{out}/reasons", run_id)
    report = R.nest_report(R.run_report(stored, mode, run_id, last_run))
    sinks.write_run_report(report, f"{out}/reports", run_id)
    written = spark.read.schema(S.RUN_REPORT).json(f"{out}/reports/run_report_{run_id}")
    sinks.write_alerts(R.alerts(written), f"{out}/alerts", run_id)
    return written


def run_counts(spark: SparkSession, out: str, run_id: str) -> DataFrame:
    """What a run saw: ``runId, entries, laws, remaining, skipped``."""
    return files.read_counts(spark, f"{out.rstrip('/')}/counts", run_id)


def _start(spark, versions, counts, out, run_id, resume, processed=None) -> DataFrame:
    """Work list of a run: its versions without those processed before or, if it is resumed, without
    those that have an outcome. Its counts are taken while the list is written, and stored."""
    if processed is not None:
        versions = leave_out(versions, processed)
    if resume:
        versions = leave_out(versions, processed_ids(stored_outcomes(spark, out, run_id)))
    else:
        begin_work(spark, out, run_id)
        sinks.clear_outcomes(spark, f"{out}/outcomes/{run_id}", S.OUTCOMES)
    work = work_list(spark, counts(versions, "remaining"), f"{out}/versions/{run_id}")
    seen = counts.get()
    sinks.write_counts(spark, {**seen, "skipped": seen["laws"] - seen["remaining"]}, f"{out}/counts", run_id)
    return work


def run_backfill(
    spark: SparkSession,
    sitemap_pages: DataFrame,
    fields: DataFrame,
    out: str,
    run_id: str,
    today: str,
    responses: DataFrame | None = None,
    processed: DataFrame | None = None,
    attempts: DataFrame | None = None,
    index: DataFrame | None = None,
    rows_per_lot: int = ROWS_PER_LOT,
    resume: bool = False,
) -> DataFrame:
    """Full build of all current versions that were not processed before.

    ``resume`` goes on with a run of the same id that was aborted.
    """
    out = out.rstrip("/")
    require_sources(sitemap_pages, index)
    counts = RowCounts()
    versions = current_versions(sitemap_pages, today, counted=counts)
    work = _start(spark, versions, counts, out, run_id, resume, processed)
    write_work(spark, work, fields, out, run_id, responses, attempts, rows_per_lot)
    return finish_run(spark, out, run_id, "backfill")


def run_daily(
    spark: SparkSession,
    sitemap_pages: DataFrame,
    fields: DataFrame,
    out: str,
    run_id: str,
    today: str,
    responses: DataFrame | None = None,
    latest_first: bool = False,
    attempts: DataFrame | None = None,
    index: DataFrame | None = None,
    rows_per_lot: int = ROWS_PER_LOT,
    resume: bool = False,
    head: Row | None = None,
) -> DataFrame:
    """Changes since the stored checkpoint; moves it if the run went well enough.

    Without changes the output is empty, the report holds zeros and the checkpoint moves. If too
    many sitemap pages failed, the run stops before it writes and the checkpoint stays.
    New documents are counted against the stored checkpoint, not against its default.

    The commit names the one that the run began from (``head``, read from the store unless given). If
    another run has committed in between, the checkpoint stays where that one put it.
    """
    out = out.rstrip("/")
    require_sources(sitemap_pages, index)
    control = f"{out}/checkpoint"
    # one control row each; the dates become literals of the plan
    head = files.checkpoint_head(spark, control).first() if head is None else head
    stored = head["last_run"]
    known = spark.range(1).select(F.lit(stored).cast("string").alias("last_run"))
    since = files.since_date(known, today).first()["last_run"]
    counts = RowCounts()
    versions = changed_versions(sitemap_pages, today, since, latest_first, counted=counts)
    work = _start(spark, versions, counts, out, run_id, resume)
    write_work(spark, work, fields, out, run_id, responses, attempts, rows_per_lot)
    report = finish_run(spark, out, run_id, "daily", stored)
    sinks.commit_checkpoint(report, control, today, guarded=True, follows=head["run_id"])
    return report


def sample_versions(sitemap_pages: DataFrame, today: str, n: int) -> DataFrame:
    """The first ``n`` laws as a reader knows them who stops at the page that brings the n-th.

    Later pages are not read, so a version that only they hold is not seen; :func:`sample_outcomes`
    without ``early_stop`` looks at all pages.
    """

    def entries(pages: DataFrame) -> DataFrame:
        return drop_future(law_entries(pages), today)

    last = widening_range(sitemap_pages, n, entries) if n else None
    read = sitemap_pages if last is None else sitemap_pages.where(F.col("page") <= last)
    return sample_laws(entries(read), n)


def sample_outcomes(
    sitemap_pages: DataFrame, fields: DataFrame, today: str, n: int = 0, early_stop: bool = False
) -> DataFrame:
    """Outcomes of the first ``n`` laws, without summaries."""
    if early_stop:
        return run_outcomes(sample_versions(sitemap_pages, today, n), fields)
    laws = sample_laws(drop_future(law_entries(sitemap_pages), today), n)
    return run_outcomes(laws, fields)
