"""Queries over the given tables, one per operator or plan."""

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill import schemas as S
from lexmill.constants import JURISDICTIONS
from lexmill.functions import text as X
from lexmill.functions.lookups import map_legal_type, translation_pair
from lexmill.operators import enrich as E
from lexmill.operators import lookups as L
from lexmill.operators import pages as P
from lexmill.operators import quality as Q
from lexmill.operators import relations as N
from lexmill.operators import reports as R
from lexmill.operators import snapshots as U
from lexmill.operators import versions as V
from lexmill.plans import runs, versions as plan_versions
from lexmill.queries import raw
from lexmill.session import run_path
from lexmill.sources import files, sinks, sitemaps
from lexmill.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VERSION_COLUMNS = ["document_id", "url", "lastmod", "doc_type", "date_str", "entry_date"]
ACT_COLUMNS = S.LEGAL_ACT.names


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _flat_outcomes(outcomes: DataFrame) -> DataFrame:
    """Outcomes as flat columns."""
    fields = [F.col(f"legal_act.{c}").alias(f"act_{c}") for c in ACT_COLUMNS]
    return outcomes.select(
        "kind", "document_id", "reason", "message", *fields,
        F.size("legal_act_relations").alias("relations"),
    )


def _fresh(spark: SparkSession, name: str) -> tuple[str, str]:
    """Output and checkpoint folder of a streaming run."""
    base = run_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


# --- sitemaps and versions -----------------------------------------------------------


@query
def sitemap_count(spark, sf):
    return raw.sitemap_indexes(spark, sf).select(
        "site", sitemaps.count_sitemaps("index_xml").alias("sitemaps")
    )


@query
def sitemap_locations(spark, sf):
    return sitemaps.explode_sitemap(raw.sitemap_pages(spark, sf))


@query
def sitemap_entries(spark, sf):
    return sitemaps.law_entries(raw.sitemap_pages(spark, sf)).select(
        "page", "pos", *VERSION_COLUMNS
    )


@query
def current_versions(spark, sf):
    pages = raw.sitemap_pages(spark, sf)
    return plan_versions.current_versions(pages, raw.TODAY).select("page", "pos", *VERSION_COLUMNS)


@query
def ranked_versions(spark, sf):
    entries = sitemaps.law_entries(raw.sitemap_pages(spark, sf))
    return V.rank_versions(V.drop_future(entries, raw.TODAY), keep=3).select(
        "document_id", "version_rank", "url", "entry_date"
    )


@query
def resume_remaining(spark, sf):
    processed = (
        raw.table(spark, sf, "customer")
        .where(F.col("c_mktsegment") == "BUILDING")
        .select(raw.text("law-", F.col("c_custkey")).alias("document_id"))
    )
    pages = raw.sitemap_pages(spark, sf)
    return plan_versions.current_versions(pages, raw.TODAY, processed).select(*VERSION_COLUMNS)


@query
def changed_since(spark, sf):
    pages = raw.sitemap_pages(spark, sf)
    return plan_versions.changed_versions(pages, raw.TODAY, raw.LAST_RUN).select(*VERSION_COLUMNS)


@query
def changed_since_latest_first(spark, sf):
    pages = raw.sitemap_pages(spark, sf)
    return plan_versions.changed_versions(
        pages, raw.TODAY, raw.LAST_RUN, latest_first=True
    ).select(*VERSION_COLUMNS)


@query
def first_seen_order(spark, sf):
    entries = V.drop_future(sitemaps.law_entries(raw.sitemap_pages(spark, sf)), raw.TODAY)
    return V.latest_version(entries, first_seen=True).select(
        "document_id", "url", "first_page", "first_pos"
    )


@query
def first_n_laws(spark, sf):
    entries = V.drop_future(sitemaps.law_entries(raw.sitemap_pages(spark, sf)), raw.TODAY)
    return V.sample_laws(entries, 25).select("document_id", "url", "entry_date")


@query
def version_history(spark, sf):
    entries = V.drop_future(sitemaps.law_entries(raw.sitemap_pages(spark, sf)), raw.TODAY)
    return V.version_history(entries).select(
        "document_id", "valid_from", "valid_to", "url", "entity_type"
    )


@query
def observed_counts(spark, sf):
    """Row counts seen while the current versions are computed, in one pass."""
    entries = V.drop_future(sitemaps.law_entries(raw.sitemap_pages(spark, sf)), raw.TODAY)
    counted, before = V.observe_counts(entries, "entries")
    laws, after = V.observe_counts(V.latest_version(counted), "laws")
    laws.write.format("noop").mode("overwrite").save()
    rows = [("entries", before.get["rows"]), ("laws", after.get["rows"])]
    return spark.createDataFrame(rows, "stage STRING, n BIGINT")


# --- pages ---------------------------------------------------------------------------


@query
def page_titles(spark, sf):
    return raw.pages(spark, sf).select(
        "page_id", X.extract_title("html").alias("title")
    )


@query
def page_texts(spark, sf):
    """Whole body text of every page, and what a summary request takes of it."""
    whole = raw.pages(spark, sf).select(
        "page_id", X.extract_body_text("html", None).alias("body_text")
    )
    return whole.withColumn("text_content", F.substring("body_text", 1, K.TEXT_CHARS))


@query
def page_fields(spark, sf):
    """All extractors over the real pages, with their whole text."""
    return P.extract_laws(raw.pages(spark, sf))


@query
def law_fields(spark, sf):
    return P.with_legal_type(P.extract_laws(raw.law_pages(spark, sf)))


@query
def abrogated_split(spark, sf):
    return raw.law_pages(spark, sf).select(
        "document_id", F.coalesce(X.is_abrogated("html"), F.lit(False)).alias("abrogated")
    )


@query
def legal_types(spark, sf):
    return raw.orders(spark, sf).select("k", map_legal_type("doc_type").alias("legal_type"))


@query
def fetch_outcomes(spark, sf):
    return P.fetch_outcome(raw.fetch_attempts(spark, sf))


# --- documents -----------------------------------------------------------------------


def _extracted(spark, sf, with_text: bool = True) -> DataFrame:
    """Extracted order pages, each with its fetch outcome; no attempt counts as fetched."""
    pages = raw.law_pages(spark, sf)
    extracted = P.with_legal_type(P.extract_laws(pages, with_text=with_text))
    fetched = P.fetch_outcome(raw.fetch_attempts(spark, sf))
    joined = extracted.join(fetched, "document_id", "left")
    return joined.withColumn(
        "error_type",
        F.when(F.col("fetch_outcome") != "ok", F.col("fetch_outcome"))
        .when(F.col("abrogated").isNull(), "transient"),
    )


@query
def enrichable_laws(spark, sf):
    return E.enrichable(_extracted(spark, sf)).select("document_id", "title", "text_content")


@query
def summary_requests(spark, sf):
    return E.summary_requests(_extracted(spark, sf))


@query
def summary_texts(spark, sf):
    return E.summaries(raw.responses(spark, sf, "order-"))


@query
def enriched_documents(spark, sf):
    extracted = _extracted(spark, sf, with_text=False)
    summarised = E.attach_summaries(extracted, raw.responses(spark, sf, "order-"))
    return _flat_outcomes(E.outcomes(summarised))


@query
def merged_outcomes(spark, sf):
    """Outcomes of a run and of its accumulator, merged and reduced to one per document."""
    extracted = _extracted(spark, sf, with_text=False)
    first = E.outcomes(extracted.withColumn("summary", F.lit(None).cast("string")))
    second = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    return E.dedup_outcomes(E.merge_outcomes(first, second)).select(
        "kind", "document_id", "reason", F.col("legal_act.summary").alias("summary")
    )


def page_fields_table(spark, sf) -> DataFrame:
    """The law pages, ingested: their fields, stored once."""
    return runs.ingest_pages(spark, raw.law_pages(spark, sf), run_path(spark, "fields"))


@query
def ingested_pages(spark, sf):
    return page_fields_table(spark, sf).drop("fetched_at")


@query
def backfill_outcomes(spark, sf):
    """Backfill: current versions, their page fields, summaries, documents and errors."""
    versions = plan_versions.current_versions(raw.sitemap_pages(spark, sf), raw.TODAY)
    return _flat_outcomes(
        runs.run_outcomes(
            versions, page_fields_table(spark, sf), raw.responses(spark, sf, "law-")
        )
    )


@query
def backfill_requests(spark, sf):
    """Summary requests of a backfill: current versions, their pages, prompts."""
    versions = plan_versions.current_versions(raw.sitemap_pages(spark, sf), raw.TODAY)
    return runs.run_requests(versions, page_fields_table(spark, sf)).select("document_id", "prompt")


def _with_counts(report: DataFrame, out: str) -> DataFrame:
    """The report, with what the run saw, left and skipped."""
    return report.join(runs.run_counts(report.sparkSession, out, report.first()["runId"]).drop("laws"), "runId")


@query
def backfill_run(spark, sf):
    """The whole backfill with all its writes; the stored report and what the run saw."""
    out = run_path(spark, "backfill")
    report = runs.run_backfill(
        spark, raw.sitemap_pages(spark, sf), page_fields_table(spark, sf), out, "backfill_1", raw.TODAY,
        raw.responses(spark, sf, "law-"), attempts=raw.fetch_attempts(spark, sf, "law-"),
    )
    return _with_counts(_flat_report(report), out)


@query
def resumed_run(spark, sf):
    """A backfill of three lots that stopped inside the second one, then resumed; its report.

    Half of the second lot's documents lie in files of an attempt that noted no progress.
    ``stored_rows`` are the outcomes that count: one per law, none of that attempt.
    """
    out = run_path(spark, "resumed")
    pages, fields = raw.sitemap_pages(spark, sf), page_fields_table(spark, sf)
    given = {"responses": raw.responses(spark, sf, "law-"), "attempts": raw.fetch_attempts(spark, sf, "law-")}
    work = runs.work_list(
        spark, plan_versions.current_versions(pages, raw.TODAY), f"{out}/versions/backfill_1"
    )
    rows_per_lot = -(-work.count() // 3)
    runs.write_work(spark, work, fields, out, "backfill_1", rows_per_lot=rows_per_lot, only=[0], **given)
    half = work.where(F.pmod(F.xxhash64("document_id"), F.lit(3)) == 1).where(F.crc32("document_id") % 2 == 0)
    sinks.append_outcomes(runs.run_outcomes(half, fields, **given), f"{out}/outcomes/backfill_1", 1, "aborted")
    report = runs.run_backfill(
        spark, pages, fields, out, "backfill_1", raw.TODAY, rows_per_lot=rows_per_lot, resume=True, **given
    )
    stored = runs.stored_outcomes(spark, out, "backfill_1").agg(F.count(F.lit(1)).alias("stored_rows"))
    return _flat_report(report).join(stored)


def after_checkpoint(spark, name: str, last_run: str) -> str:
    """Folder of daily runs with a stored checkpoint."""
    out = run_path(spark, name)
    past = spark.sql(
        f"SELECT '{last_run}' AS lastRun, 'daily_0' AS runId, TIMESTAMP '2000-01-01' AS committedAt"
    )
    past.write.mode("append").json(f"{out}/checkpoint")
    return out


def _checkpoint(spark, out: str) -> F.Column:
    return F.lit(files.stored_checkpoint(spark, f"{out}/checkpoint").first()["last_run"])


@query
def daily_run(spark, sf):
    """A daily run after a stored checkpoint, with all its writes; the stored report."""
    out = after_checkpoint(spark, "daily", raw.LAST_RUN)
    report = runs.run_daily(
        spark, raw.sitemap_pages(spark, sf), page_fields_table(spark, sf), out, "daily_1",
        raw.TODAY, raw.responses(spark, sf, "law-"), attempts=raw.fetch_attempts(spark, sf, "law-"),
    )
    alerts_ = spark.read.schema("alert STRING, error_rate STRING").json(f"{out}/alerts/run_id=daily_1")
    return _with_counts(_flat_report(report), out).withColumns(
        {"checkpoint": _checkpoint(spark, out), "alerts": F.lit(alerts_.count())}
    )


@query
def empty_daily_run(spark, sf):
    """A daily run without changes: zeros, readable empty documents, and the checkpoint moves."""
    out = after_checkpoint(spark, "empty", "2990-01-01")
    report = runs.run_daily(
        spark, raw.sitemap_pages(spark, sf), page_fields_table(spark, sf), out, "daily_1", raw.TODAY
    )
    documents = spark.read.parquet(f"{out}/documents").count()
    return _flat_report(report).withColumns(
        {"checkpoint": _checkpoint(spark, out), "documents": F.lit(documents)}
    )


@query
def run_quorum(spark, sf):
    """A daily run most of whose sitemap pages failed: it stops, and its checkpoint stays."""
    out = after_checkpoint(spark, "quorum", raw.LAST_RUN)
    pages = raw.failing_sitemap_pages(spark, sf)
    try:
        runs.run_daily(spark, pages, page_fields_table(spark, sf), out, "daily_1", raw.TODAY)
        stopped = False
    except R.QuorumError:
        stopped = True
    return R.quorum(runs.page_loads(pages)).withColumns(
        {"stopped": F.lit(stopped), "checkpoint": _checkpoint(spark, out)}
    )


def _flat_report(report: DataFrame) -> DataFrame:
    reasons = F.concat_ws(
        ",",
        F.transform("topErrorReasons", lambda r: F.concat_ws(":", r["reason"], r["count"])),
    )
    return report.withColumn("topErrorReasons", reasons)


@query
def sample_outcomes(spark, sf):
    return _flat_outcomes(
        runs.sample_outcomes(
            raw.sitemap_pages(spark, sf), page_fields_table(spark, sf), raw.TODAY, 40
        )
    )


# --- reports -------------------------------------------------------------------------


@query
def accumulator_outcomes(spark, sf):
    return files.parse_outcomes(raw.accumulator_lines(spark, sf)).select(
        "kind", "document_id", "reason", "message",
        F.col("legal_act.summary").alias("summary"),
        F.col("legal_act.entry_into_force_date").alias("entry_into_force_date"),
    )


@query
def run_report(spark, sf):
    outcomes = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    return R.run_report(outcomes, "daily", "daily_1", raw.LAST_RUN).drop("reasons")


@query
def nested_run_report(spark, sf):
    outcomes = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    report = R.run_report(outcomes, "backfill", "backfill_1")
    return _flat_report(R.nest_report(report))


@query
def error_reasons(spark, sf):
    outcomes = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    return R.sort_reasons(R.error_reasons(outcomes))


@query
def new_vs_updated(spark, sf):
    outcomes = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    return R.new_vs_updated(E.documents(outcomes), raw.LAST_RUN)


@query
def alerts(spark, sf):
    failed = (F.col("status") == "F") & (F.col("priority").isin("1-URGENT", "2-HIGH"))
    return R.alerts(raw.monthly_reports(spark, sf, failed))


@query
def guarded_commit(spark, sf):
    """Runs that may move the checkpoint, written and read back; the newest wins."""
    failed = (F.col("status") == "F") | (F.col("priority") == "1-URGENT")
    reports = raw.monthly_reports(spark, sf, failed)
    path = f"{run_path(spark, 'commit')}/checkpoint"
    sinks.commit_checkpoint(reports, path, raw.TODAY)
    return files.read_commits(spark, path).select("runId", "lastRun")


@query
def checkpoint_latest(spark, sf):
    """Commits of runs ``daily_1``, ``daily_2`` and so on, one a month: the last in time counts."""
    months = raw.monthly_reports(spark, sf, F.lit(False)).select(
        F.regexp_replace("runId", "run_", "").alias("month"), "fetched", "errors"
    )
    at = F.to_timestamp(F.concat("month", F.lit("-01")))
    number = F.months_between(at, F.lit("1990-01-01").cast("timestamp")).cast("int")
    reports = months.withColumns({"runId": F.concat(F.lit("daily_"), number), "at": at})
    path = f"{run_path(spark, 'latest')}/checkpoint"
    sinks.commit_checkpoint(reports, path, F.col("month"), at=F.col("at"))
    return files.stored_checkpoint(spark, path)


@query
def source_quorum(spark, sf):
    loads = raw.orders(spark, sf).select(
        F.col("k").alias("page"), (F.col("status") != "F").alias("loaded")
    )
    R.require_quorum(loads)
    return R.quorum(loads)


@query
def processed_ids(spark, sf):
    outcomes = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    return U.processed_ids(outcomes, retry_transient=True)


# --- quality -------------------------------------------------------------------------


@query
def schema_violations(spark, sf):
    return Q.schema_violations(Q.check_documents(raw.raw_documents(spark, sf))).select(
        "file", "pos", "violation"
    )


@query
def date_violations(spark, sf):
    checked = Q.check_documents(raw.raw_documents(spark, sf))
    return Q.date_violations(Q.passing_files(checked), "file", "pos")


@query
def title_warnings(spark, sf):
    checked = Q.check_documents(raw.raw_documents(spark, sf))
    return Q.title_warnings(Q.passing_files(checked)).select("file", "pos", "document_id")


@query
def duplicate_ids(spark, sf):
    return Q.duplicate_keys(Q.passing_files(Q.check_documents(raw.raw_documents(spark, sf))))


@query
def file_verdicts(spark, sf):
    return Q.file_verdicts(Q.check_documents(raw.raw_documents(spark, sf)))


@query
def report_verdicts(spark, sf):
    return Q.report_verdicts(raw.raw_reports(spark, sf)).withColumn(
        "missing", F.concat_ws(",", F.sort_array("missing"))
    )


@query
def overall_verdict(spark, sf):
    files_checked = Q.file_verdicts(Q.check_documents(raw.raw_documents(spark, sf)))
    return Q.all_passed(files_checked, Q.report_verdicts(raw.raw_reports(spark, sf)))


# --- lookups -------------------------------------------------------------------------


@query
def act_type_from_eli(spark, sf):
    return L.act_type_from_eli(raw.eli_keys(spark, sf))


@query
def jurisdiction_languages(spark, sf):
    return L.jurisdiction_languages(raw.jurisdiction_keys(spark, sf)).drop("jurisdiction_list")


@query
def jurisdiction_list_languages(spark, sf):
    return L.jurisdiction_languages(
        raw.jurisdiction_keys(spark, sf), "jurisdiction_list", is_list=True
    ).drop("jurisdiction_list", "jurisdiction")


@query
def jurisdiction_membership(spark, sf):
    return raw.jurisdiction_keys(spark, sf).select(
        "c_custkey", L.in_set("jurisdiction", JURISDICTIONS).alias("allowed")
    )


@query
def translation_pairs(spark, sf):
    pair = translation_pair("lang")
    return raw.table(spark, sf, "documents").select(
        "doc_id", pair["source"].alias("pair_source"), pair["target"].alias("pair_target")
    )


@query
def publication_lookup(spark, sf):
    pages = raw.law_pages(spark, sf).select(
        "document_id",
        X.extract_publication_date("html").alias("publication_date"),
        *[c.alias(name) for name, c in X.extract_issue("html").items()],
    )
    return L.fill_publication_date(pages, raw.gazette_issues(spark, sf)).select(
        "document_id", "publication_date"
    )


# --- stored files ---------------------------------------------------------------------


@query
def stored_pages(spark, sf):
    path = run_path(spark, "pages")
    raw.law_pages(spark, sf).write.parquet(path)
    return files.read_pages(spark, path).select("document_id", "url", F.col("html").isNotNull().alias("has_page"))


@query
def stored_documents(spark, sf):
    """Documents of two runs, exported as lines and read back together."""
    path = run_path(spark, "export")
    acts = raw.order_acts(spark, sf).withColumn("legal_act_relations", F.array().cast(S.RELATIONS))
    even = F.col("legal_act.title_short").isNotNull()
    for run, rows in (("a", acts.where(even)), ("b", acts.where(~even))):
        sinks.export_documents(rows, path, run)
    lines = files.read_document_lines(spark, f"{path}/a", f"{path}/b")
    act = F.from_json("raw", S.DOCUMENT)["legal_act"]
    return lines.select(act["document_id"].alias("document_id"), act["url"].alias("url"))


@query
def stored_reports(spark, sf):
    """Reports of a backfill and a daily run, written, read back and judged."""
    path = run_path(spark, "reports")
    outcomes = files.parse_outcomes(raw.accumulator_lines(spark, sf))
    for run, mode in (("a", "backfill"), ("b", "daily")):
        report = R.nest_report(R.run_report(outcomes, mode, run, raw.LAST_RUN))
        sinks.write_run_report(report, path, run)
    read = files.read_written_reports(spark, path)
    parsed = F.from_json("raw", S.RUN_REPORT)
    fields = [parsed[c].alias(c) for c in ("runId", "mode", "newDocuments", "errors")]
    return read.select("file", *fields).join(Q.report_verdicts(read).select("file", "verdict"), "file")


@query
def stored_processed(spark, sf):
    """Ids of a progress file with blank lines, some written twice."""
    path = run_path(spark, "processed")
    lines = raw.table(spark, sf, "customer").select(
        F.explode(F.array(F.lit(""), raw.text("law-", F.floor(F.col("c_custkey") / 2)))).alias("value")
    )
    lines.write.text(path)
    return files.read_processed(spark, path)


# --- snapshots and relations ---------------------------------------------------------


@query
def upsert_snapshot(spark, sf):
    """Customers as the old snapshot; those in debt and all suppliers as the new rows."""
    customer = raw.table(spark, sf, "customer")
    name = raw.text("law-", F.col("c_custkey")).alias("document_id")
    old = customer.select(name, F.col("c_name").alias("title"), F.lit(1).alias("version"))
    changed = customer.where(F.col("c_acctbal") < 0).select(
        name, F.upper("c_name").alias("title"), F.lit(2).alias("version")
    )
    added = raw.table(spark, sf, "supplier").select(
        raw.text("new-", F.col("s_suppkey")).alias("document_id"),
        F.col("s_name").alias("title"), F.lit(2).alias("version"),
    )
    return U.upsert(old, changed.unionByName(added))


@query
def relations_flat(spark, sf):
    nested = N.nest_documents(raw.order_acts(spark, sf), raw.relation_rows(spark, sf), 4)
    return N.flatten_relations(nested)


@query
def nested_documents(spark, sf):
    nested = N.nest_documents(raw.order_acts(spark, sf), raw.relation_rows(spark, sf), 4)
    return nested.groupBy(F.col("legal_act.document_id").alias("document_id")).agg(
        F.sum(
            F.aggregate(
                "legal_act_relations", F.lit(0),
                lambda n, r: n + F.greatest(F.coalesce(F.size(r["concerned_sections"]), F.lit(1)), F.lit(1)),
            )
        ).alias("relation_rows")
    )


@query
def act_table(spark, sf):
    return N.split_act_text(raw.order_acts(spark, sf))[0]


@query
def act_text_table(spark, sf):
    return N.split_act_text(raw.order_acts(spark, sf))[1]


# --- streams -------------------------------------------------------------------------


def _stream(spark, sf, name: str) -> DataFrame:
    """A given table as a file stream. The glob fits a single file and a folder alike."""
    schema = raw.table(spark, sf, name).schema
    return jobs.ingest_stream(spark, f"{sf}/{name[:-1]}[{name[-1]}].parquet", schema)


@query
def stream_ingest_pages(spark, sf):
    out, checkpoint = _fresh(spark, "ingest")
    pages = _stream(spark, sf, "pages").select("page_id", "html")
    job = jobs.write_batches(pages, out, checkpoint, P.extract_laws)
    job.awaitTermination()
    return spark.read.parquet(out).select("page_id", "title", "text_content", "abrogated")


@query
def stream_outcomes(spark, sf):
    """Law pages of streamed orders to outcomes, each batch guarded before it is written."""
    out, checkpoint = _fresh(spark, "outcomes")

    def transform(batch: DataFrame) -> DataFrame:
        laws = P.with_legal_type(P.extract_laws(raw.law_pages_of(batch), with_text=False))
        failed = F.when(F.col("abrogated").isNull(), "transient")
        return E.outcomes(
            laws.withColumn("error_type", failed)
            .withColumn("message", F.when(F.col("abrogated").isNull(), "no stored page"))
            .withColumn("summary", F.lit(None).cast("string"))
        )

    pages = raw.short_orders(_stream(spark, sf, "orders"))
    job = jobs.write_batches(pages, out, checkpoint, transform, guard=0.5)
    job.awaitTermination()
    return _flat_outcomes(jobs.read_published(spark, out, S.OUTCOMES))


@query
def stream_rejected(spark, sf):
    """A batch with too many errors: the stream stops and publishes nothing."""
    out, checkpoint = _fresh(spark, "rejected")
    failed = F.when(F.col("priority") <= "3-MEDIUM", "error").otherwise("document")
    orders = raw.short_orders(_stream(spark, sf, "orders")).select("k", failed.alias("kind"))
    try:
        jobs.write_batches(orders, out, checkpoint, guard=0.5).awaitTermination()
        stopped = False
    except StreamingQueryException as error:
        stopped = "BatchRejected" in str(error)
    published = jobs.read_published(spark, out, orders.schema)
    return published.agg(F.count(F.lit(1)).alias("published")).withColumn("stopped", F.lit(stopped))


@query
def stream_dedup_events(spark, sf):
    """Every event delivered twice, kept once."""
    out, checkpoint = _fresh(spark, "dedup")
    events = _stream(spark, sf, "events").withColumn(
        "delivery", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    unique = jobs.dedup_stream(jobs.with_late_buffer(events, "ts"), ("event_id", "ts"))
    job = jobs.write_batches(unique, out, checkpoint)
    job.awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query
def stream_daily_error_rate(spark, sf):
    out, checkpoint = _fresh(spark, "rate")
    events = jobs.with_late_buffer(_stream(spark, sf, "events"), "ts")
    rates = jobs.error_rate_windows(events, "ts", F.col("event_type") == "error")
    job = jobs.write_batches(rates, out, checkpoint, output_mode="update")
    job.awaitTermination()
    changes = spark.read.parquet(out)
    return jobs.latest_update(changes, "window").select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"), "fetched", "errors",
        (R.error_rate() > 0.2).alias("alert"),
    )


@query
def stream_latest(spark, sf):
    """Latest version per law, kept as a change log over batches and merged on read."""
    out, checkpoint = _fresh(spark, "latest")
    orders = _stream(spark, sf, "orders").select(
        raw.text("law-", F.col("o_custkey")).alias("document_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("entry_date"),
        F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd").alias("lastmod"),
        F.col("o_orderkey").alias("page"),
        F.lit(0).alias("pos"),
    )
    job = jobs.latest_stream(orders, out, checkpoint)
    job.awaitTermination()
    jobs.compact_latest(spark, out, f"{out}-snapshots", orders.schema)
    state = jobs.read_latest(spark, out, f"{out}-snapshots", orders.schema)
    return state.select("document_id", "entry_date", "page")
