"""Whole runs with their files."""

import pytest
from conftest import rows
from pyspark.sql import Row
from pyspark.sql import functions as F

from lexmill import schemas as S
from lexmill.operators import snapshots as U
from lexmill.plans import runs
from lexmill.plans.validation import validate
from lexmill.sources import files, sinks

H = "https://h/lrgv/gesetz"


def sitemap(spark, *entries):
    xml = "".join(f"<url><loc>{u}</loc><lastmod>{m}</lastmod></url>" for u, m in entries)
    return spark.createDataFrame([(1, xml)], "page INT, xml STRING")


def law_pages(spark, *pages):
    return spark.createDataFrame(list(pages), "url STRING, html STRING")


SITES = [
    (f"{H}/01012020-a", "2026-04-08"), (f"{H}/01012019-a", "2026-04-09"),
    (f"{H}/09042026-b/", "2026-04-09"), (f"{H}/01012020-c", "2026-01-01"),
    (f"{H}/01012020-d", "2026-04-09"),
]
PAGES = [
    (f"{H}/01012020-a", "<h1>A</h1>text"), (f"{H}/09042026-b/", "<h1>B</h1>"),
    (f"{H}/01012020-c", '<p class="aufgehoben">'), (f"{H}/01012019-a", "old"),
]


def fields(spark, path, *pages):
    """The pages, ingested."""
    return runs.ingest_pages(spark, law_pages(spark, *pages), str(path))


def responses(spark):
    text = '{"candidates":[{"content":{"parts":[{"text":"S"}]}}]}'
    return spark.createDataFrame([("a", text)], "document_id STRING, response STRING")


def test_backfill_and_resume(spark, tmp_path):
    out = str(tmp_path)
    args = (spark, sitemap(spark, *SITES), fields(spark, tmp_path / "fields", *PAGES), out)
    report = runs.run_backfill(*args, "backfill_1", "2026-04-10", responses(spark))
    expected = ("backfill_1", "backfill", 4, 2, 1, 2, 0, 2)
    assert tuple(report.first())[:8] == expected
    assert [tuple(r) for r in report.first()["topErrorReasons"]] == [
        ("abrogated", 1), ("http_error_transient", 1),
    ]
    # the same run again replaces its files
    again = runs.run_backfill(*args, "backfill_1", "2026-04-10", responses(spark))
    assert tuple(again.first())[:8] == expected
    stored = runs.stored_outcomes(spark, out, "backfill_1")
    assert stored.count() == 4
    # a resumed run leaves out what has an outcome, or tries transient failures again
    for retry, left in ((False, 0), (True, 1)):
        done = U.processed_ids(stored, retry_transient=retry)
        resumed = runs.run_backfill(
            *args, f"backfill_{2 + retry}", "2026-04-10", processed=done
        )
        assert resumed.first()["fetched"] == left
    documents = spark.read.parquet(f"{out}/documents")
    assert rows(documents.groupBy("run_id").count()) == [("backfill_1", 2)]


def test_export_passes_validation(spark, tmp_path):
    out = str(tmp_path)
    runs.run_backfill(
        spark, sitemap(spark, *SITES), fields(spark, tmp_path / "fields", *PAGES), out, "backfill_1",
        "2026-04-10",
    )
    documents = spark.read.parquet(f"{out}/documents")
    sinks.export_documents(documents, f"{out}/export", "backfill_1")
    by_file, by_report, overall = validate(
        files.read_document_lines(spark, f"{out}/export/backfill_1"),
        spark.read.text(f"{out}/reports/run_report_backfill_1", wholetext=True)
        .selectExpr("_metadata.file_name AS file", "value AS raw"),
        f"{out}/verdicts",
    )
    assert {r["verdict"] for r in by_file.collect()} == {"OK"}
    assert {r["verdict"] for r in by_report.collect()} == {"OK"}
    assert rows(overall) == [(True,)]


def test_daily(spark, tmp_path):
    out = str(tmp_path)
    pages = fields(spark, tmp_path / "fields", *PAGES)
    # no checkpoint: changes since yesterday less two days, and nothing counts as new
    first = runs.run_daily(
        spark, sitemap(spark, *SITES), pages, out, "daily_1", "2026-04-10"
    ).first()
    assert tuple(first)[:8] == ("daily_1", "daily", 3, 2, 0, 0, 2, 1)
    control = f"{out}/checkpoint"
    assert rows(files.stored_checkpoint(spark, control)) == [("2026-04-10",)]
    second = runs.run_daily(
        spark, sitemap(spark, (f"{H}/10042026-b/", "2026-04-10"), *SITES[:1]),
        fields(spark, tmp_path / "fields2", (f"{H}/10042026-b/", "<h1>B</h1>"), *PAGES[:1]), out,
        "daily_2", "2026-04-11",
    ).first()
    assert tuple(second)[3:8] == (2, 0, 1, 1, 0)
    # nothing changed: zeros, and the checkpoint moves
    third = runs.run_daily(
        spark, sitemap(spark, SITES[3]), pages, out, "daily_3", "2026-04-12"
    ).first()
    assert tuple(third)[2:] == (0, 0, 0, 0, 0, 0, [])
    assert spark.read.parquet(f"{out}/documents/run_id=daily_3").count() == 0
    assert spark.read.text(f"{out}/alerts/run_id=daily_3").count() == 0
    assert rows(files.stored_checkpoint(spark, control)) == [("2026-04-12",)]
    # half of the pages failed: the checkpoint stays
    changed = [(f"{H}/01012020-a", "2026-04-12"), (f"{H}/01012020-x", "2026-04-12")]
    runs.run_daily(spark, sitemap(spark, *changed), pages, out, "daily_4", "2026-04-13")
    assert rows(files.stored_checkpoint(spark, control)) == [("2026-04-12",)]
    assert spark.read.json(f"{out}/alerts/run_id=daily_4").first()["error_rate"] == "50.0%"


def test_quorum_stops_a_run_before_it_writes(spark, tmp_path):
    out = str(tmp_path / "out")
    known = fields(spark, tmp_path / "fields", *PAGES)
    good = sitemap(spark, *SITES)
    broken = spark.createDataFrame([(2, None), (3, "")], "page INT, xml STRING")
    with pytest.raises(runs.R.QuorumError):
        runs.run_daily(spark, good.unionByName(broken), known, out, "daily_1", "2026-04-10")
    assert not (tmp_path / "out").exists()
    # exactly half may fail
    half = good.unionByName(broken.limit(1))
    assert runs.run_backfill(spark, half, known, out, "b", "2026-04-10").first()["fetched"] == 4
    # the index lists three sitemaps, one is there
    index = spark.createDataFrame([("<sitemap>" * 3,)], "index_xml STRING")
    with pytest.raises(runs.R.QuorumError, match="2 of 3"):
        runs.run_backfill(spark, good, known, out, "b2", "2026-04-10", index=index)


def test_fetch_log_decides(spark, tmp_path):
    log = spark.createDataFrame(
        [("b", 1, 404, "HTTP 404"), ("a", 1, 503, "HTTP 503"), ("a", 2, 200, None), ("d", 1, 200, None)],
        "document_id STRING, attempt INT, status INT, error STRING",
    )
    report = runs.run_backfill(
        spark, sitemap(spark, *SITES), fields(spark, tmp_path / "fields", *PAGES), str(tmp_path / "out"),
        "b", "2026-04-10", attempts=log,
    ).first()
    assert [tuple(r) for r in report["topErrorReasons"]] == [
        ("abrogated", 1), ("http_error_permanent", 1), ("http_error_transient", 1),
    ]


def test_aborted_run_goes_on(spark, tmp_path):
    out, sites = str(tmp_path / "out"), sitemap(spark, *SITES)
    known = fields(spark, tmp_path / "fields", *PAGES)
    whole = runs.run_backfill(spark, sites, known, str(tmp_path / "whole"), "b", "2026-04-10").first()
    work = runs.work_list(spark, runs.current_versions(sites, "2026-04-10"), f"{out}/versions/b")
    runs.write_work(spark, work, known, out, "b", rows_per_lot=2, only=[1])
    before = runs.stored_outcomes(spark, out, "b").count()
    # an attempt that was lost inside the other lot: files, but no progress
    sinks.append_outcomes(runs.run_outcomes(work.limit(1), known), f"{out}/outcomes/b", 0, "aborted")
    assert runs.stored_outcomes(spark, out, "b").count() == before < 4
    report = runs.run_backfill(spark, sites, known, out, "b", "2026-04-10", rows_per_lot=2, resume=True)
    assert report.first() == whole
    assert runs.stored_outcomes(spark, out, "b").count() == 4
    assert rows(runs.run_counts(spark, out, "b")) == [("b", 5, 4, 4 - before, before)]
    # resumed again, nothing is left to do and nothing is lost
    again = runs.run_backfill(spark, sites, known, out, "b", "2026-04-10", resume=True)
    assert again.first() == whole
    assert rows(runs.run_counts(spark, out, "b")) == [("b", 5, 4, 0, 4)]


def test_lots_follow_from_the_work(spark, tmp_path):
    out, sites = str(tmp_path / "out"), sitemap(spark, *SITES)
    known = fields(spark, tmp_path / "fields", *PAGES)
    runs.run_backfill(spark, sites, known, out, "b", "2026-04-10", rows_per_lot=1)
    lots = files.read_progress(spark, f"{out}/progress/b")
    assert rows(lots, "lot") == [(0,), (1,), (2,), (3,)]
    # a new start of the run: nothing of the old one counts
    runs.run_backfill(spark, sites, known, out, "b", "2026-04-10")
    assert rows(files.read_progress(spark, f"{out}/progress/b"), "lot") == [(0,)]
    assert runs.stored_outcomes(spark, out, "b").count() == 4


def test_counts_of_a_run(spark, tmp_path):
    out, sites = str(tmp_path / "out"), sitemap(spark, *SITES)
    known = fields(spark, tmp_path / "fields", *PAGES)
    done = spark.createDataFrame([("a",), ("zz",)], "document_id STRING")
    runs.run_backfill(spark, sites, known, out, "b", "2026-04-10", processed=done)
    assert rows(runs.run_counts(spark, out, "b")) == [("b", 5, 4, 3, 1)]
    # an empty stage takes its counts along; they are counted again
    runs.run_daily(spark, sites, known, out, "d", "2027-01-01", head=Row(run_id=None, last_run="2026-12-01"))
    assert rows(runs.run_counts(spark, out, "d")) == [("d", 5, 0, 0, 0)]


def test_of_two_runs_from_one_checkpoint_the_first_commits(spark, tmp_path):
    out, sites = str(tmp_path / "out"), sitemap(spark, *SITES)
    pages = fields(spark, tmp_path / "fields", *PAGES)
    control = f"{out}/checkpoint"
    head = files.checkpoint_head(spark, control).first()
    assert head == Row(run_id=None, last_run=None)
    runs.run_daily(spark, sites, pages, out, "a", "2026-04-10", head=head)
    runs.run_daily(spark, sites, pages, out, "b", "2026-04-11", head=head)
    assert files.checkpoint_head(spark, control).first() == Row(run_id="a", last_run="2026-04-10")
    # what follows the void commit is void, what follows the valid one counts
    none = spark.createDataFrame([(0, 0)], "errors LONG, fetched LONG")
    for run, day, follows in (("c", "2026-04-12", "b"), ("d", "2026-04-13", "a")):
        sinks.commit_checkpoint(none.selectExpr(f"'{run}' AS runId", "*"), control, day, guarded=True, follows=follows)
        assert files.checkpoint_head(spark, control).first()["run_id"] == ("a" if run == "c" else "d")
    # the same run again, as after a lost driver, commits over itself
    runs.run_daily(spark, sitemap(spark, SITES[3]), pages, out, "e", "2026-04-14")
    runs.run_daily(spark, sitemap(spark, SITES[3]), pages, out, "e", "2026-04-15")
    assert files.checkpoint_head(spark, control).first() == Row(run_id="e", last_run="2026-04-15")


def test_newest_fetch_of_a_page_counts(spark, tmp_path):
    pages = spark.createDataFrame(
        [("u", "<h1>Old</h1>", "2026-01-01"), ("u", "<h1>New</h1>", "2026-02-01"), ("v", None, None)],
        "url STRING, html STRING, fetched_at STRING",
    ).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    got = runs.ingest_pages(spark, pages, str(tmp_path / "fields"))
    assert rows(got, "url", "title") == [("u", "New"), ("v", None)]


def test_sample(spark, tmp_path):
    known = fields(spark, tmp_path / "fields", *PAGES)
    got = runs.sample_outcomes(sitemap(spark, *SITES), known, "2026-04-10", 2)
    assert rows(got, "document_id", "kind") == [("a", "document"), ("b", "document")]


def test_page_scans(spark, tmp_path):
    (tmp_path / "p.html").write_text("<h1>Ä</h1>", encoding="utf-8")
    assert rows(files.read_page_files(spark, str(tmp_path))) == [("p.html", "<h1>Ä</h1>")]
    frame = spark.createDataFrame([("a", "gesetz", "u", "2020-01-01", "x")], S.LAW_PAGES)
    frame.write.parquet(str(tmp_path / "pages"))
    assert rows(files.read_pages(spark, str(tmp_path / "pages"))) == rows(frame)


def test_sample_reads_pages_until_the_laws_are_known(spark, tmp_path):
    # page p holds law p // 3; a later version of law 0 lies on the last page
    pages = [(p, f"<url><loc>{H}/01012020-l{p // 3}</loc></url>") for p in range(300)]
    pages.append((300, f"<url><loc>{H}/01012021-l0</loc></url>"))
    frame = spark.createDataFrame(pages, "page INT, xml STRING")
    frame.repartitionByRange(16, "page").write.parquet(str(tmp_path / "pages"))
    stored = spark.read.schema(frame.schema).parquet(str(tmp_path / "pages"))
    got = runs.sample_versions(stored, "2026-04-10", 5)
    assert rows(got, "document_id", "entry_date") == [(f"l{i}", "2020-01-01") for i in range(5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(page,12)" in plan
    # fewer laws than asked for: all pages are read, and the later version counts
    every = runs.sample_versions(stored, "2026-04-10", 1000)
    assert every.count() == 100 and rows(every.where("document_id = 'l0'"), "entry_date") == [("2021-01-01",)]
    assert runs.sample_versions(stored.where("false"), "2026-04-10", 5).count() == 0


def test_pages_fetched_once_are_not_sorted(spark, tmp_path, monkeypatch):
    """Only addresses that repeat are compared; null is one of them."""
    compared = []
    real = runs._stored
    monkeypatch.setattr(runs, "_stored", lambda s, r, name: compared.append(name) or real(s, r, name))
    once = law_pages(spark, ("u", "<h1>A</h1>"), ("v", None))
    assert rows(runs.ingest_pages(spark, once, str(tmp_path / "a")), "url", "title") == [("u", "A"), ("v", None)]
    assert compared == ["repeated"]
    twice = once.unionByName(law_pages(spark, ("u", "<h1>B</h1>"), (None, "<h1>C</h1>"), (None, "<h1>D</h1>")))
    got = rows(runs.ingest_pages(spark, twice, str(tmp_path / "b")), "url", "title")
    assert got == sorted([("u", "B"), ("v", None), (None, "D")], key=repr)
