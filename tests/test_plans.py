"""The plans Spark makes: pruned scans, map-side combine, split skew, no cross joins."""

import re
from contextlib import contextmanager
from itertools import pairwise

from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexmill import session
from lexmill.operators import enrich, pages, versions
from lexmill.sources import sitemaps

SF = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    """Session settings for a while; dots are written as double underscores."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(frame, kind="executedPlan"):
    return getattr(frame._jdf.queryExecution(), kind)().toString()


def test_scan_reads_only_used_columns(spark):
    text = plan(entry.queries()["page_titles"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in text


def test_no_cross_joins_and_no_python(spark):
    for name in ("enriched_documents", "backfill_outcomes", "file_verdicts", "publication_lookup",
                 "nested_documents", "nested_run_report", "jurisdiction_languages"):
        text = plan(entry.queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert "Python" not in text and "Pandas" not in text, name


def test_latest_version_combines_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr(
        "'hot' AS document_id", "string(id) AS entry_date", "1 AS page", "int(id) AS pos"
    )
    result = versions.latest_version(frame.repartition(8))
    assert plan(result).count("partial_max_by") == 1
    written = result.collect()
    assert [r["entry_date"] for r in written] == ["999"]


def test_pages_are_not_shuffled(spark):
    text = plan(entry.queries()["backfill_outcomes"](spark, SF))
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "html" not in line


def test_page_fields_are_computed_once(spark):
    frame = spark.createDataFrame([("a", "<main>x</main>")], "document_id STRING, html STRING")
    laws = pages.extract_laws(frame).withColumn("error_type", F.lit(None).cast("string"))
    text = plan(enrich.enrichable(laws), "optimizedPlan")
    # of the fields with two patterns the first may stand twice, for its null test
    for word in ("<h1[", "<main[", "<article[", "Fundstelle", 'class="', "letzte[",
                 "Ausfertigungsdatum.", "lower("):
        assert text.count(word) == 1, word


def test_requests_take_the_text_of_laws_in_force_only(spark):
    page = '<body class="{}"><h1>T</h1><main>{}</main>Fundstelle 01.02.2003</body>'
    frame = spark.createDataFrame(
        [("a", page.format("law", "x <b>y</b>")), ("b", page.format("Aufgehoben", "x")), ("c", None),
         ("d", page.format("law", " ")), ("e", page.format("law", "aufgehoben")), (None, page.format("law", "n")),
         ("a", page.format("law", "x <b>y</b>"))],
        "document_id STRING, html STRING",
    )
    attempts = spark.createDataFrame(
        [("a", 1, 503, "e"), ("a", 2, 200, None), ("e", 1, 404, "e"), ("d", 1, 200, None), (None, 1, 404, "e")],
        "document_id STRING, attempt INT, status INT, error STRING",
    )
    laws = pages.extract_laws(frame).join(pages.fetch_outcome(attempts), "document_id", "left")
    assert laws.columns[:2] + laws.columns[6:8] == ["document_id", "abrogated", "publication_date", "text_content"]
    error = F.when(F.col("fetch_outcome") != "ok", F.col("fetch_outcome")).when(
        F.col("abrogated").isNull(), "transient"
    )
    requests = enrich.summary_requests(laws.withColumn("error_type", error))
    assert rows(requests, "document_id", "prompt") == [
        ("a", "Titel: T\n\nText:\nx y"), ("a", "Titel: T\n\nText:\nx y"), (None, "Titel: T\n\nText:\nn"),
    ]
    text = plan(requests, "optimizedPlan")
    for word in ("<h1[", "<main[", "<article[", 'class="', "lower("):
        assert text.count(word) == 1, word
    for word in ("Fundstelle", "zuletzt", "Ausfertigungsdatum", "Abk.rzung"):  # nobody reads these
        assert word not in text, word
    lines = text.splitlines()
    join, marked, taken = [
        next(i for i, line in enumerate(lines) if word in line) for word in ("Join", 'class="', "<main[")
    ]
    filters = [i for i, line in enumerate(lines) if "Filter" in line]
    assert any(taken < i < marked for i in filters)  # abrogated laws leave before the text is taken
    assert any(join < i < taken for i in filters)  # empty texts leave before the join
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "SortAggregate" not in plan(requests)  # the message of an outcome is not read


def test_sitemap_fields_are_taken_of_law_blocks_only(spark):
    law = "https://x/1/lrgv/gesetz/01022003-a"
    xml = (
        f"<url><loc> {law} </loc><lastmod>2003-01-01</lastmod></url><url><lastmod>/lrgv/</lastmod></url>"
        f"<url><loc>https://x/</loc>{law}</url><url><loc>{law}/more/</loc></url><url><loc>{law}b</loc><lastmod> </lastmod></url>"
    )
    frame = spark.createDataFrame([(1, xml), (2, None), (3, "")], "page INT, xml STRING")
    entries = sitemaps.law_entries(frame)
    got = sorted(map(tuple, entries.select("page", "pos", "url", "lastmod", "document_id").collect()))
    assert got == [(1, 0, law, "2003-01-01", "a"), (1, 4, f"{law}b", None, "ab")]
    text = plan(entries.where(F.col("lastmod") >= "2003"), "optimizedPlan")
    assert "lambda" not in text  # compiled, not evaluated node by node
    for word in ("<loc>", "<lastmod>", "/lrgv/["):
        assert text.count(word) == 1, word
    lines = text.splitlines()
    test = next(i for i, line in enumerate(lines) if "Contains(block" in line)
    taken = next(i for i, line in enumerate(lines) if "<loc>" in line)
    assert test > taken  # the filter is below the step that takes the fields


def test_summaries_join_without_a_shuffle_of_their_own(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(entry.queries()["backfill_outcomes"](spark, SF))
    assert text.count("Exchange hashpartitioning(document_id") == 2
    assert text.count("Exchange hashpartitioning(url") == 2


def test_hot_key_of_a_join_is_split(spark):
    with settings(
        spark,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        entries = spark.range(0, 30_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 'hot', concat('k', id)) AS document_id", "sha2(string(id), 256) AS x"
        )
        done = spark.range(100).selectExpr("concat('k', id) AS document_id")
        left = versions.resume(entries, done)
        assert len(left.collect()) == 30_000 - 66
        assert "skew=true" in plan(left)


def test_rows_of_a_large_document_never_meet(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(entry.queries()["nested_documents"](spark, SF))
    # relations are read once and shuffled once, by document and part
    keys = re.findall(r"hashpartitioning\((source_document_id#\d+L?)(, \w+)?", text)
    assert {rest for _, rest in keys} == {", part"}
    assert text.count("l_partkey#") and len(re.findall(r"FileScan parquet \[l_orderkey", text)) == 1


def test_runs_never_read_a_page_again(spark):
    for name in ("backfill_outcomes", "backfill_requests", "sample_outcomes"):
        assert "html" not in plan(entry.queries()[name](spark, SF), "optimizedPlan"), name


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.run_path(spark, "x").startswith(folder.rstrip("/"))
    assert session.run_path(spark, "x") != session.run_path(spark, "x")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert rows(entry.entry(spark), "document_id")
