"""Accumulators, run reports, alerts and checkpoints."""

import pytest
from pyspark.sql import functions as F
from conftest import rows

from lexmill import constants as K
from lexmill import schemas as S
from lexmill.operators import reports as R
from lexmill.sources import files, sinks

# entry dates and summaries of a recorded daily run of 16 documents, checkpoint 2026-04-05
DAILY = ["2026-04-24", "2026-04-15", "2026-04-05"] + ["2026-04-01"] * 3 + ["2025-01-01"] * 10


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def document(key, date="2020-01-01", summary='"s"'):
    return (
        f'{{"legal_act":{{"document_id":"{key}","summary":{summary},'
        f'"entry_into_force_date":"{date}"}},"legal_act_relations":[]}}'
    )


def error(reason):
    return f'{{"_error":true,"documentId":"x","reason":"{reason}","message":"m"}}'


def outcomes(spark, *texts):
    return files.parse_outcomes(lines(spark, *texts))


def test_accumulator_lines(spark, tmp_path):
    texts = [
        document("a"), "", "  \t", '{"legal_act":{"document_id":', "null", "123", "[1]",
        error("r"), '{"_error":false,"legal_act":{}}',
    ]
    got = rows(outcomes(spark, *texts), "kind", "document_id", "reason")
    assert got == sorted(
        [("document", "a", None), ("document", None, None), ("error", "x", "r")]
        + [("parse_error", None, "parse_error")] * 4, key=repr,
    )
    (tmp_path / "acc.ndjson").write_text("\n".join(texts))
    assert rows(files.read_accumulator(spark, str(tmp_path)), "kind", "document_id", "reason") == got


def test_recorded_daily_run(spark):
    frame = outcomes(spark, *[document(str(i), d) for i, d in enumerate(DAILY)])
    report = R.run_report(frame, "daily", "r", "2026-04-05").drop("reasons").first().asDict()
    assert report == {
        "runId": "r", "mode": "daily", "fetched": 16, "extracted": 16, "enriched": 16,
        "newDocuments": 3, "updatedDocuments": 13, "errors": 0, "abrogated": 0,
    }
    # without a checkpoint nothing is new
    assert R.run_report(frame, "daily", "r", None).first()["newDocuments"] == 0
    documents = frame.select("legal_act")
    assert rows(R.new_vs_updated(documents, "2026-04-05")) == [(3, 13)]
    assert rows(R.new_vs_updated(documents, None)) == [(0, 16)]


def test_backfill_report(spark):
    frame = outcomes(
        spark, document("a"), document("b", summary='""'), document("c", summary="null"),
        error(K.ABROGATED), error(K.TRANSIENT), error(K.TRANSIENT), "broken",
    )
    report = R.run_report(frame, "backfill", "r")
    nested = R.nest_report(report)
    assert nested.schema["topErrorReasons"].dataType == S.RUN_REPORT["topErrorReasons"].dataType
    row = nested.first()
    assert tuple(row)[:8] == ("r", "backfill", 7, 3, 1, 3, 0, 4)
    # ties in the name's order, nothing cut
    assert [tuple(r) for r in row["topErrorReasons"]] == [
        (K.TRANSIENT, 2), (K.ABROGATED, 1), (K.PARSE_ERROR, 1),
    ]


def test_empty_run(spark):
    frame = outcomes(spark)
    report = R.run_report(frame, "daily", "r", "2026-01-01")
    nested = R.nest_report(report).first()
    assert tuple(nested) == ("r", "daily", 0, 0, 0, 0, 0, 0, [])
    assert report.select(R.error_rate()).first()[0] == 0.0


def test_reasons_from_outside(spark):
    frame = outcomes(spark, *[error(f"r{i}") for i in range(2000)], error(K.TRANSIENT))
    nested = R.nest_report(R.run_report(frame, "backfill", "r")).first()
    # a run counts its own reasons in the report; the flat table has all
    assert [tuple(r) for r in nested["topErrorReasons"]] == [(K.TRANSIENT, 1)]
    assert nested["errors"] == 2001
    assert R.sort_reasons(R.error_reasons(frame)).count() == 2001


def reports(spark, *counts):
    data = [(f"r{i}", errors, fetched) for i, (errors, fetched) in enumerate(counts)]
    return spark.createDataFrame(data, "runId STRING, errors BIGINT, fetched BIGINT")


def test_alert_boundary(spark):
    frame = reports(spark, (1, 10), (11, 100), (0, 0), (1, 3))
    assert rows(R.alerts(frame), "runId", "error_rate") == [("r1", "11.0%"), ("r3", "33.3%")]


def test_quorum(spark):
    def loads(*flags):
        return spark.createDataFrame(list(enumerate(flags)), "page INT, loaded BOOLEAN")

    R.require_quorum(loads(True, False))
    R.require_quorum(loads(True, True, None))
    with pytest.raises(R.QuorumError, match="2 of 3"):
        R.require_quorum(loads(True, False, None))


def test_checkpoint(spark, tmp_path):
    path = str(tmp_path / "checkpoint")
    assert rows(files.read_checkpoint(spark, path, "2026-04-10")) == [("2026-04-09",)]
    assert rows(files.stored_checkpoint(spark, path)) == [(None,)]
    sinks.commit_checkpoint(reports(spark, (0, 0)).limit(1), path, "2026-04-10")
    assert rows(files.read_checkpoint(spark, path, "2026-05-01")) == [("2026-04-10",)]
    half = reports(spark, (9, 9), (1, 2)).where("runId = 'r1'")
    sinks.commit_checkpoint(half, path, "2026-04-11")
    assert rows(files.read_checkpoint(spark, path, "2026-05-01")) == [("2026-04-10",)]
    better = reports(spark, (9, 9), (49, 100)).where("runId = 'r1'")
    sinks.commit_checkpoint(better, path, "2026-04-12")
    assert rows(files.read_checkpoint(spark, path, "2026-05-01")) == [("2026-04-12",)]


def test_the_last_commit_counts(spark, tmp_path):
    path = str(tmp_path / "checkpoint")
    for day, run in (("2026-04-09", "daily_9"), ("2026-04-10", "daily_10")):
        report = reports(spark, (0, 5)).selectExpr(f"'{run}' AS runId", "errors", "fetched")
        sinks.commit_checkpoint(report, path, day, at=F.lit(f"{day} 08:00:00"))
    assert rows(files.stored_checkpoint(spark, path)) == [("2026-04-10",)]


def test_absent_sitemaps_count_as_failed(spark):
    loads = spark.createDataFrame([(1, True), (2, None)], "page INT, loaded BOOLEAN")
    R.require_quorum(loads, expected=2)
    with pytest.raises(R.QuorumError, match="2 of 3"):
        R.require_quorum(loads, expected=3)


def test_processed_file(spark, tmp_path):
    assert files.read_processed(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "p.txt").write_text("a\n\nb\na\n")
    assert rows(files.read_processed(spark, str(tmp_path / "p.txt"))) == [("a",), ("b",)]
