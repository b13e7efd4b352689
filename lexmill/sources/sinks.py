"""Writers. A repeated write of the same run or batch replaces it and never doubles it."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill import schemas as S
from lexmill.operators.reports import committable


def write_documents(documents: DataFrame, path: str, run_id: str) -> None:
    """Documents of a run as the Parquet partition ``run_id``.

    A run without documents leaves a file without rows, so the table can be read.
    """
    documents.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def export_documents(documents: DataFrame, path: str, run_id: str) -> None:
    """Documents of a run as NDJSON, nulls written, under ``path/run_id``."""
    documents.select("legal_act", "legal_act_relations").write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(f"{path.rstrip('/')}/{run_id}")


def append_outcomes(outcomes: DataFrame, path: str, lot: int, attempt: str) -> None:
    """Outcomes of one attempt at a lot, in a folder of its own.

    They count once :func:`write_progress` names the attempt; what an aborted one left never does.
    """
    outcomes.write.mode("overwrite").parquet(f"{path.rstrip('/')}/lot={lot}/attempt={attempt}")


def write_progress(spark: SparkSession, path: str, start: str, lot: int | None, attempt: str | None) -> None:
    """Note that an attempt finished its lot, or, without a lot, that a run started anew."""
    row = spark.range(1).select(
        F.lit(start).alias("start"), F.lit(lot).cast("int").alias("lot"),
        F.lit(attempt).cast("string").alias("attempt"), F.current_timestamp().alias("finishedAt"),
    )
    row.coalesce(1).write.mode("append").parquet(path)


def write_counts(spark: SparkSession, counts: dict[str, int], path: str, run_id: str) -> None:
    """Entries, laws, remaining and skipped laws of a run, as one row."""
    row = [F.lit(run_id).alias("runId")] + [
        F.lit(counts.get(f.name)).cast("long").alias(f.name) for f in S.RUN_COUNTS.fields[1:]
    ]
    spark.range(1).select(*row).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{run_id}")


def clear_outcomes(spark, path: str, schema) -> None:
    """Drop the outcomes of an earlier start of a run that begins anew."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_reasons(reasons: DataFrame, path: str, run_id: str) -> None:
    """Error reasons of a run, any number of them, as rows ``runId, reason, count``."""
    reasons.select(F.lit(run_id).alias("runId"), "reason", "count").write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/run_id={run_id}"
    )


def write_alerts(alerts: DataFrame, path: str, run_id: str) -> None:
    """Alerts of a run as JSON lines, none if it went well."""
    alerts.write.mode("overwrite").json(f"{path.rstrip('/')}/run_id={run_id}")


def write_run_report(report: DataFrame, path: str, run_id: str) -> None:
    """One report row as JSON, in a folder named by the run."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(
        f"{path.rstrip('/')}/run_report_{run_id}"
    )


def write_report_file(report: DataFrame, path: str, run_id: str) -> None:
    """One report row as the single file ``run_report_<run_id>.json``, as the exchange format names it."""
    text = report.select(F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"})).first()[0]  # one row
    session = report.sparkSession
    target = session._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/run_report_{run_id}.json")
    stream = target.getFileSystem(session._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def commit_checkpoint(
    report: DataFrame,
    path: str,
    today: str | Column,
    max_rate: float = K.COMMIT_ERROR_RATE,
    at: Column | None = None,
    guarded: bool = False,
    follows: str | None = None,
) -> None:
    """Append ``lastRun = today`` if the run's error rate is below ``max_rate``.

    The decision is a filter on the one-row report: a bad run appends no row. Read the
    report back from its table first, so that nothing is computed twice. ``at`` is the time of
    the commit, now by default. A ``guarded`` commit names the run whose commit it ``follows``
    (None: there was none) and counts only if that one is still the last; see ``checkpoint_head``.
    """
    at = F.current_timestamp() if at is None else at
    committable(report, max_rate).select(
        F.lit(today).alias("lastRun") if isinstance(today, str) else today.alias("lastRun"),
        "runId", at.cast("timestamp").alias("committedAt"),
        F.lit(follows).cast("string").alias("follows"), F.lit(guarded).alias("guarded"),
    ).write.mode("append").json(path)
