"""Run reports, error reasons, alerts and the source quorum."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import constants as K
from lexmill import schemas as S

REASONS = [K.ABROGATED, K.PERMANENT, K.TRANSIENT, K.PARSE_ERROR]


class QuorumError(RuntimeError):
    """Too many source pages could not be loaded."""


def error_rate() -> Column:
    """errors / fetched of a report row, 0 if nothing was fetched."""
    return F.coalesce(F.try_divide(F.col("errors"), F.col("fetched")), F.lit(0.0))


def is_new(entry_date: Column, last_run: str | None) -> Column:
    """Whether a document of a daily run counts as new; never without a checkpoint."""
    if last_run is None:
        return F.lit(False)
    return F.coalesce(entry_date >= F.lit(last_run), F.lit(False))


def new_vs_updated(documents: DataFrame, last_run: str | None) -> DataFrame:
    """One row ``newDocuments, updatedDocuments``."""
    new = is_new(F.col("legal_act.entry_into_force_date"), last_run)
    return documents.agg(
        F.count_if(new).alias("newDocuments"), F.count_if(~new).alias("updatedDocuments")
    )


def run_report(
    outcomes: DataFrame, mode: str, run_id: str, last_run: str | None = None
) -> DataFrame:
    """One row of counts for a run, by one global aggregate. Works on an empty run too.

    ``abrogated`` is given on its own and is also part of ``errors``. ``reasons`` counts the
    reasons that runs give themselves; others, from outside, are only in :func:`error_reasons`.
    """
    document = F.col("kind") == "document"
    act = F.col("legal_act")
    if mode == "backfill":
        new = document
    else:
        new = document & is_new(act.entry_into_force_date, last_run)
    return outcomes.agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(document).alias("extracted"),
        F.count_if(document & (F.coalesce(act.summary, F.lit("")) != "")).alias("enriched"),
        F.count_if(new).alias("newDocuments"),
        F.count_if(document & ~new).alias("updatedDocuments"),
        F.count_if(~document).alias("errors"),
        F.count_if(F.col("reason") == K.ABROGATED).alias("abrogated"),
        F.array(
            *[
                F.struct(
                    F.lit(r).alias("reason"),
                    F.count_if(~document & (F.col("reason") == r)).alias("count"),
                )
                for r in REASONS
            ]
        ).alias("reasons"),
    ).select(F.lit(run_id).alias("runId"), F.lit(mode).alias("mode"), "*")


def error_reasons(outcomes: DataFrame) -> DataFrame:
    """Count per reason."""
    return (
        outcomes.where(F.col("kind") != "document")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def sort_reasons(reasons: DataFrame) -> DataFrame:
    """Most frequent first, ties by name, no cut."""
    return reasons.orderBy(F.desc("count"), "reason")


def nest_report(report: DataFrame) -> DataFrame:
    """Report row in the exchange form, with ``topErrorReasons`` as an array.

    The array holds the closed set of reasons that runs give; it needs no limit and no join.
    """
    seen = F.filter("reasons", lambda r: r["count"] > 0)
    return report.withColumn("topErrorReasons", F.array_sort(seen, _by_count_then_name)).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.RUN_REPORT]
    )


def _by_count_then_name(a: Column, b: Column) -> Column:
    return (
        F.when(a["count"] != b["count"], F.when(a["count"] > b["count"], -1).otherwise(1))
        .when(a["reason"] != b["reason"], F.when(a["reason"] < b["reason"], -1).otherwise(1))
        .otherwise(0)
    )


def alerts(reports: DataFrame, limit: float = K.ALERT_ERROR_RATE) -> DataFrame:
    """A row for each run whose error rate is above ``limit``."""
    rate = error_rate()
    # per cent with one digit, rounded half up in whole numbers
    tenths = F.expr("(2000 * errors + fetched) div (2 * fetched)").alias("tenths")
    return reports.where(rate > limit).select("*", tenths).select(
        F.lit("high_error_rate").alias("alert"),
        "runId",
        "errors",
        "fetched",
        F.concat(
            F.expr("tenths div 10"), F.lit("."), F.expr("tenths % 10"), F.lit("%")
        ).alias("error_rate"),
    )


def committable(reports: DataFrame, max_rate: float = K.COMMIT_ERROR_RATE) -> DataFrame:
    """Reports of runs that may move the checkpoint: error rate below ``max_rate``."""
    return reports.where(error_rate() < max_rate)


def quorum(
    page_loads: DataFrame, max_failed: float = K.QUORUM_MAX_FAILED, expected: int | None = None
) -> DataFrame:
    """One row ``total, failed, reached`` of a load log ``page, loaded``.

    ``expected`` is the number of pages the index lists; those that are absent have failed.
    """
    loaded = F.count_if(F.coalesce(F.col("loaded"), F.lit(False)))
    total = F.greatest(F.count(F.lit(1)), F.lit(expected or 0).cast("long"))
    return page_loads.agg(total.alias("total"), (total - loaded).alias("failed")).withColumn(
        "reached", F.col("failed") <= F.col("total") * max_failed
    )


def require_quorum(
    page_loads: DataFrame, max_failed: float = K.QUORUM_MAX_FAILED, expected: int | None = None
) -> None:
    """Raise if more than ``max_failed`` of the pages could not be loaded or are absent."""
    row = quorum(page_loads, max_failed, expected).first()
    if not row["reached"]:
        raise QuorumError(f"{row['failed']} of {row['total']} source pages failed")
