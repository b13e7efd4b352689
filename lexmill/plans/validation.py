"""Validation of written documents and reports."""

from pyspark.sql import DataFrame, SparkSession

from lexmill.operators import quality as Q


def _stored(spark: SparkSession, verdicts: DataFrame, path: str) -> DataFrame:
    verdicts.write.mode("overwrite").parquet(path)
    return spark.read.schema(verdicts.schema).parquet(path)


def validate(
    docs: DataFrame, reports: DataFrame, out: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verdict per document file, verdict per report, and the one-row overall result.

    Verdicts are stored under ``out``; the overall result reads them, so nothing is checked twice.
    """
    spark, out = docs.sparkSession, out.rstrip("/")
    file_verdicts = _stored(spark, Q.file_verdicts(Q.check_documents(docs)), f"{out}/files")
    report_verdicts = _stored(spark, Q.report_verdicts(reports), f"{out}/reports")
    return file_verdicts, report_verdicts, Q.all_passed(file_verdicts, report_verdicts)
