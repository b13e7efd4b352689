"""Scans of pages, accumulators, documents, reports and control tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill import constants as K
from lexmill import schemas as S
from lexmill.functions.text import compute_once, strip
from lexmill.sources.arrays import read_array_files


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored law pages, Parquet with the columns of ``LAW_PAGES``."""
    return spark.read.schema(S.LAW_PAGES).parquet(path)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Pages stored as one UTF-8 file each: ``file, html``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("html")
    )


def parse_outcomes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Accumulator lines to outcomes of kind document, error or parse_error.

    Blank lines are skipped. A line that is no JSON object is a parse error, not a failure
    of the job. Other columns of ``lines`` are kept.
    """
    others = [c for c in lines.columns if c != value]
    record = F.col("_record")
    stripped = lines.select(*others, strip(value).alias("_line")).where("_line != ''")
    # a value that parses and opens with a brace is an object
    parsed = compute_once(
        stripped, _record=F.when(F.col("_line").startswith("{"), F.try_parse_json("_line"))
    ).drop("_line")
    is_error = F.coalesce(F.try_variant_get(record, "$._error", "boolean"), F.lit(False))
    kind = (
        F.when(record.isNull(), K.PARSE_ERROR).when(is_error, "error").otherwise("document")
    )

    def text(path: str) -> Column:
        return F.try_variant_get(record, path, "string")

    act = F.struct(
        *[
            F.try_variant_get(record, f"$.legal_act.{f.name}", f.dataType.simpleString()).alias(
                f.name
            )
            for f in S.LEGAL_ACT
        ]
    )
    kinds = parsed.select("*", kind.alias("kind"))
    is_document = F.col("kind") == "document"
    return kinds.select(
        *others,
        "kind",
        F.when(is_document, text("$.legal_act.document_id"))
        .when(F.col("kind") == "error", text("$.documentId"))
        .alias("document_id"),
        F.when(F.col("kind") == "error", text("$.reason"))
        .when(F.col("kind") == K.PARSE_ERROR, K.PARSE_ERROR)
        .alias("reason"),
        F.when(F.col("kind") == "error", text("$.message")).alias("message"),
        F.when(is_document, act).alias("legal_act"),
        F.when(
            is_document,
            F.try_variant_get(record, "$.legal_act_relations", S.RELATIONS.simpleString()),
        ).alias("legal_act_relations"),
    )


def read_accumulator(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes from NDJSON files. Lines are read in splits, whatever the file size."""
    return parse_outcomes(spark.read.text(path))


def read_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw documents of one or more JSON array files: ``file, root_ok, pos, raw``.

    Large files are read in byte ranges, see :func:`read_array_files`.
    """
    return read_array_files(spark, *paths)


def read_document_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw documents of NDJSON files, in the shape of :func:`read_documents`, splittable.

    ``pos`` is where the line's split starts, since lines have no number across splits.
    """
    lines = spark.read.text(list(paths)).where(F.trim("value") != "")
    return lines.select(
        F.col("_metadata.file_name").alias("file"),
        F.lit(True).alias("root_ok"),
        F.col("_metadata.file_block_start").alias("pos"),
        F.col("value").alias("raw"),
    )


def read_run_reports(spark: SparkSession, path: str) -> DataFrame:
    """Raw run reports: ``file, raw``. Files with 'example' in the name are left out."""
    return (
        spark.read.option("pathGlobFilter", "run_report_*.json")
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw"))
        .where(~F.col("file").contains("example"))
    )


def rows_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored rows; none if nothing was written there."""
    return _read_or_empty(spark, schema, lambda: spark.read.schema(schema).parquet(path))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Finished lots of the newest start of a run: ``start, lot, attempt``, one attempt a lot.

    Of several attempts that finished a lot the one that did so first counts; of equal times the
    smaller token.
    """
    noted = rows_or_none(spark, path, S.PROGRESS)
    newest = noted.where("lot IS NULL").agg(F.max_by("start", F.struct("finishedAt", "start")).alias("start"))
    lots = noted.where("lot IS NOT NULL").join(newest, "start")
    return lots.groupBy("start", "lot").agg(F.min_by("attempt", F.struct("finishedAt", "attempt")).alias("attempt"))


def last_start(spark: SparkSession, path: str) -> str | None:
    """Token of the newest start of a run; None if it never began."""
    begun = rows_or_none(spark, path, S.PROGRESS).where("lot IS NULL")
    return begun.agg(F.max_by("start", F.struct("finishedAt", "start"))).first()[0]  # one value


def read_outcomes(spark: SparkSession, path: str, progress: DataFrame) -> DataFrame:
    """Outcomes of the finished lots; empty if there are none. ``progress`` has a row per lot."""
    done = progress.select("lot", "attempt").collect()
    if not done:
        return spark.createDataFrame([], S.OUTCOMES)
    base = path.rstrip("/")
    return spark.read.schema(S.OUTCOMES).parquet(*[f"{base}/lot={r.lot}/attempt={r.attempt}" for r in done])


def read_counts(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """``runId, entries, laws, remaining, skipped`` of a run."""
    return rows_or_none(spark, f"{path.rstrip('/')}/{run_id}", S.RUN_COUNTS)


def read_written_reports(spark: SparkSession, path: str) -> DataFrame:
    """Raw reports of runs as :func:`write_run_report` stores them: ``file, raw``, by folder name."""
    name = F.regexp_extract(F.col("_metadata.file_path"), "/(run_report_[^/]*)/[^/]*$", 1)
    return spark.read.text(f"{path.rstrip('/')}/run_report_*", wholetext=True).select(
        name.alias("file"), F.col("value").alias("raw")
    )


def _read_or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-empty lines as ``document_id``; empty if nothing was processed yet."""
    lines = _read_or_empty(
        spark, T.StructType([T.StructField("value", T.StringType())]),
        lambda: spark.read.text(path),
    )
    return lines.where(F.col("value") != "").select(F.col("value").alias("document_id")).distinct()


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """All committed checkpoints: ``lastRun, runId, committedAt``."""
    return _read_or_empty(
        spark, S.CHECKPOINT, lambda: spark.read.schema(S.CHECKPOINT).json(path)
    )


def checkpoint_head(spark: SparkSession, path: str) -> DataFrame:
    """One row ``run_id, last_run``: the commit that counts, nulls without one.

    Commits are appended, never replaced, so a lost writer cannot lose the checkpoint. They are
    taken in the order of their times (of equal times by date, then by run id). A plain commit
    counts from then on. A guarded one counts only if the commit it follows is the one that counts
    at that point: of two runs that began from one checkpoint the first to commit moves it, the
    other does not, and neither does anything built on the other. The table has a row per run.
    """
    time = F.coalesce("committedAt", F.lit("0001-01-01").cast("timestamp"))
    claims = F.sort_array(F.collect_list(F.struct(time.alias("at"), "lastRun", "runId", "follows", "guarded")))
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("run_id"), none.alias("last_run"))

    def step(head: Column, claim: Column) -> Column:
        void = F.coalesce(claim["guarded"], F.lit(False)) & ~claim["follows"].eqNullSafe(head["run_id"])
        taken = F.struct(claim["runId"].alias("run_id"), claim["lastRun"].alias("last_run"))
        return F.when(void, head).otherwise(taken)

    return read_commits(spark, path).agg(F.aggregate(claims, start, step).alias("head")).select("head.*")


def stored_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """One row ``last_run``: the date of the commit that counts, null without one."""
    return checkpoint_head(spark, path).select("last_run")


def read_checkpoint(spark: SparkSession, path: str, today: str) -> DataFrame:
    """One row ``last_run``; yesterday if there is no commit or it holds no date."""
    return since_date(stored_checkpoint(spark, path), today)


def since_date(checkpoint: DataFrame, today: str) -> DataFrame:
    """``last_run`` where it holds a date, else yesterday."""
    yesterday = F.date_sub(F.lit(today).cast("date"), 1)
    return checkpoint.select(
        F.coalesce(F.col("last_run").try_cast("date"), yesterday).cast("string").alias("last_run")
    )
