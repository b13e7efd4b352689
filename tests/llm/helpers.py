"""Plain versions to test against."""


def as_map(frame, *columns):
    """First column to the others."""
    return {r[0]: tuple(r[1:]) if len(columns) > 2 else r[1] for r in frame.select(*columns).collect()}


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, start=0):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(start + i, t, "en", f"s{i % 2}", len(t) if t else 0) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return frame.withColumns({c: F.lit("x") for c in ("score", "fp", "size", "key", "start", "node")})
