"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

A document of ``size`` words gets a rate between 0 and 2. Among all rates that meet the word
target of a source, those of largest (two-sided) entropy have the form
``2 / (1 + exp(-tilt * size / mean))``: the odds of a copy are tilted exponentially by the words
it brings. The tilt of a source solves a convex dual in one unknown; safeguarded Newton steps
solve all sources at once. They read a count per source and size and sum in decimals, so the
order of rows never changes a result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import stored

SHARE = 1.5
WEIGHTS = (3, 1, 2)
MOST = 2
STEPS = 60
SALTS = 32
ROWS_PER_SALT = 1_000_000
UNITS = 1_000_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    spaced = F.trim(F.translate(text, "\t\n\u000b\u000c\r", "     "))
    squeezed = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    several = F.instr(spaced, "  ") > 0
    loose = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    count = F.when(several, loose).when(F.length(spaced) > 0, squeezed + 1).otherwise(0)
    return F.coalesce(count.cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, share: float = SHARE, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` of ``source, size, n`` counts.

    Sources in code point order, null last, take the weights in turn. A source's target is its
    part of ``share`` times all words, but at most ``most`` times its own; what is over goes to
    the others by weight. Written out, a source has ``min(most * own, level * weight)`` with one
    level for all; the sources that reach their limit first have the smallest limit per weight.
    The windows here read one row per source.
    """
    sources = sizes.groupBy("source").agg(
        F.sum(F.col("size").cast("decimal(38,0)") * F.col("n")).cast("long").alias("source_size")
    )
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    ranked = sources.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn(
        "_all", F.sum("source_size").over(everything) * F.lit(share)
    )
    first = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    limit = F.col("source_size") * most
    rest = F.col("_all") - F.coalesce(F.sum(limit).over(first), F.lit(0))
    open_weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(first), F.lit(0))
    leveled = ranked.withColumn("_level", rest / open_weight)
    # the level is right at the first source that stays below its limit
    below = F.when(F.col("_level") * F.col("_w") <= limit, F.col("_level"))
    level = leveled.withColumn("_level", F.max(below).over(everything))
    target = F.least(limit.cast("double"), F.coalesce(F.col("_level") * F.col("_w"), limit.cast("double")))
    return level.select("source", "source_size", target.cast("double").alias("target"))


def _rate(tilt: Column, z: Column) -> Column:
    return F.lit(2.0) / (F.lit(1.0) + F.exp(-tilt * z))


def tilts(sizes: DataFrame, goals: DataFrame, steps: int = STEPS) -> DataFrame:
    """``goals`` with ``mean, tilt, full``; ``full``: the target is all there is, every rate is 2.

    ``low`` and ``high`` enclose the root; a Newton step that leaves them, is replaced by their
    middle. A source is done at a relative error of 1e-9.
    """
    means = sizes.where("size > 0").groupBy("source").agg(
        (F.sum(F.col("size").cast("decimal(38,0)") * F.col("n")).cast("double") / F.sum("n")).alias("mean")
    )
    full = F.col("target") >= F.col("source_size") * (MOST - 1e-12)
    state = goals.join(means, goals["source"].eqNullSafe(means["source"]), "left").select(
        goals["source"], "source_size", "target", F.coalesce("mean", F.lit(1.0)).alias("mean"),
        full.alias("full"), F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
        full.alias("done"),
    )
    counts = sizes.where("size > 0").withColumnRenamed("source", "_source")
    state = stored(state, "mix_state")
    for _ in range(steps):
        z = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt"), z)
        words = F.col("n") * F.col("size")
        exact = lambda c: F.sum((c / F.col("source_size") * UNITS * UNITS).cast("decimal(38,0)"))
        sums = (
            state.where("not done")
            .join(counts, F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("source")
            .agg(
                exact(words * rate).alias("got"),
                exact(words * rate * (1 - rate / 2) * z).alias("slope"),
            )
            .withColumnsRenamed({"source": "_source"})
        )
        scale = F.col("source_size") / F.lit(float(UNITS) * UNITS)
        gap = F.coalesce(F.col("got").cast("double"), F.lit(0.0)) * scale - F.col("target")
        slope = F.col("slope").cast("double") * scale
        low = F.when(gap < 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.least("high", "tilt")).otherwise(F.col("high"))
        moved = (
            state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumns({"_gap": gap, "_slope": slope, "_low": low, "_high": high})
            .withColumn(
                "_next", F.when(F.col("_slope") > 0, F.col("tilt") - F.col("_gap") / F.col("_slope"))
            )
            .withColumn(
                "_next",
                F.when(
                    (F.col("_next") > F.col("_low")) & (F.col("_next") < F.col("_high"))
                    & (F.abs(F.col("_next") - F.col("tilt")) < 8 + F.abs("tilt")),
                    F.col("_next"),
                ).otherwise(
                    # far from the root: double the step, then halve the bracket
                    F.when(F.col("_high") >= 1e6, F.greatest(F.lit(1.0), F.col("_low") * 2))
                    .when(F.col("_low") <= -1e6, F.least(F.lit(-1.0), F.col("_high") * 2))
                    .otherwise((F.col("_low") + F.col("_high")) / 2)
                ),
            )
        )
        met = F.col("done") | (F.abs("_gap") <= 1e-9 * F.greatest(F.col("target"), F.lit(1.0)))
        state = stored(
            moved.select(
                "source", "source_size", "target", "mean", "full",
                F.when(met, F.col("tilt")).otherwise(F.col("_next")).alias("tilt"),
                F.col("_low").alias("low"), F.col("_high").alias("high"), met.alias("done"),
            ),
            "mix_state",
        )
        if state.where("not done").isEmpty():
            break
    return state.select("source", "source_size", "target", "mean", "tilt", "full")


def mix_rates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """``id_col, source, size, source_size, target, rate, copies``, a row per document.

    Copies are whole: 0, 1 or 2. In each source documents lie in an order by size class, salt,
    size and id; the fractions of the rates are summed along it and a document gets one more
    copy where the sum passes a whole number. Neighbours have nearly the same size, so the words
    taken stay within about a document of the target. The sums run in two steps, over cells
    (size class and salt, the salts grow with the table) and inside a cell, so a source or a
    size that holds a third of all rows is never sorted by one task. All sums are of whole
    numbers: reruns agree.

    Null source: a source of its own, last. Null and wordless texts have size 0 and rate 1.
    Repeated rows count as documents. No documents: no rows.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ).withColumn("_hash", F.xxhash64("_id", "size")),
        "mix_sizes",
    )
    sizes = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix_counts")
    solved = tilts(sizes, targets(sizes)).withColumnRenamed("source", "_source")
    salts = max(SALTS, rows.count() // rows_per_salt)
    known = sizes.join(solved, F.col("source").eqNullSafe(F.col("_source")))
    rate = (
        F.when(F.col("size") == 0, 1.0)
        .when(F.col("full"), 2.0)
        .otherwise(_rate(F.col("tilt"), F.col("size") / F.col("mean")))
    )
    # millionths, so that sums are exact
    known = known.select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), "source_size", "target",
        F.least(F.greatest(F.round(rate * UNITS), F.lit(0)), F.lit(2 * UNITS)).cast("long").alias("_units"),
    )
    rated = rows.join(
        known, rows["source"].eqNullSafe(F.col("_source")) & (rows["size"] == F.col("_size"))
    ).select(
        "_id", "source", "size", "source_size", "target", "_units", "_hash",
        F.floor(F.log2(F.greatest("size", F.lit(1))) * 8).cast("int").alias("_class"),
        F.pmod("_hash", F.lit(salts)).alias("_salt"),
        F.pmod("_units", F.lit(UNITS)).alias("_part"),
    )
    cell = ["source", "_class", "_salt"]
    cells = rated.groupBy(*cell).agg(F.sum("_part").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_class", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("source").alias("_source"), F.col("_class").alias("_c"), F.col("_salt").alias("_s"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*cell).orderBy("size", "_hash", "_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = rated.withColumn("_upto", F.sum("_part").over(inside)).join(
        cells,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("_class") == F.col("_c")) & (F.col("_salt") == F.col("_s")),
    )
    start = F.col("_before") + F.lit(UNITS // 2)
    whole = lambda c: F.floor(c / UNITS)
    more = whole(start + F.col("_upto")) - whole(start + F.col("_upto") - F.col("_part"))
    return placed.select(
        F.col("_id").alias(id_col), "source", "size", "source_size", "target",
        (F.col("_units") / UNITS).alias("rate"),
        (whole(F.col("_units")) + more).cast("int").alias("copies"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents as often as the mix takes them: 0, 1 or 2 times, otherwise unchanged.

    Rows that share an id take the copies of one of them each, so a repeated row is taken as
    often as its repeats are together. Other columns may have any name.
    """
    rates = mix_rates(docs, id_col, text_col, source_col)
    copies = rates.groupBy(F.col(id_col).alias("_id")).agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")
    )
    # the given row travels as one column, so its names clash with nothing here
    keyed = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("_key"), F.xxhash64(text_col).alias("_hash")
    )
    repeats = Window.partitionBy("_key").orderBy("_hash")
    joined = keyed.join(copies, F.col("_key").eqNullSafe(F.col("_id"))).withColumn(
        "_row", F.row_number().over(repeats) - 1
    )
    own = F.floor(F.col("_copies") * (F.col("_row") + 1) / F.col("_rows")) - F.floor(
        F.col("_copies") * F.col("_row") / F.col("_rows")
    )
    return joined.select("doc", F.explode(F.array_repeat(F.lit(1), own.cast("int")))).select("doc.*")
