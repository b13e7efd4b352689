import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.llm import mixing as M
from tests.llm.helpers import DOCS, docs


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    rest, open_sources, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        over = [s for s in open_sources if rest * weight[s] / total > 2 * sizes[s]]
        if not over:
            target |= {s: rest * weight[s] / total for s in open_sources}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        rest -= sum(2 * sizes[s] for s in over)
        open_sources -= set(over)
    return target


def corpus(spark, seed=1, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "a", "a", "b", "Ä", None, "z", "𝄞", "ﬀ", "x"])
        words = 40 if rng.random() < 0.3 else int(rng.lognormvariate(4, 1.2))
        rows.append((i, " ".join(["w"] * words), None, source, 0))
    return spark.createDataFrame(rows, DOCS)


def test_word_count(values):
    texts = [None, "", " ", "a", " a  b\t\nc ", "a b", " ", "x\x1cy z", "a\x0bb\x0cc\rd"]
    want = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert values(texts, lambda c: M.word_count(F.col(c))) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_are_met(spark, seed):
    frame = corpus(spark, seed)
    rows = M.mix_rates(frame).collect()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    want = plain_targets(sizes)
    assert len(rows) == 900
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12)
        assert r.copies in (0, 1, 2) and abs(r.copies - r.rate) < 1.000001
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], 1.5 * largest[s])
        rated = sum(r.rate * r.size for r in rows if r.source == s)
        assert rated == pytest.approx(want[s], rel=1e-5)


def test_rates_are_tilted_exponentially(spark):
    import math

    rows = [r for r in M.mix_rates(corpus(spark)).collect() if r.source == "a" and 5 < r.size < 300]
    tilts = {round(math.log(r.rate / (2 - r.rate)) / r.size, 5) for r in rows}
    assert len(tilts) == 1


def test_reruns_agree_and_salts_do_not_matter(spark):
    frame = corpus(spark)
    first = sorted(map(tuple, M.mix_rates(frame).select("doc_id", "copies").collect()))
    again = sorted(map(tuple, M.mix_rates(frame.repartition(7)).select("doc_id", "copies").collect()))
    assert first == again
    many = M.mix_rates(frame, rows_per_salt=5).groupBy("source").agg(F.sum(F.col("copies") * F.col("size"))).collect()
    assert len(many) == 8


def test_odd_rows(spark):
    frame = docs(spark, [None, "", "a b", "a b", "word " * 5000])
    frame = frame.unionByName(frame.where("doc_id = 2")).unionByName(
        frame.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long"))
    )
    assert M.mix_rates(frame).count() == 7
    mixed = M.mix(frame)
    assert mixed.columns == frame.columns
    rates = M.mix_rates(frame).agg(F.sum("copies")).first()[0]
    assert mixed.count() == rates
    assert M.mix_rates(frame.where("false")).count() == 0 and M.mix(frame.where("false")).count() == 0
    blank = M.mix_rates(docs(spark, [None, ""])).collect()
    assert [(r.target, r.size) for r in blank] == [(0.0, 0)] * 2


def test_clashing_columns(spark):
    frame = docs(spark, ["a b c"] * 9).withColumns({c: F.col("doc_id") + 7 for c in ("_row", "_id", "_copies", "_hash", "_key", "doc")})
    mixed = M.mix(frame)
    assert mixed.columns == frame.columns
    given = {tuple(r) for r in frame.collect()}
    assert all(tuple(r) in given for r in mixed.collect()) and mixed.count() > 0
