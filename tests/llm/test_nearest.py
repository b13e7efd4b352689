import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import nearest as N

KIND = "vec_id long, embedding array<float>, label int"


def brute(vectors, query, k=10):
    own = vectors[query]
    found = []
    for i, v in vectors.items():
        if i != query and len(v) == len(own):
            d = np.asarray(v, np.float32).astype(float) - np.asarray(own, np.float32).astype(float)
            found.append((math.sqrt((d * d).sum()), i))
    return sorted(found)[:k]


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors.items()], KIND)


def test_recall_and_exact_scores(spark, tmp_path):
    from lexmill.llm.queries import QUERIES

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 32))
    vectors = {i: (centres[i % 10] + 0.6 * rng.normal(size=32)).astype(np.float32) for i in range(3000)}
    frame(spark, vectors).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = QUERIES["op6_nearest"](spark, str(tmp_path)).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(found) == set(range(0, 3000, 100)) and all(len(f) == 10 for f in found.values())
    hits = 0
    for q, got in found.items():
        assert got == sorted(got)
        want = brute(vectors, q)
        hits += len({i for _, i in want} & {i for _, i in got})
        for score, i in got:
            d = vectors[i].astype(float) - vectors[q].astype(float)
            assert score == pytest.approx(math.sqrt((d * d).sum()), rel=1e-14)
    assert hits >= 0.95 * 10 * len(found)


def test_blocks_and_parts_do_not_matter(spark):
    rng = np.random.default_rng(1)
    rows = frame(spark, {i: rng.normal(size=8) for i in range(600)})
    ask = rows.where("vec_id % 20 = 0")
    exact = {(r.query_id, r["rank"], r.vec_id) for r in N.nearest(rows, ask, confidence=1 - 1e-12).collect()}
    parted = N.nearest(rows, ask, confidence=1 - 1e-12, block_rows=50, query_rows=7)
    assert {(r.query_id, r["rank"], r.vec_id) for r in parted.collect()} == exact and len(exact) == 300


def test_ties_common_vectors_and_unsound_rows(spark):
    vectors = {i: [1.0, 2.0, 3.0] for i in range(0, 500)}
    vectors |= {1000: None, 1001: [0.0, 0.0, 0.0], 1002: [1.0, None, 2.0], 1003: [float("nan"), 1, 1], 1004: [float("inf"), 1, 1],
                1005: [], 1006: [1.0, 2.0], 1100: [1.0, 2.1]}
    rows = frame(spark, vectors)
    rows = rows.unionByName(rows.where("vec_id in (3, 100)")).unionByName(rows.where("vec_id = 4").withColumn("vec_id", F.lit(None).cast("long")))
    rows = rows.withColumn("rank", F.lit("x")).withColumn("id", F.lit("y"))
    got = {}
    for r in N.nearest(rows, rows.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 100, 200, 300, 400, 1100}
    assert got[0] == list(range(1, 11)) and got[100] == list(range(10)) and got[1100] == [1006]
    assert N.nearest(rows.where("false"), rows).count() == 0 and N.nearest(rows, rows.where("false")).count() == 0


def test_quantile():
    assert N.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert N.chi_square_quantile(0.5, 2) == pytest.approx(1.386, abs=1e-3)


def test_cells_hold_every_point_and_few_are_asked(spark, monkeypatch):
    rng = np.random.default_rng(9)
    sample = np.r_[rng.normal(size=(500, 4)), np.zeros((500, 4))]
    cells = N.Cells(sample, 16)
    leaves = set(np.flatnonzero(cells.axis < 0).tolist())
    placed = cells.of(rng.normal(size=(3000, 4)) * 3)
    assert set(placed.tolist()) <= leaves and 8 <= len(leaves) <= 64
    assert len(set(cells.of(np.zeros((9, 4))).tolist())) == 1 and set(N.Cells(sample[:0], 4).of(sample).tolist()) == {0}

    # clusters far apart: a query asks the blocks near it, also when the rows grow
    asked = {}
    keep = N.stored

    def noted(df, name):
        kept = keep(df, name)
        if name.endswith("_asked"):
            asked[name] = kept.count()
        return kept

    monkeypatch.setattr(N, "stored", noted)
    centres = 40 * rng.normal(size=(16, 24))
    for n in (1600, 6400):
        rows = frame(spark, {i: centres[i % 16] + rng.normal(size=24) for i in range(n)})
        found = N.nearest(rows, rows.where("vec_id % 100 = 0"), block_rows=100, sample=800)
        assert found.count() == n // 10
        assert asked["nearest_home_asked"] <= 4 * n // 100
        assert asked["nearest_others_asked"] <= 12 * n // 100


def test_rows_of_one_place_are_dealt_to_blocks(spark):
    rows = frame(spark, {i: [1.0, 2.0] if i % 3 else [float(i), 1.0] for i in range(900)})
    found = N.nearest(rows, rows.where("vec_id = 1 or vec_id = 300"), block_rows=40, query_rows=1).collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (1, 300)}
    assert got[1] == [i for i in range(2, 20) if i % 3][:10]
    vectors = {i: [1.0, 2.0] if i % 3 else [float(i), 1.0] for i in range(900)}
    assert got[300] == [i for _, i in brute(vectors, 300)]
