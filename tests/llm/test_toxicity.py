import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lexmill.llm import toxicity as X
from tests.llm.helpers import DOCS, docs

BAD = ["grumblor", "snotvik", "dreckmul", "pfuizan"]


def corpus(spark, n=600, seed=3):
    rng = random.Random(seed)
    syllables = "the and of ing tion ed ly er th sh ou re".split()
    rows, labels, truth = [], [], {}
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.choice([10, 60, 300]))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(max(3, len(words) // 12)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        truth[i] = int(toxic)
        rows.append((i, " ".join(words), "en", "s", 0))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_held_out_accuracy(spark, tmp_path):
    from lexmill.llm.queries import QUERIES

    frame, labels, truth = corpus(spark)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = QUERIES["op3_toxicity"](spark, str(tmp_path)).collect()
    assert len(rows) == 600
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 60


def test_labels_of_the_fold_are_not_read(spark):
    frame, labels, _ = corpus(spark, 300)
    known = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    a = X.fit(frame.where(known), labels.where(known))
    turned = labels.withColumn("toxic", F.when(known, F.col("toxic")).otherwise(1 - F.col("toxic")))
    b = X.fit(frame.where(known), turned.where(known))
    assert a.buckets.tolist() == b.buckets.tolist() and np.allclose(a.weights, b.weights)


def test_risk_is_not_driven_below_zero():
    rng = np.random.default_rng(1)
    positive = np.eye(40, dtype=np.float32)  # each example has a feature of its own
    rest = (rng.random((200, 40)) < 0.02).astype(np.float32)
    w, b = X.fit_nnpu(positive, rest, 0.3)
    zp, zu = positive @ w + b, rest @ w + b
    assert np.logaddexp(0, zu).mean() - 0.3 * np.logaddexp(0, zp).mean() > -0.05


def test_odd_rows(spark):
    frame, labels, _ = corpus(spark, 200)
    model = X.fit(frame, labels)
    asked = docs(spark, [None, "", "x", "grumblor snotvik dreckmul " * 3, "the and " * 100_000])
    scores = {r.doc_id: r.score for r in X.score(asked, model).collect()}
    assert len(scores) == 5 and scores[0] == scores[1] < 0.5 < scores[3]
    assert X.score(asked.where("false"), model).count() == 0
    doubled = labels.unionByName(labels).unionByName(labels.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    assert X.fit(frame, doubled).buckets.tolist() == model.buckets.tolist()


def test_nothing_to_learn(spark):
    frame, labels, _ = corpus(spark, 50)
    for given in (labels.where("false"), labels.where("toxic = 0")):
        model = X.fit(frame, given)
        assert {round(r.score, 6) for r in X.score(frame, model).collect()} == {X.DEFAULT_PRIOR} or given.count()
    assert X.fit(frame.where("false"), labels).score("a") < 0.5
    only = X.fit(frame, labels.where("toxic = 1"))
    assert 0 <= only.score("grumblor") <= 1


def test_a_repeated_row_teaches_once(spark):
    frame, labels, _ = corpus(spark, n=300)
    first = labels.where("toxic = 1").first().doc_id
    many = frame.where(F.col("doc_id") == first).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    one, two = X.fit(frame, labels), X.fit(frame.unionByName(many), labels)
    assert one.buckets.tolist() == two.buckets.tolist()
    assert np.allclose(one.weights, two.weights)
