import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import langid as L
from tests.llm.helpers import DOCS, docs

SYLLABLES = {
    "en": "the and of ing tion ed ly er th sh".split(), "de": "der die ung keit sch ein ich tz ver ü".split(),
    "fr": "eau eux tion ment le é que oi ch ai".split(), "es": "ción mente ado los ñ que ar ez ía ll".split(),
    "xx": "qu zzo wak umb ogo".split(),
}


def text(rng, language, words):
    return " ".join("".join(rng.choices(SYLLABLES[language], k=rng.randint(1, 3))) for _ in range(words))


def corpus(spark, n=400):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        g = rng.choice(list(SYLLABLES))
        rows.append((i, text(rng, g, rng.choice([3, 10, 60, 400])), g, "s", 0))
    return spark.createDataFrame(rows, DOCS), {r[0]: r[2] for r in rows}


def test_held_out_accuracy_and_folds(spark, tmp_path):
    from lexmill.llm.queries import QUERIES

    frame, truth = corpus(spark)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op8_language_id"](spark, str(tmp_path)).collect()
    assert len(rows) == 400
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.93 * len(held) > 50


def test_predictions_do_not_see_the_label(spark):
    frame, _ = corpus(spark, 150)
    model = L.fit(frame)
    asked = docs(spark, ["ing tion ed ly the and of", "sch keit ung der die", None, "", " 12 ,.!", "zzo wak umb"])
    rows = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(asked, model).collect()}
    assert [rows[i][0] for i in range(6)] == ["en", "de", "und", "und", "und", "xx"]
    assert rows[2][1] == 0.0
    kept = L.keep_known(asked, model)
    assert kept.columns == asked.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 5]


def test_families_first(spark):
    model = L.fit(corpus(spark, 150)[0])
    assert model.families == ["germanic", "romance", "xx"]
    assert set(model.within["romance"]) == {("es", "fr")} and not model.within["xx"]


def test_sample_is_bounded(spark):
    frame, _ = corpus(spark, 200)
    assert L.fit(frame, per_language=5).languages == sorted(SYLLABLES)


def test_nothing_to_learn(spark):
    frame = docs(spark, ["a b", None]).withColumn("lang", F.lit(None).cast("string"))
    model = L.fit(frame)
    assert {r.lang_pred for r in L.predict(frame, model).collect()} == {"und"}
    assert L.predict(frame.where("false"), model).count() == 0


def test_long_texts_count_whole():
    rng = random.Random(1)
    long = text(rng, "en", 120_000)
    parts = np.frombuffer((" " + " ".join(long.lower().split()) + " ").encode(), dtype=np.uint8).astype(np.uint32)
    pair = parts[:-1] * np.uint32(0x9E3779B1) + parts[1:] * np.uint32(0x85EBCA6B)
    counts = np.bincount(pair >> np.uint32(22), minlength=1024)
    got = L.features(long)[L.BUCKETS :].astype(float) ** 2
    assert np.allclose(got / got.sum(), counts / counts.sum(), rtol=0.05, atol=1e-4)


def test_stage_rejects_languages_not_learned(spark):
    import corpus_pipeline

    words = {
        "en": "the and of in to that is was for with weather park house walking", "fr": "les eau oui des une dans pour que sur avec maison temps",
        "de": "der und ung ein sch nicht mit auf wetter haus gehen park", "es": "del los que una por con para casa tiempo nación parque",
    }
    languages = [g for g in words for _ in range(200)]
    rng = random.Random(8)
    texts = [" ".join(rng.choices(words[g].split(), k=rng.choice([3, 20, 200]))) for g in languages]
    other = ["Привет, как дела? Сегодня хорошая погода и мы идём гулять в парк. " * 9, "今日はいい天気ですね。公園に散歩に行きましょう。" * 20]
    frame = docs(spark, [*texts, "123", None, "", *other]).drop("lang")
    named = spark.createDataFrame([(i, languages[i] if i < len(texts) else None) for i in range(len(texts) + 5)], "doc_id long, lang string")
    frame = frame.join(named, "doc_id").select("doc_id", "text", "lang", *[c for c in frame.columns if c not in ("doc_id", "text")])
    kept = corpus_pipeline.keep_known_languages(spark, frame, "")
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == list(range(len(texts)))
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))  # nothing learned: all letters stay
    kept = corpus_pipeline.keep_known_languages(spark, unlabelled, "")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(len(texts)), len(texts) + 3, len(texts) + 4]


def test_least_nearness_by_length(spark):
    frame, _ = corpus(spark, 300)
    model = L.fit(frame)
    rows = frame.collect()
    near = [(len(r.text.encode()).bit_length(), model.nearness(r.text)[1]) for r in rows if model.nearness(r.text)[0] == r.lang]
    least = L.least_nearness(frame, model)
    for bits, limit in enumerate(least):
        assert limit == pytest.approx(L.MARGIN * min(n for b, n in near if b >= bits))
    assert sum(b >= len(least) - 1 for b, _ in near) >= L.LEAST_ROWS > sum(b >= len(least) for b, _ in near)
    assert L.least_nearness(frame.limit(9), model) == [] and L.least_nearness(frame.where("false"), model) == []
