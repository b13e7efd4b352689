import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm import lzdedup as L
from tests.llm.helpers import docs


def plain(rows, window=13):
    """(words, kept words) per (id, text), by comparing all windows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(40)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (12, 13, 14, 40, 200)]
    texts = [None, "", "one two", " ".join(["same"] * 50), " ".join(["same"] * 30) + " end"]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))))
            if rng.random() < 0.5:
                p = rng.choice(passages).split()
                a = rng.randint(0, 5)
                parts.append("\t".join(p[a : len(p) - rng.randint(0, 5)]))
        texts.append("  \n".join(parts))
    texts += [texts[9], texts[9], texts[12] + " tail"]
    return texts


def digest(spark, frame, tmp_path, name):
    from lexmill.llm.queries import QUERIES

    path = tmp_path / name
    frame.write.parquet(str(path / "documents.parquet"))
    return QUERIES["op4_substring_dedup"](spark, str(path)).collect()


def test_query_equals_brute_force(spark, tmp_path):
    for seed in (1, 2):
        texts = corpus(seed)
        random.Random(seed).shuffle(texts)
        rows = {r.doc_id: r for r in digest(spark, docs(spark, texts).repartition(5), tmp_path, str(seed))}
        want = plain(list(enumerate(texts)))
        assert len(rows) == len(texts)
        for i, w in enumerate(want):
            assert (rows[i].n_words, rows[i].n_removed, rows[i].kept_sha256) == w


def test_repeated_and_null_ids(spark, tmp_path):
    base = " ".join(f"a{i}" for i in range(30))
    other = " ".join(f"b{i}" for i in range(20))
    rows = [(1, base), (1, other), (2, base), (2, other + " x"), (None, base), (None, None), (3, base)]
    frame = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = digest(spark, frame, tmp_path, "ids")
    want = plain(rows)
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=key) == sorted(
        ((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=key
    )


def test_factors_point_at_their_reference(spark):
    base = [f"a{i}" for i in range(60)]
    texts = [" ".join(base), "x y " + " ".join(base[10:40]) + " z", " ".join(base[:13])]
    rows = {r.doc_id: r.factors for r in L.dedup_substrings(docs(spark, texts)).collect()}
    assert [tuple(f) for f in rows[1]] == [(2, 30, 0, 10)] and [tuple(f) for f in rows[2]] == [(0, 13, 0, 0)]


def test_segments_and_parts_of_long_texts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(L, "SEGMENT", 37)
    texts = corpus(5) + [" ".join(f"v{i % 90}" for i in range(2000)), " ".join(f"v{i % 90}" for i in range(500, 900))]
    rows = {r.doc_id: r for r in digest(spark, docs(spark, texts), tmp_path, "long")}
    for i, w in enumerate(plain(list(enumerate(texts)))):
        assert (rows[i].n_words, rows[i].n_removed, rows[i].kept_sha256) == w


def test_empty_table(spark):
    assert L.dedup_substrings(docs(spark, ["a"]).where("false")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=5))
def test_every_window_has_its_anchor(texts):
    words = [[w.encode() for w in t] for t in texts]
    segments = list(L._segments(enumerate(words), 13))
    if not segments:
        return
    hasher = L.Hasher(1)
    held = L.Words(segments)
    chosen, key = L.anchors(held, hasher)
    found = {}
    for c, k in zip(chosen, key, strict=True):
        found.setdefault(int(held.doc[c]), {})[int(held.place[c])] = int(k)
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - 12):
            own = {found.get(d, {}).get(i + j) for j in range(9)} - {None}
            assert own
            seen.setdefault(tuple(w[i : i + 13]), set()).add(min(own))
    assert all(len(v) == 1 for v in seen.values())
    assert np.all(key > 0)
