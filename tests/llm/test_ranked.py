"""Ranked search against a plain version that scores every document for every item."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.llm import ranked as R
from tests.llm.helpers import docs

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in TERM.findall(text or "")]


def plain_search(items, texts, k):
    """Ranks by (item, rank): (doc, score); ``items`` and ``texts`` are lists of (id, text)."""
    bags = [(i, Counter(plain_terms(t))) for i, t in texts]
    bags = [(i, b) for i, b in bags if b]
    number, length = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for i, terms in asked.items():
        scores = []
        for d, bag in bags:
            m = 100 - 50 + (50 * bag.total() * number) // length
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in terms if t in bag
            )
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)] + ["Straße", "été", "漢字"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([3, 20, 90]))) for _ in range(300)]
    texts += [texts[7]] * 40 + [None, "", "... !", "W1, w1-W2;w3", "w0 " * 4000 + "w119"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(25)]
    items += [(25, "unknown words"), (26, None), (27, ""), (3, "w5 w6"), (28, texts[7])]
    return items, texts


@pytest.mark.parametrize("block_postings, k", [(10**6, 50), (300, 7), (2000, 1)])
def test_against_plain_version(spark, block_postings, k, monkeypatch):
    items, texts = corpus()
    monkeypatch.setattr(R, "BUNDLE_ITEMS", 10)
    frame = docs(spark, texts).withColumn("term", F.lit("x")).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"row": F.lit(1), "term": F.lit("y")})
    found = R.search(asked, frame, k, block_postings=block_postings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    want = plain_search(items, list(enumerate(texts)), k)
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_repeats_nulls_and_empty_tables(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, "a c"), (3, "z"), (4, "y y"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(None, "A"), (9, "b z")], "item_id long, text string")
    found = R.search(asked, frame, 3)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search([(None, "A"), (9, "b z")], rows, 3)
    assert R.search(asked, frame.where("false")).count() == 0
    assert R.search(asked.where("false"), frame).count() == 0
    named = spark.createDataFrame([("x", "a"), ("w", "a"), (None, "a q"), ("v", "k")], "name string, body string")
    asked = spark.createDataFrame([("q", "a")], "ask string, body string")
    got = R.search(asked, named, 5, "ask", "name", "body").orderBy("rank").collect()
    assert [(r["ask"], r["rank"], r["name"]) for r in got] == [("q", 1, "w"), ("q", 2, "x"), ("q", 3, None)]


def test_filter_holds_all_terms(spark):
    import zlib

    import xxhash

    terms = [f"t{i}" for i in range(5000)] + ["é"]
    bits = zlib.decompress(R.term_filter(spark.createDataFrame([(t,) for t in terms], "term string")))
    assert len(bits) == R.BITS // 8 and sum(b.bit_count() for b in bits) <= 5001
    for t in terms:
        place = xxhash.xxh64_intdigest(t.encode(), 42) & (R.BITS - 1)
        assert bits[place >> 3] >> (place & 7) & 1
