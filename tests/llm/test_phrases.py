import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm import phrases as P
from tests.llm.helpers import DOCS, docs

PARSER = P.Parser()


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghé", k=rng.randint(1, 9))) for _ in range(n))


def test_query_edits_and_compares(spark, tmp_path):
    from lexmill.llm.queries import QUERIES

    rng = random.Random(3)
    texts = {i * 7: words(rng, rng.choice([1, 30, 200])) for i in range(80)}
    texts |= {3: None, 10: "", 17: "ab", 24: "x" * 10_000, 31: "🙂é" * 500, 38: texts[70]}
    frame = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in texts.items()], DOCS)
    frame.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, str(tmp_path)).collect()}
    assert set(rows) == set(texts)
    order = sorted(texts, reverse=True)
    for d, following in zip(order, order[1:] + order[:1], strict=True):
        text, new = texts[d] or "", texts[following] or ""
        edited = text[: len(text) - len(text) // 3] + new[: len(text) // 3]
        r = rows[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, other = PARSER.signatures([text]), PARSER.signatures([edited]), PARSER.signatures([new])
        assert (r.fingerprint, r.edited_fingerprint) == (own.tobytes().hex(), changed.tobytes().hex())
        assert r.near_edited == P.likeness(own, changed)[0] and r.near_next == P.likeness(own, other)[0]
    assert rows[38].fingerprint == rows[70].fingerprint
    long = [r for r in rows.values() if r.n_chars > 150 and texts[r.doc_id][:2] != "xx"]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95
    assert np.mean([r.near_edited for r in long]) > 0.35


def names(text):
    found = {}
    for level, hashes, _ in PARSER.levels([text]):
        found[level] = hashes.tolist()
    return found


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=0, max_size=40), st.binary(min_size=0, max_size=40), st.integers(0, 1000))
def test_equal_substrings_share_interior_phrases(left, right, seed):
    left, right = left.replace(b"\xff", b"a"), right.replace(b"\xff", b"b")
    rng = random.Random(seed)
    middle = bytes(rng.choices(b"abcdefgh  ", k=600))
    alone, inside = names(middle), names(left + middle + right)
    for level, reach in ((1, 8), (2, 8), (3, 8)):
        own = alone[level][reach:-reach]
        joined = ",".join(map(str, inside[level]))
        assert own and ",".join(map(str, own)) in joined


def test_texts_of_a_group_do_not_touch():
    rng = random.Random(9)
    texts = [words(rng, n) for n in (1, 2, 50, 400)] + ["", "a", "aa", "\x00\x00b"]
    together = PARSER.signatures(texts)
    for t, s in zip(texts, together, strict=True):
        assert (PARSER.signatures([t])[0] == s).all()
        assert (P.likeness(s, s) == 1).all()
        assert not t or s.any()


def test_odd_rows(spark):
    frame = docs(spark, ["a b c", None, "x" * 100_000, "a b c"])
    frame = frame.unionByName(frame.where("doc_id = 0")).unionByName(
        frame.where("doc_id < 2").withColumn("doc_id", F.lit(None).cast("long"))
    )
    assert P.compare_edited(frame).count() == 7 and P.fingerprints(frame).count() == 7
    assert P.compare_edited(frame.where("false")).count() == 0
    alone = P.compare_edited(frame.where("doc_id = 2")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert P.compare_edited(frame.where("doc_id is null")).count() == 2
