import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lexmill.llm import simhash as S
from tests.llm.helpers import docs


def plain_fingerprint(text):
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def signed(code):
    return code - (1 << 64) if code >> 63 else code


def random_codes(n, seed=1):
    rng = random.Random(seed)
    codes = set()
    while len(codes) < n:
        base = rng.getrandbits(64)
        codes.add(base)
        for _ in range(rng.choice([0, 0, 1, 5, 40])):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                base ^= 1 << b
            codes.add(base)
    return sorted(codes)[:n]


def components_of(spark, codes, **kw):
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    found = S.components(S.links(frame, **kw), "t").collect()
    root = {r.node: r.root for r in found}
    classes = {}
    for i, c in enumerate(codes):
        classes.setdefault(root.get(signed(c), signed(c)), []).append(i)
    out = [0] * len(codes)
    for members in classes.values():
        for m in members:
            out[m] = min(members)
    return out


def test_links_join_what_brute_force_joins(spark):
    codes = random_codes(900)
    assert components_of(spark, codes) == plain_components(codes)


def test_large_keys_are_parted_without_loss(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    codes = {base}
    while len(codes) < 400:  # all share their upper half, many share more
        code = base
        for b in rng.sample(range(32), rng.randint(0, 9)):
            code ^= 1 << b
        codes.add(code)
    codes = sorted(codes)
    assert components_of(spark, codes, max_group=50) == plain_components(codes)


def test_trie_join_on_dense_ball():
    centre = 0x0123456789AB
    ball = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(48) for b in range(a)} | {1, 14, 0x7F0})
    labels = S.trie_join(np.array(ball, dtype=np.uint64), 48, 3)
    assert labels.tolist() == plain_components(ball)


def test_fingerprints_and_groups(spark):
    rng = random.Random(5)
    vocabulary = [f"W{i}é" for i in range(300)]
    long = " ".join(rng.choice(vocabulary) for _ in range(3000))
    texts = [None, "", " \t\n", "One", "one", "one two", " x", long, long, long + " end", "ÀB c d e",
             *(" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(60))]
    found = S.near_duplicates(docs(spark, texts)).collect()
    codes = [plain_fingerprint(t) for t in texts]
    fps = {r.doc_id: r.fp for r in found}
    assert [fps[i] for i in range(len(texts))] == [signed(c) for c in codes]
    ids = {r.doc_id: r.component_id for r in found}
    assert [ids[i] for i in range(len(texts))] == plain_components(codes)


def test_one_document_of_each_group_stays(spark):
    frame = docs(spark, ["a b c d", "x y z", "a b c d", None, ""])
    frame = frame.unionByName(frame.where("doc_id = 1")).unionByName(
        frame.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long"))
    )
    kept = S.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(0, "a b c d"), (1, "x y z"), (3, None), (None, "x y z")], key=str
    )


def test_empty_table(spark):
    assert S.near_duplicates(docs(spark, ["a"]).where("false")).count() == 0


def test_clashing_columns(spark):
    frame = docs(spark, ["a b c", "a b c", "other words here"]).withColumns({c: F.col("doc_id") + 7 for c in ("_row", "_id", "_text", "doc")})
    kept = S.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, frame.where("doc_id <> 1").collect()))
