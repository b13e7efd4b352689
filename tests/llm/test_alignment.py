"""Alignment against plain versions: set intersection of ends, and all pairs of overlapping ranges."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexmill.llm import alignment as A
from tests.llm.helpers import docs

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PAIR = A.Pair(A_PATH, B_PATH)
TOKENIZER = Tokenizer.from_file(A_PATH)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def plain(text):
    """Ids and ends of both tokenizers over the whole text, or None."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = TOKENIZER.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    a_bytes, b_bytes = [PAIR.a_bytes[i] for i in a], [PAIR.b_bytes[i] for i in b]
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return None
    ends = lambda parts: [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
    return a, ends(a_bytes), b, ends(b_bytes)


def plain_rows(texts):
    linked, rows = Counter(), []
    for text in texts:
        found = plain(text)
        if found is None:
            rows.append(None)
            continue
        a, a_ends, b, b_ends = found
        common = sorted(set(a_ends) & set(b_ends))
        groups, low = [], 0
        for end in common:
            mine = [[str(t) for t, e in zip(x, ends, strict=True) if low < e <= end] for x, ends in ((a, a_ends), (b, b_ends))]
            groups.append("|".join(map(",".join, mine)))
            low = end
        spans = lambda ends: list(zip([0, *ends], ends, strict=False))
        links = [(x, y) for x, (s, e) in zip(a, spans(a_ends), strict=True) for y, (u, v) in zip(b, spans(b_ends), strict=True)
                 if s < v and u < e]
        linked.update(links)
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, y), n in linked.items():
        most[y] = max(n, most.get(y, 0))
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else
        (r[0], r[1], r[2], len(r[3]), sum(linked[p] == most[p[1]] for p in r[3]), sum(linked[p] for p in r[3]), r[4])
        for r in rows
    ]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 5000), max_size=300), st.sets(st.integers(1, 5000), max_size=60), st.integers(1, 9))
def test_gallop_against_sets(many, few, chunk):
    longer, shorter = (np.array(sorted(s | {6000}), dtype=np.int64) for s in (many, few))
    assert A.gallop(shorter, longer, chunk).tolist() == [sum(y < x for y in longer) for x in shorter]
    for a, b in ((shorter, longer), (longer, shorter)):
        a_common, b_common, left, right = A.align_ends(a, b)
        assert a[a_common].tolist() == b[b_common].tolist() == sorted(set(a) & set(b))
        begin = lambda e: np.r_[0, e[:-1]]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if begin(a)[i] < b[j] and begin(b)[j] < a[i]]
        assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t\r\x0b\x1c\x85 ▁  abth'sé1_-$ß漢🙂\x00</s><|endoftext|>")), max_size=25), max_size=4))
def test_segments_give_the_tokens_of_whole_texts(texts):
    table = A.Segments(PAIR)
    found = [table.document(t) for t in texts]
    table.learn()
    for text, numbers in zip(texts, found, strict=True):
        want = plain(text)
        usable = bool(numbers) and bool(table.sizes[numbers, 3].all())
        assert usable == (want is not None)
        if usable:
            assert table.sizes[numbers].sum(axis=0)[:2].tolist() == [len(want[0]), len(want[2])]


TEXTS = [
    "The unbelievable straße, naïve façade.", "the the The", None, "", " ", "a  b \n c", "▁ mark", "x\x00y 🙂🙂",
    "<s> </s> <unk> <0x41> <|endoftext|> end", "the unbelievable", "\n", " lead", "trail ", "0123456789 3.14 abcABC",
    "z" * 900, "wort " * 300, "漢字かな交じり文 and English", "the hard space",
]


@pytest.mark.parametrize("block_bytes", [1, 700, 10**7])
def test_against_plain_version(spark, block_bytes):
    frame = docs(spark, TEXTS).repartition(3)
    frame = frame.unionByName(frame.where("doc_id = 1"))
    rows = A.align(frame, A_PATH, B_PATH, block_bytes=block_bytes).collect()
    want = plain_rows([*TEXTS, TEXTS[1]])
    assert sorted(tuple(r) for r in rows) == sorted((i % len(TEXTS) if i < len(TEXTS) else 1, *w) for i, w in enumerate(want))


def test_digest_and_odd_tables(spark):
    frame = docs(spark, TEXTS[:4])
    rows = {r.doc_id: r.groups for r in A.align(frame, A_PATH, B_PATH, digest=True).collect()}
    want = plain_rows(TEXTS[:4])
    assert rows == {i: hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for i, w in enumerate(want)}
    assert A.align(frame.where("false"), A_PATH, B_PATH).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, None), (3, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_a, r.count_sum) for r in A.align(nulls, A_PATH, B_PATH).collect()) == [
        (0, 0, 0), (0, 2, 4), (3, 2, 4)]


def test_without_cuts(spark, monkeypatch):
    monkeypatch.setattr(PAIR, "cuts", False)
    table = A.Segments(PAIR)
    found = [table.document(t) for t in TEXTS]
    table.learn()
    assert [len(f) for f in found] == [int(bool(t)) for t in TEXTS]
    for text, numbers, want in zip(TEXTS, found, plain_rows(TEXTS), strict=True):
        if numbers:
            assert table.texts[numbers[0]].decode() == want[-1], text
