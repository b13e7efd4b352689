import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmill.llm import packing as P
from tests.llm.helpers import docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TABLE = P.TextIds(PATH).load()


def plain(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t\r\x0b\x1c\x1f\x85  ab'sé1²Ⅷ_-$ß漢🙂́<|endoftext>"))))
def test_ids_are_those_of_the_tokenizer(text):
    assert np.frombuffer(TABLE.document(text), dtype="<u4").tolist() == plain(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_what_the_tokenizer_is_comes_from_its_file(name):
    path = public_tokenizers.path(name)
    table, library = P.TextIds(path).load(), Tokenizer.from_file(path)
    assert (table.ranked is not None) == P.is_byte_level(library) == (name == "byte_bpe_50k.json")
    texts = ["The Straße, don't\n stop 123!", "<|endoftext|> a <|startoftext|>b", "", None, "x" * 1500, " " * 1500, "a  b", "ABC " * 500]
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in map(table.document, texts)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_single_part_joins_like_any_other():
    rng = random.Random(8)
    for windows in (1, 2, 3, 7):
        sizes = [rng.randint(1, 50) for _ in range(30)]
        sums, members = P.differencing(sizes, windows)
        assert sorted(i for m in members for i in m) == list(range(30))
        assert [sum(sizes[i] for i in m) for m in members] == sums.tolist() == sorted(sums.tolist(), reverse=True)


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b", "a \nb", "x <|endoftext|> y", "don't we'll 's", "a b ", "\n a"])
def test_ids_with_odd_spaces(text):
    assert np.frombuffer(TABLE.document(text), dtype="<u4").tolist() == plain(text)


def test_differencing_gives_near_equal_windows():
    rng = random.Random(2)
    sizes = [rng.randint(1, 1023) for _ in range(1000)]
    sums, members = P.differencing(sizes, 500)
    assert sorted(i for m in members for i in m) == list(range(1000))
    assert [sum(sizes[i] for i in m) for m in members] == sums.tolist()
    assert sums[0] - sums[-1] < 60
    assert P.differencing([8, 7, 6, 5, 4], 2)[0].tolist() == [16, 14]


def test_windows_rise_until_all_fit():
    assert P.pack_lot([700, 700, 700], 1024) == [[0], [1], [2]] or len(P.pack_lot([700, 700, 700], 1024)) == 3
    rng = random.Random(4)
    sizes = [rng.randint(1, 1023) for _ in range(700)]
    lots = P.pack_lot(sizes, 1024)
    assert max(sum(sizes[i] for i in m) for m in lots) <= 1024
    assert len(lots) <= sum(sizes) / 1024 * 1.05 + 1


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(1)
    texts = [None, "", "a", *(" ".join(rng.choice(["alpha", "bé", "c,"]) for _ in range(rng.randint(1, 900))) for _ in range(60)),
             "word " * 5000, "x" * 3000]
    frame = docs(spark, texts)
    rows = P.pack(frame.unionByName(frame.where("doc_id = 2")), PATH, lot=16).collect()
    for i, text in enumerate(texts):
        ids = plain(text) + [0]
        own = sorted([r for r in rows if r.doc_id == i], key=lambda r: r.start)
        times = 2 if i == 2 else 1
        got = [x for r in own for x in np.frombuffer(r.ids, dtype="<u4").tolist()]
        assert got == ids * times and all(r.doc_tokens == len(ids) for r in own)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert P.pack(frame.where("false"), PATH).count() == 0


def test_query_digest(spark):
    ids = np.array([5, 70000], dtype="<u4").tobytes()
    frame = spark.createDataFrame([(bytearray(ids),)], "ids binary")
    assert frame.select(F.crc32("ids")).first()[0] == zlib.crc32(ids)
