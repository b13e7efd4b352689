"""Alignment of two tokenizations of the same text by galloping intersection of their end lists.

Both tokenizers give a list of byte offsets at which tokens end. The shorter list drives: each
of its ends is looked for in the longer one by exponential steps and then binary search. Ends
that are in both lists cut the tokens into groups; the ranks of two neighbouring ends in the
longer list bound the tokens that overlap the token between them.

A text is cut where both tokenizers must end a token: before a single space between two other
characters. Each different segment of a task's texts is encoded and aligned once, many of
them joined to one long text; documents are then sequences of segments. If a vocabulary does
not allow these cuts, a document is one segment.

Corpus-wide counts of linked id pairs are one aggregation over blocks of documents: a block
asks once for each of its different pairs, whatever number of its documents hold it.
"""

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lexmill.llm.common import stored
from lexmill.llm.packing import byte_letters, is_byte_level

BLOCK_BYTES = 4_000_000
BULK_CHARS = 50_000
MOST_SEGMENTS = 150_000
CHUNK = 256
SPACE_MARK = "▁"


class Unsafe(Exception):
    """White space stands beside a space, so the text can't be cut there."""


def gallop(shorter: np.ndarray, longer: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """For each end of ``shorter`` the number of ends of ``longer`` below it. Both lists rise.

    A chunk of ends sets out from where the last one arrived: the window doubles until it
    reaches past the chunk, then each end is found in it by binary search.
    """
    rank = np.empty(len(shorter), dtype=np.int64)
    at = 0
    for start in range(0, len(shorter), chunk):
        part = shorter[start : start + chunk]
        step = chunk
        while at + step < len(longer) and longer[at + step - 1] < part[-1]:
            step *= 2
        rank[start : start + chunk] = at + np.searchsorted(longer[at : at + step], part)
        at = int(rank[min(start + chunk, len(shorter)) - 1])
    return rank


def align_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two rising end lists with the same last end: common ends and overlapping tokens.

    Gives the tokens of A and of B that end together, in order, and all pairs of a token of A
    and a token of B whose ranges overlap.
    """
    turned = len(b) < len(a)
    x, y = (b, a) if turned else (a, b)
    low = gallop(x, y)
    same = y[low] == x
    first = np.r_[0, (low + same)[:-1]]
    number = low - first + 1
    left = np.repeat(np.arange(len(x)), number)
    right = np.arange(len(left)) + np.repeat(first - np.r_[0, np.cumsum(number)[:-1]], number)
    common = np.flatnonzero(same), low[same]
    if turned:
        return common[1], common[0], right, left
    return common[0], common[1], left, right


class Pair:
    """The two tokenizers, as both see a text: ids, and the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        number = {letter: byte for byte, letter in byte_letters().items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(number.get(c, 0x3F) for c in token)
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(self.b.id_to_piece(i) for i in range(self.b.vocab_size()))
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        # what a token writes into the list of groups, by what follows it
        self.marks = [[b"%d%c" % (i, m) for i in range(len(t))] for t, m in
                      ((self.a_bytes, 44), (self.a_bytes, 124), (self.b_bytes, 44), (self.b_bytes, 59))]
        self.cuts = self._cuts()

    def _cuts(self) -> bool:
        """Whether a single space between two other characters begins a token for both."""
        pieces = (self.b.id_to_piece(i) for i in range(self.b.vocab_size()))
        return (
            is_byte_level(self.a)
            and all(SPACE_MARK not in p.lstrip(SPACE_MARK) and (SPACE_MARK not in p[1:] or not p.strip(SPACE_MARK)) for p in pieces)
            and self.b.normalize(" a  b ") == f"{SPACE_MARK * 2}a{SPACE_MARK * 2}b{SPACE_MARK}"
        )

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A over space and text, of B over the text; None if their bytes are not those."""
        raw = (" " + text).encode()
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text, num_threads=1)
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


class Segments(dict):
    """Numbers of segments, and what is known of each: tokens, groups, linked pairs, group text."""

    loose = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, pair: Pair):
        super().__init__()
        self.pair, self.new = pair, []
        self.sizes = np.zeros((0, 4), dtype=np.int64)  # tokens of A and B, groups, 1 if usable
        self.links, self.link_ends, self.texts = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), []

    def __missing__(self, segment: str) -> int:
        if not segment or segment[0].isspace() or segment[-1].isspace():
            raise Unsafe
        return self.number(segment)

    def number(self, segment: str) -> int:
        found = self.get(segment)
        if found is None:
            found = self[segment] = len(self)
            self.new.append(segment)
        return found

    def document(self, text: str | None) -> list[int]:
        """The segments of a text, each of which follows a space."""
        if not text:
            return []
        if not self.pair.cuts:
            return [self.number(text)]
        try:
            return list(map(self.__getitem__, text.split(" ")))
        except Unsafe:
            return list(map(self.number, self.loose.split(text)))

    def learn(self) -> None:
        """Encode and align the new segments: many joined by spaces, those with spaces at an edge alone."""
        bulk, chars, found = [], 0, []
        for segment in self.new:
            if not self.pair.cuts or segment[0].isspace() or segment[-1].isspace():
                found.append(self._aligned(bulk))
                found.append(self._aligned([segment]))
                bulk, chars = [], 0
                continue
            bulk.append(segment)
            chars += len(segment)
            if chars > BULK_CHARS:
                found.append(self._aligned(bulk))
                bulk, chars = [], 0
        found.append(self._aligned(bulk))
        self.new = []
        self.sizes = np.concatenate([self.sizes, *[f[0] for f in found]])
        self.link_ends = np.concatenate([self.link_ends, self.link_ends[-1] + np.cumsum(np.concatenate([f[1] for f in found]))])
        self.links = np.concatenate([self.links, *[f[2] for f in found]])
        for f in found:
            self.texts += f[3]

    def _aligned(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Sizes, numbers of links, links and group texts of segments that are joined to one text."""
        none = np.zeros(0, dtype=np.int64)
        if not segments:
            return np.zeros((0, 4), dtype=np.int64), none, none, []
        ids = self.pair.encode(" ".join(segments))
        if ids is None:
            if len(segments) == 1:
                return np.zeros((1, 4), dtype=np.int64), np.zeros(1, dtype=np.int64), none, [b""]
            half = len(segments) // 2
            one, two = self._aligned(segments[:half]), self._aligned(segments[half:])
            return *(np.concatenate([one[i], two[i]]) for i in range(3)), one[3] + two[3]
        a, b = ids
        a_ends, b_ends = np.cumsum(self.pair.a_size[a]), np.cumsum(self.pair.b_size[b])
        a_common, b_common, left, right = align_ends(a_ends, b_ends)
        cuts = np.cumsum([len(s.encode()) + 1 for s in segments])
        a_cut, b_cut, g_cut = (np.searchsorted(e, cuts) + 1 for e in (a_ends, b_ends, a_ends[a_common]))
        link_cut = np.searchsorted(left, a_cut)
        counts = [np.diff(c, prepend=0) for c in (a_cut, b_cut, g_cut)]
        sizes = np.stack([*counts, np.ones(len(segments), dtype=np.int64)], axis=1)
        # tokens in the order of the group text: a group's tokens of A, then its tokens of B
        a_rank, b_rank = np.arange(len(a)), np.arange(len(b))
        a_place = a_rank + np.r_[0, b_common + 1][np.searchsorted(a_common, a_rank)]
        b_place = b_rank + (a_common + 1)[np.searchsorted(b_common, b_rank)]
        a_last, b_last = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        a_last[a_common], b_last[b_common] = True, True
        marks: list[bytes] = [b""] * (len(a) + len(b))
        for place, token, last, kind in ((a_place, a, a_last, 0), (b_place, b, b_last, 2)):
            plain, ending = self.pair.marks[kind], self.pair.marks[kind + 1]
            for p, t, end in zip(place.tolist(), token.tolist(), last.tolist(), strict=True):
                marks[p] = ending[t] if end else plain[t]
        ends = (a_cut + b_cut).tolist()
        texts = [b"".join(marks[s:e])[:-1] for s, e in zip([0, *ends], ends, strict=False)]
        return sizes, np.diff(link_cut, prepend=0), a[left] << 32 | b[right], texts


def _flat(starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each range, one after another."""
    total = np.cumsum(numbers)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - np.r_[0, total[:-1]], numbers)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, number: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, number * 4, codec="zstd", asbytes=True), dtype="<i4")


def encoded_blocks(
    docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, digest: bool, block_bytes: int
) -> DataFrame:
    """A row per block of a task's documents: their figures, segments, and the block's pairs with counts.

    ``pairs`` holds ``A id * 2^32 + B id``; ``segments`` and ``seg_links`` are packed lists.
    """
    id_type = docs.schema[id_col].dataType
    counts = ", ".join(f"{c} array<long>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    schema = (
        f"block long, ids array<{id_type.simpleString()}>, {counts}, groups array<string>, doc_segments array<int>, "
        "segments binary, seg_sizes array<int>, seg_links binary, pairs array<long>, pair_counts array<long>"
    )

    def block_row(number: int, table: Segments, ids: list, found: list[list[int]]) -> list[list]:
        table.learn()
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        flat = np.fromiter((i for f in found for i in f), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(found)), sizes)
        usable = np.bincount(owner, weights=1 - table.sizes[flat, 3], minlength=len(found)) == 0
        kept = usable[owner]
        flat, owner = flat[kept], owner[kept]
        sizes = np.where(usable, sizes, 0)
        figures = [np.bincount(owner, weights=table.sizes[flat, k], minlength=len(found)).astype(np.int64) for k in range(3)]
        # tokens of a group overlap like a staircase, so links are tokens less groups
        figures.append(figures[0] + figures[1] - figures[2])
        texts = [b";".join([table.texts[i] for i in f]) if good else b"" for f, good in zip(found, usable.tolist(), strict=True)]
        if digest:
            texts = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
        else:
            texts = [t.decode() for t in texts]
        used, own, times = np.unique(flat, return_inverse=True, return_counts=True)
        number_of = table.link_ends[used + 1] - table.link_ends[used]
        links = table.links[_flat(table.link_ends[used], number_of)]
        pairs, place = np.unique(links, return_inverse=True)
        pair_counts = np.bincount(place, weights=np.repeat(times, number_of), minlength=len(pairs)).astype(np.int64)
        columns = [
            [number], [ids], *[[f] for f in figures], [texts], [sizes.astype(np.int32)], [_packed(own)],
            [number_of.astype(np.int32)], [_packed(place)], [pairs], [pair_counts],
        ]
        return columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = None, TaskContext.get().partitionId() << 33
        table, ids, found, size, kind = None, [], [], 0, None

        def flush() -> pa.RecordBatch:
            nonlocal table, number
            columns = block_row(number, table, ids, found)
            number += 1
            if len(table) > MOST_SEGMENTS:
                table = Segments(pair)
            names = [f.split()[0] for f in schema.split(", ")]
            kinds = [pa.int64(), pa.list_(kind), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()), pa.list_(pa.int32()),
                     pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if table is None:
                    pair = Pair(a_path, b_path)
                    table = Segments(pair)
                text = text.as_py()
                ids.append(key)
                found.append(table.document(text))
                size += len(text or "") + 200
                if size > block_bytes:
                    yield flush()
                    ids, found, size = [], [], 0
        if ids:
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, n, best``: links of each id pair over all blocks; best if no pair of its B id has more."""
    rows = blocks.select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p"))
    counts = rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_counts").alias("n"))
    counts = stored(counts, "alignment_counts")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b_id).join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
    digest: bool = False, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    A is a byte-level vocabulary of ``tokenizers``, which gets the text after a space; B is a
    ``sentencepiece`` model, which adds that space itself. Strings of special tokens are plain
    text. ``groups`` lists the ids of each group as ``a1,a2|b1;a3|b2,b3``; with ``digest`` it is
    the SHA-256 of that list. A text that is null or empty, or whose tokens do not spell it
    again, has zeros and an empty list, and adds nothing to the counts. A pair's count is the
    number of its links in all documents; ``n_best`` counts links whose pair has the highest
    count of all pairs with its B id, ties included, and ``count_sum`` adds up the counts. Null
    ids and repeated rows each keep their own row; no documents give no rows.
    """
    blocks = stored(encoded_blocks(docs, a_path, b_path, id_col, text_col, digest, block_bytes), "alignment_blocks")
    counts = pair_counts(blocks)
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")
    out = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        + [T.StructField("groups", T.StringType())]
    )

    def figures(block: pa.Table, answer: pa.Table) -> pa.Table:
        row = {c: block.column(c).combine_chunks() for c in block.column_names}
        many = {c: row[c].flatten() for c in ("ids", "n_a", "n_b", "n_groups", "n_links", "groups")}
        place = answer.column("place").to_numpy()
        values = np.zeros((2, len(place)), dtype=np.int64)
        values[0, place] = answer.column("best").to_numpy(zero_copy_only=False)
        values[1, place] = answer.column("n").to_numpy()
        doc_segments, seg_sizes = (row[c].flatten().to_numpy().astype(np.int64) for c in ("doc_segments", "seg_sizes"))
        links = _unpacked(row["seg_links"][0].as_py(), int(seg_sizes.sum()))
        segments = _unpacked(row["segments"][0].as_py(), int(doc_segments.sum()))
        sums = []
        for value in values:
            of_segment = _sums(value[links], seg_sizes)
            sums.append(pa.array(_sums(of_segment[segments], doc_segments)))
        columns = [many["ids"], many["n_a"], many["n_b"], many["n_groups"], many["n_links"], *sums, many["groups"]]
        return pa.table(columns, names=out.names)

    return blocks.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(figures, out)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes, in whole numbers."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]
