"""Substring deduplication by relative Lempel-Ziv parsing against the whole corpus.

Every document is parsed against an index of all documents with smaller ids. The index is dealt
out in blocks by phrase hash; it holds each phrase of ``window`` words at the first document in
which it starts. A factor is a longest stretch of a document that runs along one place of one
reference; where it ends, the phrases across its boundary are looked up on their own, so no
shared phrase is missed by the choice of factors. All words inside factors are duplicates.

Not all phrases are indexed. Two equal phrases hold the same anchor, the least-hashed run of
``ANCHOR`` words in them, so a phrase whose anchor occurs in one document only is unique. A first
pass finds the anchors that several documents share; only phrases around these are looked up.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import sized, words_of

WINDOW = 13
ANCHOR = 5
SEGMENT = 200_000
ROW_BYTES = 4_000_000
BLOCKS = 64


class Hasher:
    """Rolling polynomial hashes (modulo 2**64) of byte ranges, from prefix sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.letters = rng.integers(1, 2**63, 256, dtype=np.uint64)
        self.base = int(rng.integers(2**40, 2**62)) * 8 + 3
        self.inverse = pow(self.base, -1, 2**64)
        self.power = self.back = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", self.base), ("back", self.inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefix(self, raw: np.ndarray) -> np.ndarray:
        self._reach(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(self.letters[raw] * self.power[: len(raw)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (sums[end] - sums[start]) * self.back[start]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(32))


class Words:
    """Some segments of documents as one byte array, with the places of their words.

    ``segments`` are (document number, number of its first word, words).
    """

    def __init__(self, segments: list[tuple[int, int, list[bytes]]]):
        self.raw = np.frombuffer(b" ".join(w for s in segments for w in s[2]), dtype=np.uint8)
        lengths = np.fromiter((len(w) for s in segments for w in s[2]), dtype=np.int64)
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths
        sizes = np.array([len(s[2]) for s in segments], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        self.doc = np.repeat(np.array([s[0] for s in segments], dtype=np.int32), sizes)
        self.place = np.arange(len(lengths)) - np.repeat(first - np.array([s[1] for s in segments]), sizes)
        self.last = np.repeat(first + sizes, sizes)

    def starts(self, count: int) -> np.ndarray:
        """Words at which ``count`` words of one segment start."""
        at = np.arange(len(self.doc))
        return at[at + count <= self.last]


def _segments(words_by_doc: Iterator[tuple[int, list[bytes]]], window: int):
    """Segments of at most ``SEGMENT`` words; they overlap, so every window lies in exactly one."""
    for number, words in words_by_doc:
        for at in range(0, max(len(words) - window + 1, 0), SEGMENT):
            yield number, at, words[at : at + SEGMENT + window - 1]


def _slide(values: np.ndarray, width: int, combine) -> np.ndarray:
    """``combine`` over each ``width`` neighbours, by doubling."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = combine(out[:-step], out[step:])
        done += step
    return out


def _runs(words: Words, hasher: Hasher, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``ANCHOR`` words at each word, and the least of these in each window."""
    at = np.arange(len(words.doc) - ANCHOR + 1)
    runs = hasher.ranges(hasher.prefix(words.raw), words.start[at], words.end[at + ANCHOR - 1])
    return runs, _slide(runs, window - ANCHOR + 1, np.minimum)


def anchors(words: Words, hasher: Hasher, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Words at which an anchor of some window starts, and the anchors' hashes."""
    if len(words.doc) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    reach = window - ANCHOR + 1
    runs, least = _runs(words, hasher, window)
    at = np.arange(len(runs))
    whole = at[: len(least)] + window <= words.last[: len(least)]
    # a run is an anchor if it is the least of some window that holds it; other windows count as 0
    held = np.zeros(len(least) + 2 * (reach - 1), np.uint64)
    held[reach - 1 : reach - 1 + len(least)] = np.where(whole, least, np.uint64(0))
    most = _slide(held, reach, np.maximum)
    chosen = np.flatnonzero((most == runs) & (runs > 0))
    return chosen, runs[chosen]


def _payload(blocks: int, route, key, doc, place, ids) -> list[tuple[int, bytes, bytes, bytes]]:
    """Entries by block, as ``route`` tells it: hashes, documents and places as packed numbers."""
    block = (route >> np.uint64(40)) % np.uint64(blocks)
    order = np.argsort(block, kind="stable")
    key, number, place, block = key[order], doc[order], place[order], block[order]
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
    return [
        (int(block[a]), key[a:b].tobytes(), ids[number[a:b]].tobytes(), place[a:b].astype(np.int32).tobytes())
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def _documents(batches: Iterator[pa.RecordBatch], window: int):
    """(ids, words, segments) of groups of documents with about the same number of bytes."""
    for batch in batches:
        items = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        for group in sized(items, lambda r: len(r[1] or "")):
            words = [words_of(r[1]) for r in group]
            yield group, words, list(_segments(enumerate(words), window))


def _first_of_key(key, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, then document; beginning of each entry's key, and its least document."""
    order = np.lexsort((doc, key))
    sorted_key = key[order]
    new = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return order, first, doc[order][first]


def _ends_of_key(key, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each entry's key: the least and the greatest document, and whether it is of the least.

    For a key that several documents of a part share, only entries of its least document are sent
    on; so a passage that fills a third of all rows comes to its block once a part.
    """
    order, first, least = _first_of_key(key, doc)
    turn = np.r_[True, first[1:] != first[:-1]]
    final = np.r_[np.flatnonzero(turn)[1:], len(key)] - 1
    low, high = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
    low[order] = least
    high[order] = doc[order][final][np.cumsum(turn) - 1]
    last = np.zeros(len(key), bool)
    last[order[final]] = True
    return low, high, last


BLOCK_ROWS = "block int, key binary, doc binary, place binary, done boolean"
BLOCK_NAMES = [f.split()[0] for f in BLOCK_ROWS.split(", ")]
PLACES = "_doc long, _places binary"


def _rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    for part in sized(rows, lambda r: len(r[1]) + len(r[2]) + len(r[3]) + 64, ROW_BYTES):
        columns = [pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=BLOCK_NAMES)


def _per_doc(doc: np.ndarray, entries: np.ndarray) -> list[tuple[int, bytes]]:
    """Entries of each document as one packed list."""
    order = np.argsort(doc, kind="stable")
    doc, entries = doc[order], entries[order]
    cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True]) if len(doc) else np.zeros(1, int)
    return [(int(doc[a]), entries[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _ready(blocks: int, doc: np.ndarray, entries: np.ndarray) -> list[tuple]:
    """Entries that need no look-up, as rows that only pass through a block."""
    return [(d % blocks, b"", np.int64(d).tobytes(), e, True) for d, e in _per_doc(doc, entries)]


def _places(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for part in sized(rows, lambda r: len(r[1]) + 32, ROW_BYTES):
        columns = [pa.array(c, k) for c, k in zip(zip(*part, strict=True), (pa.int64(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["_doc", "_places"])


MATCH = np.dtype([("start", "<i4"), ("key", "<u8"), ("ref_doc", "<i8"), ("ref_start", "<i4")])


def _matches(key, doc, place) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose key a smaller document holds: their documents, and the matches."""
    order, first, least = _first_of_key(key, doc)
    found = np.zeros(len(key), MATCH)
    found["start"], found["key"] = place[order], key[order]
    found["ref_doc"], found["ref_start"] = least, place[order][first]
    later = doc[order] > least
    return doc[order][later], found[later]


def factors_of(matches: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy parse: start, length, reference and its start of every factor, in words.

    ``matches`` are the places where a phrase of the reference index starts, ascending.
    """
    if not len(matches):
        return []
    start, ref, at = (matches[n].astype(np.int64) for n in ("start", "ref_doc", "ref_start"))
    cut = np.r_[True, (np.diff(start) != 1) | (np.diff(ref) != 0) | (np.diff(at) != 1)]
    first = np.flatnonzero(cut)
    last = np.r_[first[1:], len(start)] - 1
    lengths = start[last] - start[first] + window
    return list(zip(*(x.tolist() for x in (start[first], lengths, ref[first], at[first])), strict=True))


def kept_words(words: list[bytes], factors: list[tuple]) -> list[bytes]:
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, _, _ in factors:
        covered[start] += 1
        covered[start + length] -= 1
    gone = np.cumsum(covered[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, blocks: int = BLOCKS
) -> DataFrame:
    """``id_col, n_words, n_removed, factors, kept_text`` per row.

    ``factors`` are the duplicate spans: ``start, length, ref_doc, ref_start`` in words, each at
    least ``window`` long. A word goes if it lies in a window that also starts in a document with
    a smaller id, judged on the input. ``kept_text`` joins the others by one space.

    Null and empty texts have no words. Rows that share an id do not shorten one another. Rows
    without an id are kept whole and are no reference. Texts of any length are parsed whole, in
    segments. No documents: no rows.

    The index has ``blocks`` blocks, or as many as the session has shuffle partitions if these
    are more; one task holds one block.
    """
    spark = docs.sparkSession
    blocks = max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    named = rows.where(F.col("_id").isNotNull())
    anchor_hash, phrase_hash = 11, 12

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(anchor_hash)
        for group, _, segments in _documents(batches, window):
            if not segments:
                continue
            ids = np.array([r[0] for r in group], dtype=np.int64)
            words = Words(segments)
            chosen, key = anchors(words, hasher, window)
            number, place = words.doc[chosen], words.place[chosen]
            doc = ids[number]
            low, high, last = _ends_of_key(key, doc)
            shared = high > low
            out = _ready(blocks, doc[shared], place[shared].astype(np.int32))
            # of a shared key its block gets the least and the greatest document
            send = (doc == low) | last
            out += [(*r, False) for r in _payload(blocks, key[send], key[send], number[send], place[send], ids)]
            yield from _rows(out)

    def shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done, key, doc, place in _blocks(batches):
            yield from _places(done)
            if len(key):
                low, high, _ = _ends_of_key(key, doc)
                shared = high > low
                yield from _places(_per_doc(doc[shared], place[shared]))

    def send_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, router = Hasher(phrase_hash), Hasher(anchor_hash)
        for group, words_by_doc, segments in _documents(batches, window):
            if not segments:
                continue
            ids = np.array([r[0] for r in group], dtype=np.int64)
            marked = []
            for r, words in zip(group, words_by_doc, strict=True):
                near = np.zeros(len(words) + 1, dtype=np.int64)
                place = np.frombuffer(b"".join(r[2]), np.int32)
                place = place[place < len(words)]
                np.add.at(near, np.maximum(place - (window - ANCHOR), 0), 1)
                np.add.at(near, place + 1, -1)
                marked.append(np.cumsum(near[:-1]) > 0)
            words = Words(segments)
            start = words.starts(window)
            base = np.cumsum([0, *map(len, words_by_doc)])
            start = start[np.concatenate(marked)[base[words.doc[start]] + words.place[start]]]
            sums = hasher.prefix(words.raw)
            key = hasher.ranges(sums, words.start[start], words.end[start + window - 1])
            number, place = words.doc[start], words.place[start]
            doc = ids[number]
            # neighbours mostly share their anchor, so they go to one block and come back together
            route = _runs(words, router, window)[1][start]
            low, _, _ = _ends_of_key(key, doc)
            send = doc == low
            out = [(*r, False) for r in _payload(blocks, route[send], key[send], number[send], place[send], ids)]
            # the others repeat a smaller document of the same part; it is their reference
            later, found = _matches(key, doc, place)
            yield from _rows(out + _ready(blocks, later, found))

    def match_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done, key, doc, place in _blocks(batches):
            yield from _places(done)
            if len(key):
                yield from _places(_per_doc(*_matches(key, doc, place)))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(phrase_hash)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ref_doc", pa.int64()), ("ref_start", pa.int64())]))
        for batch in batches:
            for group in sized(zip(*(c.to_pylist() for c in batch.columns), strict=True), lambda r: len(r[1] or "")):
                counts, removed, spans, texts = [], [], [], []
                for _, text, places in group:
                    words = words_of(text)
                    matches = np.frombuffer(b"".join(places or ()), MATCH)
                    found = factors_of(_own(matches, words, hasher, window), window)
                    counts.append(len(words))
                    spans.append([dict(zip(("start", "length", "ref_doc", "ref_start"), f, strict=True)) for f in found])
                    kept = kept_words(words, found) if found else words
                    removed.append(len(words) - len(kept))
                    texts.append(b" ".join(kept).decode())
                columns = [pa.array([r[0] for r in group], batch.column(0).type), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                           pa.array(spans, kind), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "n_removed", "factors", "kept_text"])

    deal = lambda frame: frame.repartition(blocks, "block").sortWithinPartitions("block")
    gather = lambda frame: frame.groupBy("_doc").agg(F.collect_list("_places").alias("_places"))
    marked = deal(named.mapInArrow(send_anchors, BLOCK_ROWS)).mapInArrow(shared_anchors, PLACES)
    near = named.join(gather(marked), F.col("_id") == F.col("_doc")).select("_id", "_text", "_places")
    matched = deal(near.mapInArrow(send_phrases, BLOCK_ROWS)).mapInArrow(match_phrases, PLACES)
    parsed = named.join(gather(matched), F.col("_id") == F.col("_doc"), "left").select("_id", "_text", "_places")
    unnamed = rows.where(F.col("_id").isNull()).select("_id", "_text", F.lit(None).cast("array<binary>").alias("_places"))
    kind = docs.schema[id_col].dataType.simpleString()
    return parsed.unionByName(unnamed).mapInArrow(
        finish,
        f"`{id_col}` {kind}, n_words long, n_removed long, factors array<struct<start: long, length: long, ref_doc: long, ref_start: long>>, kept_text string",
    )


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Of one block after the other: lists that are ready, then hashes, documents and places."""

    def whole(held):
        done = [(int(np.frombuffer(r[2], np.int64)[0]), r[3]) for r in held if r[4]]
        own = [r for r in held if not r[4]]
        arrays = [
            np.concatenate([np.frombuffer(r[i], t) for r in own] or [np.zeros(0, t)])
            for i, t in ((1, np.uint64), (2, np.int64), (3, np.int32))
        ]
        return done, *arrays

    held, block = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[0] != block:
                yield whole(held)
                held = []
            block = row[0]
            held.append(row)
    if held:
        yield whole(held)


def _own(matches: np.ndarray, words: list[bytes], hasher: Hasher, window: int) -> np.ndarray:
    """Matches that are this row's, by place and phrase; each place once.

    Rows with the same id share their lists; a match counts where the phrase itself stands.
    """
    if not len(matches):
        return matches
    order = np.lexsort((matches["ref_doc"], matches["start"]))
    matches = matches[order]
    keep = (matches["start"] >= 0) & (matches["start"] + window <= len(words))
    matches = matches[keep]
    if not len(matches):
        return matches
    raw = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(lengths + 1) - 1
    start = end - lengths
    here = np.zeros(len(matches), dtype=np.uint64)
    for at in range(0, len(words), SEGMENT):
        lo, hi = np.searchsorted(matches["start"], (at, at + SEGMENT))
        if hi > lo:
            stop = min(at + SEGMENT + window, len(words))
            part = np.frombuffer(raw[start[at] : end[stop - 1]], np.uint8)
            own = matches["start"][lo:hi]
            here[lo:hi] = hasher.ranges(hasher.prefix(part), start[own] - start[at], end[own + window - 1] - start[at])
    matches = matches[here == matches["key"]]
    return matches[np.r_[True, matches["start"][1:] != matches["start"][:-1]]] if len(matches) else matches
