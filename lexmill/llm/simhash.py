"""SimHash near-duplicates: fingerprints, and a self-join of their binary tries.

Two fingerprints with at most three differing bits agree in at least one of four blocks of 16
bits. Four tries, one per block, therefore hold every link: in each, the chosen block is the
upper 16 levels and is walked without errors (Spark's shuffle does this part), and below it
node pairs are walked together. A pair of nodes carries the bits in which they differ so far
and is dropped once these exceed the budget.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import components, stored, words_of

BITS = 64
MAX_GROUP = 200_000
FRONTIER = 500_000


def fingerprint_bytes(text: str | None, shingle: int = 3) -> bytes:
    """Big-endian fingerprint of a whole text; no words: zero."""
    words = [w.lower() for w in words_of(text)]
    if not words:
        return bytes(8)
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = partial(xxhash.xxh64_digest, seed=42)
    hashes = np.frombuffer(b"".join(map(digest, shingles)), dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[start : start + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id_col, fp`` (signed long) per row; null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = b"".join(fingerprint_bytes(t.as_py(), shingle) for t in batch.column(1))
            values = np.frombuffer(digests, dtype=">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=[id_col, "fp"])

    frame = docs.select(F.col(id_col), F.col(text_col))
    return frame.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp long")


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of each pair; a label is the smallest index of its class."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            lower = labels[labels]
            if (lower == labels).all():
                break
            labels = lower


def trie_join(keys: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Class label per key; linked keys are equal above bit ``depth`` and differ in <= budget below.

    ``keys`` is sorted and without repeats. A trie node is a range of it, a node pair is two
    ranges. Pairs go down one bit a level; a pair whose members are already in one class adds
    nothing and is dropped. A wide frontier is walked in parts, so memory stays bounded.
    """
    n = len(keys)
    labels = np.arange(n)
    if n < 2:
        return labels
    near = np.arange(n - 1)
    change = keys[1:] ^ keys[:-1]
    close = ((change >> np.uint64(depth)) == 0) & (np.bitwise_count(change) <= budget)
    labels = _unite(labels, near[close], near[close] + 1)
    top = keys >> np.uint64(depth)
    low = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    high = np.r_[low[1:], n]
    many = high - low > 1
    low, high = low[many], high[many]
    stack = [(depth - 1, low, high, low, high, np.zeros(len(low), dtype=np.int8))]
    while stack:
        bit, a0, a1, b0, b1, errors = stack.pop()
        seams = np.r_[0, np.cumsum(labels[1:] != labels[:-1])]
        one_class = (
            (seams[a1 - 1] == seams[a0]) & (seams[b1 - 1] == seams[b0]) & (labels[a0] == labels[b0])
        )
        go = ~one_class
        a0, a1, b0, b1, errors = a0[go], a1[go], b0[go], b1[go], errors[go]
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            x, y = a0[single], b0[single]
            linked = np.bitwise_count(keys[x] ^ keys[y]) <= budget
            labels = _unite(labels, x[linked], y[linked])
            go = ~single
            a0, a1, b0, b1, errors = a0[go], a1[go], b0[go], b1[go], errors[go]
        if not len(a0) or bit < 0:
            continue
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            for part in (slice(half, None), slice(0, half)):
                stack.append((bit, a0[part], a1[part], b0[part], b1[part], errors[part]))
            continue
        step = np.uint64(1 << bit)
        above = ~np.uint64((1 << (bit + 1)) - 1)
        am = np.searchsorted(keys, (keys[a0] & above) | step)
        bm = np.searchsorted(keys, (keys[b0] & above) | step)
        am, bm = np.clip(am, a0, a1), np.clip(bm, b0, b1)
        same = a0 == b0
        more = errors + np.int8(1)
        new = [
            np.concatenate(parts)
            for parts in zip(
                (a0, am, b0, bm, errors), (am, a1, bm, b1, errors), (a0, am, bm, b1, more),
                (am[~same], a1[~same], b0[~same], bm[~same], more[~same]), strict=True,
            )
        ]
        a0, a1, b0, b1, errors = new
        keep = (a1 > a0) & (b1 > b0) & (errors <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        stack.append((bit - 1, a0[keep], a1[keep], b0[keep], b1[keep], errors[keep]))
    return labels


def _groups(codes: DataFrame, max_group: int) -> DataFrame:
    """``key, used, fp``: rows that may be linked share a key; ``used`` marks its equal bits.

    A key is a block and its bits. A key with more than ``max_group`` fingerprints is parted
    again by four blocks of the bits it leaves open; no link is lost, by the same argument.
    """
    blocks = F.array(
        *[
            F.lit(0xFFFF << s if s < 48 else -(1 << 48)).cast("long")
            for s in (0, 16, 32, 48)
        ]
    )
    rows = codes.select("fp", F.explode(blocks).alias("used"))
    rows = rows.withColumn("key", F.xxhash64("used", F.col("fp").bitwiseAND(F.col("used"))))
    done = None
    for _ in range(3):
        large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group)
        large = stored(large.select("key"), "simhash_large")
        if large.isEmpty():
            break
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        hot = rows.join(large, "key", "left_semi")
        parts = F.udf(_open_blocks, "array<long>")
        hot = hot.join(
            hot.select("used").distinct().withColumn("parts", parts("used")), "used"
        ).select("fp", F.explode("parts").alias("used"))
        rows = hot.withColumn("key", F.xxhash64("used", F.col("fp").bitwiseAND(F.col("used")))).distinct()
    return rows if done is None else done.unionByName(rows)


def _open_blocks(used: int) -> list[int]:
    """The used bits, together with each of four blocks of the others."""
    free = [b for b in range(BITS) if not used >> b & 1]
    cuts = [round(i * len(free) / 4) for i in range(5)]
    made = [used | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in (m & ((1 << BITS) - 1) for m in made)]


def links(codes: DataFrame, budget: int = 3, max_group: int = MAX_GROUP) -> DataFrame:
    """``a, b``: links that connect all fingerprints ``fp`` (distinct) within the budget.

    A task joins the tries of its keys and gives a tree per class in place of all its pairs:
    connectivity is whole, and a class of n fingerprints gives n - 1 rows.
    """
    if budget != 3:
        raise ValueError("four blocks serve a budget of three bits")

    def join(keys: list[np.ndarray], masks: list[np.ndarray], fps: list[np.ndarray]) -> pa.RecordBatch:
        key, mask, fp = np.concatenate(keys), np.concatenate(masks), np.concatenate(fps)
        a, b = [], []
        group = np.r_[0, np.cumsum(key[1:] != key[:-1])].astype(np.uint64)
        for used in np.unique(mask):
            own = np.flatnonzero(mask == used)
            depth, rest = _open_bits(fp[own], int(used))
            # the groups of one mask are tries below one root: their number is the upper part
            _, place = np.unique(group[own], return_inverse=True)
            code = (place.astype(np.uint64) << np.uint64(depth)) | rest
            order = np.argsort(code)
            labels = trie_join(code[order], depth, budget)
            child = np.flatnonzero(labels != np.arange(len(labels)))
            a.append(fp[own[order[child]]])
            b.append(fp[own[order[labels[child]]]])
        columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new = [new[0], new[1].view(np.uint64), new[2].view(np.uint64)]
            if not len(new[0]):
                continue
            last = int(np.searchsorted(new[0], new[0][-1]))
            if rows + last > 40_000 and last:
                yield join(*map(list, zip(*held, [c[:last] for c in new], strict=True)))
                held, rows, new = [], 0, [c[last:] for c in new]
            elif rows > 40_000 and held[-1][0][-1] != new[0][0]:
                yield join(*map(list, zip(*held, strict=True)))
                held, rows = [], 0
            held.append(new)
            rows += len(new[0])
        if rows:
            yield join(*map(list, zip(*held, strict=True)))

    groups = _groups(codes, max_group)
    dealt = groups.select("key", "used", "fp").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def _open_bits(fp: np.ndarray, used: int) -> tuple[int, np.ndarray]:
    """Number of bits that ``used`` leaves open, and these bits of each code, closed up."""
    rest, depth, bit = np.zeros(len(fp), dtype=np.uint64), 0, 0
    while bit < BITS:
        if used >> bit & 1:
            bit += 1
            continue
        end = bit
        while end < BITS and not used >> end & 1:
            end += 1
        part = (fp >> np.uint64(bit)) & np.uint64((1 << (end - bit)) - 1)
        rest |= part << np.uint64(depth)
        depth, bit = depth + end - bit, end
    return depth, rest


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_group: int = MAX_GROUP
) -> DataFrame:
    """``id_col, fp, component_id`` per row: the smallest id reachable over links, itself included.

    Null, empty and wordless texts have fingerprint 0 and are linked like any other. Repeated
    rows come out as often as they came in. Null ids stay null rows; they never become a
    component id unless a component has no other. No documents: no rows.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash_fps")
    codes = stored(fps.groupBy("fp").agg(F.min(id_col).alias("first")), "simhash_codes")
    roots = components(links(codes.select("fp"), max_group=max_group), "simhash_links")
    rooted = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(lowest, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select(id_col, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group stays, the one with the smallest id, as it is.

    Rows that share that id count as repeats and leave one row. Rows without an id stay.
    """
    return keep_first(docs, near_duplicates(docs, id_col, text_col), id_col, text_col)


def keep_first(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents that are the first of their component, a row for each such id; and rows without an id."""
    kept = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_id")).distinct()
    # the given row travels as one column, so its names clash with nothing here
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    order = Window.partitionBy("_id").orderBy("_text")
    once = keyed.join(kept, "_id", "left_semi").withColumn("_row", F.row_number().over(order)).where("_row = 1")
    return once.select("doc.*").unionByName(docs.where(F.col(id_col).isNull()))
