"""Document fingerprints by locally consistent parsing.

A text is a sequence of bytes. Deterministic coin tossing gives every symbol a label of few bits
that depends on its left neighbours only: the lowest bit in which it differs from the symbol
before it, and that bit's value, repeated until six labels are left. Where a label is a local
maximum, a phrase begins. The hashes of phrases are the symbols of the next level. So an equal
substring has the same phrases at every level, but for a few at its ends, wherever it stands.

The phrases of all levels from ``FIRST_LEVEL`` up are the features of a text. A fingerprint keeps
of each of ``BINS`` classes of features the greatest hash, in a byte; the share of equal bytes
estimates the Jaccard likeness of two feature sets.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import BATCH_BYTES, sized

BINS = 128
FIRST_LEVEL = 2
MARK = 0xFF  # never a byte of UTF-8; stands between texts
FIXED = 0x40  # the label of a mark: above all others
GROUP_BYTES = BATCH_BYTES // 2


def _toss_table() -> np.ndarray:
    """New label by (label before, label): twice the lowest differing bit, plus that bit."""
    before, label = np.divmod(np.arange(1 << 16), 256)
    lowest = np.zeros(1 << 16, dtype=np.int64)
    differ = before ^ label
    for bit in range(7, -1, -1):
        lowest[(differ >> bit & 1) == 1] = bit
    return (2 * lowest + (label >> lowest & 1)).astype(np.uint8)


def _mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


class Parser:
    """Signatures of several texts at once; tables are built once per task."""

    def __init__(self):
        self.toss = _toss_table()
        rng = np.random.default_rng(77)
        self.letters = rng.integers(1, 2**63, 256, dtype=np.uint64)
        self.base = 0x9E3779B97F4A7C15
        self.power = self.back = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", self.base), ("back", pow(self.base, -1, 2**64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _labels(self, label: np.ndarray, marks: np.ndarray, rounds: int) -> np.ndarray:
        label = label.copy()
        label[marks] = FIXED
        for _ in range(rounds):
            new = np.empty_like(label)
            new[0] = FIXED
            new[1:] = self.toss[label[:-1].astype(np.uint16) << np.uint16(8) | label[1:]]
            new[marks] = FIXED
            label = new
        return label

    def _first_labels(self, names: np.ndarray) -> np.ndarray:
        """The first toss over 64-bit names, which leaves seven bits."""
        differ = np.r_[names[:1], names[1:] ^ names[:-1]]
        lowest = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) & np.uint8(63)
        return ((lowest << np.uint8(1)) | (names >> lowest.astype(np.uint64) & np.uint64(1)).astype(np.uint8)) & np.uint8(127)

    def _phrases(self, values: np.ndarray, labels: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every phrase, and which of them are marks."""
        begins = np.zeros(len(labels), dtype=bool)
        begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
        begins[marks] = True
        begins[marks[:-1] + 1] = True
        starts = np.flatnonzero(begins)
        self._reach(len(values))
        names = _mix(np.add.reduceat(values * self.power[: len(values)], starts) * self.back[starts])
        return names, np.searchsorted(starts, marks)

    @staticmethod
    def _runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and length of every run of one symbol."""
        first = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        return first, np.diff(np.r_[first, len(symbols)])

    def levels(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per level: its number, the phrases' hashes and the texts they are of. No text is empty."""
        raw = np.frombuffer(b"\xff" + b"\xff".join(texts) + b"\xff", dtype=np.uint8)
        first, length = self._runs(raw)
        symbols = raw[first]
        marks = np.flatnonzero(symbols == MARK)
        labels = self._labels(symbols, marks, 3)
        values = self.letters[symbols] + (length - 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        level = 1
        while True:
            names, marks = self._phrases(values, labels, marks)
            names[marks] = 0
            owner = np.zeros(len(names), dtype=np.int64)
            owner[marks] = 1
            owner = np.cumsum(owner) - 1
            inside = np.ones(len(names), dtype=bool)
            inside[marks] = False
            yield level, names[inside], owner[inside]
            if len(names) == 2 * len(texts) + 1:
                return
            first, length = self._runs(names)
            is_mark = ~inside[first]
            names = names[first]
            many = length > 1
            names[many] = _mix(names[many] + length[many].astype(np.uint64))
            marks = np.flatnonzero(is_mark)
            labels = self._labels(self._first_labels(names), marks, 3)
            values, level = names, level + 1

    def signatures(self, texts: list[str]) -> np.ndarray:
        """A row of ``BINS`` bytes per text; 0: no feature in that class."""
        out = np.zeros((len(texts), BINS), dtype=np.uint8)
        raw = [t.encode("utf-8", "replace") for t in texts]
        full = np.array([i for i, t in enumerate(raw) if t], dtype=np.int64)
        if not len(full):
            return out
        flat = out.reshape(-1)
        going = np.ones(len(full), dtype=bool)  # texts that were several phrases one level below
        for level, names, owner in self.levels([raw[i] for i in full]):
            several = np.bincount(owner, minlength=len(full)) > 1
            # below the first level only a text that is one phrase already has it as a feature
            counts = going if level >= FIRST_LEVEL else going & ~several
            going = going & several
            keep = counts[owner]
            names, owner = names[keep], owner[keep]
            place = full[owner] * BINS + (names >> np.uint64(57)).astype(np.int64)
            value = (names >> np.uint64(40) & np.uint64(0xFFFF)) % np.uint64(255) + np.uint64(1)
            np.maximum.at(flat, place, value.astype(np.uint8))
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of signatures, row by row; two without features are alike."""
    either = ((a > 0) | (b > 0)).sum(axis=-1)
    same = ((a == b) & (a > 0)).sum(axis=-1)
    share = same / np.maximum(either, 1)
    chance = 1 / 255  # two different features agree in a byte
    return np.where(either == 0, 1.0, np.clip((share - chance) / (1 - chance), 0.0, 1.0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint`` (hex) per row, from whole texts.

    Equal texts have equal fingerprints. Null and empty texts have the one of no features, all
    zeros. Repeated rows come out as often as they came in. No documents: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            found = []
            for group in sized(batch.column(1).to_pylist(), lambda t: len(t or ""), GROUP_BYTES):
                found += [s.tobytes().hex() for s in parser.signatures([t or "" for t in group])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=[id_col, "fingerprint"])

    frame = docs.select(F.col(id_col), F.col(text_col))
    return frame.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fingerprint string")


def _bucket(value, bounds: list, low: int, high: int):
    """Number of bounds that are greater than the value, by a tree of comparisons."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value >= F.lit(bounds[middle]), _bucket(value, bounds, low, middle)).otherwise(
        _bucket(value, bounds, middle + 1, high)
    )


def _in_turn(docs: DataFrame, parts: int) -> DataFrame:
    """``_id, _text, _part, _ahead``: rows by descending id in ``parts`` partitions.

    The last row of a partition is marked ``_ahead``: a copy of the first row of the partition
    after it (after the last: the first), so each partition can be read on its own.
    """
    bounds = docs.approxQuantile("_id", [i / parts for i in range(1, parts)], 1 / (4 * parts))
    bounds = sorted({int(b) for b in bounds}, reverse=True)
    part = F.when(F.col("_id").isNull(), F.lit(len(bounds))).otherwise(_bucket(F.col("_id"), bounds, 0, len(bounds)))
    rows = docs.withColumn("_part", part)
    heads = rows.groupBy("_part").agg(F.max("_id").alias("_id")).orderBy("_part").collect()  # a row per partition
    if not heads:
        return rows.withColumn("_ahead", F.lit(False))
    before = {h._part: heads[i - 1]._part for i, h in enumerate(heads)}
    first = F.lit(False)
    ids = [h._id for h in heads if h._id is not None]
    if ids:
        first = first | F.col("_id").isin(ids)
    if len(ids) < len(heads):
        first = first | F.col("_id").isNull()
    copies = rows.where(first).select(
        "_id", "_text",
        F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_part")).alias("_part"),
        F.lit(True).alias("_ahead"),
    )
    both = rows.withColumn("_ahead", F.lit(False)).unionByName(copies)
    return both.repartitionById(len(bounds) + 1, F.col("_part")).sortWithinPartitions(
        "_ahead", F.col("_id").desc_nulls_last(), "_text"
    )


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its fingerprint, that of an edited text, and the likeness of both and of the next row.

    Rows have an order: descending id, then text; null ids come last, and after the last row
    comes the first. In the edited text the last third (rounded down) of the code points is
    replaced by as many first ones of the next row's text, or all it has. Columns: ``id_col,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Null texts count as empty. Repeated rows come out as often as they came in. No documents: no
    rows. The texts are shuffled once, by ranges of the id.
    """
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def groups(batches):
        """Rows in lists; each list ends with the first row of the next, which is only looked at."""
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[1])
                if row[2]:  # the copy that closes the partition
                    yield held
                    return
                if size > GROUP_BYTES and len(held) > 1:
                    yield held
                    held, size = [row], len(row[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for group in groups(batches):
            texts = [r[1] for r in group]
            edited = [
                t[: len(t) - len(t) // 3] + following[: len(t) // 3]
                for t, following in zip(texts, texts[1:], strict=False)
            ]
            own, new = parser.signatures(texts), parser.signatures(edited)
            columns = [
                pa.array([r[0] for r in group[:-1]], pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited]),
                pa.array([s.tobytes().hex() for s in own[:-1]]),
                pa.array([s.tobytes().hex() for s in new]),
                pa.array(likeness(own[:-1], new)),
                pa.array(likeness(own[:-1], own[1:])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    dealt = _in_turn(rows, parts).select("_id", "_text", "_ahead")
    return dealt.mapInArrow(
        run,
        f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
