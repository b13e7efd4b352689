"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

A document fills as many whole windows as it can; what is left of it is a part shorter than a
window. In every eighth document it is cut finely, since small parts balance the others. Parts
are packed where they arise, in lots of ``lot`` documents of one task, so nothing is
shuffled: a lot is parted into windows of nearly equal sums by differencing, and the number of
windows rises as long as one of them exceeds the capacity.
"""

import heapq
import json
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CAPACITY = 1024
LOT = 320
FINE_EVERY = 8
FINE_PART = 64
END_ID = 0

LONG_RUN = 1000

# Fixed value: how a byte-level vocabulary parts a text.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TextIds:
    """Ids of texts, as little-endian bytes, by a tokenizer file.

    What the tokenizer is, and its special strings, is read from the file. A byte-level vocabulary
    whose ids rise in the order of its merges is merged by rank, which is faster. That serves texts
    without special strings or very long runs whose characters are below U+0100, where all libraries
    know the same letters, numbers and spaces. All other texts go to the tokenizer itself.
    """

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None

    def load(self) -> "TextIds":
        if self.tokenizer is None:
            self.tokenizer = Tokenizer.from_file(self.path)
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.ranked = self._by_rank() if is_byte_level(self.tokenizer) else None
        return self

    def _by_rank(self) -> tiktoken.Encoding | None:
        """The same vocabulary with ids as merge ranks; None if the ids do not rise with the merges."""
        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        number = {letter: byte for byte, letter in byte_letters().items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        single = [model["vocab"].get(c, -1) for c in number]
        ids = {t: i for t, i in model["vocab"].items() if t not in self.special}
        rising = made == sorted(set(made)) and min(single) >= 0 and max(single) < min(made, default=1 << 31)
        if not rising or model.get("ignore_merges") or len(ids) != len(made) + len(single):
            return None
        ranks = {bytes(number[c] for c in t): i for t, i in ids.items()}
        return tiktoken.Encoding("ranked", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})

    def _serves(self, text: str) -> bool:
        if self.ranked is None or any(map(text.__contains__, self.special)):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return max(map(len, text.split(" "))) < LONG_RUN and " " * LONG_RUN not in text

    def document(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._serves(text):
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()


def is_byte_level(tokenizer: Tokenizer) -> bool:
    """Whether the tokenizer parts a text by ``PARTS`` and merges bytes, and does nothing else."""
    before = json.loads(tokenizer.pre_tokenizer.__getstate__()) if tokenizer.pre_tokenizer else {}
    return (
        tokenizer.normalizer is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space")
    )


def byte_letters() -> dict[int, str]:
    """The letter by which the vocabulary writes each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    table |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)}
    return table


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, list[list[int]]]:
    """Sums and members of ``windows`` parts of nearly equal sums (multiway Karmarkar-Karp).

    Each partial partition holds a sum per window, largest first. The two with the largest
    spread are merged with opposite order until one is left.
    """
    children: list[tuple[int, int]] = []
    n = len(sizes)
    heap = []
    for i in sorted(range(n), key=lambda i: (-sizes[i], i)):
        sums, nodes = np.zeros(windows, dtype=np.int64), np.full(windows, -1, dtype=np.int64)
        sums[0], nodes[0] = sizes[i], i
        heap.append((-sizes[i] if windows > 1 else 0, i, sums, nodes))
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        if windows > 1 and (not a[1] or not b[1]):
            if not a[1]:
                a, x, b, y = b, y, a, x
            # one part goes to the smallest sum, which moves up behind all that are not smaller
            total, node = a[-1] + b[0], y[0]
            if x[-1] >= 0:
                children.append((int(x[-1]), int(node)))
                node = n + len(children) - 1
            at = windows - 1 - int(np.searchsorted(a[-2::-1], total))
            sums = np.concatenate((a[:at], (total,), a[at:-1]))
            nodes = np.concatenate((x[:at], (node,), x[at:-1]))
            heapq.heappush(heap, (int(sums[-1] - sums[0]), order, sums, nodes))
            order += 1
            continue
        sums, y = a + b[::-1], y[::-1]
        nodes = np.where(x < 0, y, x)
        both = np.flatnonzero((x >= 0) & (y >= 0))
        nodes[both] = n + len(children) + np.arange(len(both))
        children.extend(zip(x[both].tolist(), y[both].tolist(), strict=True))
        place = np.argsort(-sums, kind="stable")
        sums, nodes = sums[place], nodes[place]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), order, sums, nodes))
        order += 1
    _, _, sums, nodes = heap[0]
    members = []
    for node in nodes.tolist():
        own, open_nodes = [], [node] if node >= 0 else []
        while open_nodes:
            at = open_nodes.pop()
            if at < n:
                own.append(at)
            else:
                open_nodes.extend(children[at - n])
        members.append(sorted(own))
    return sums, members


def least_windows(sizes: list[int], capacity: int) -> int:
    return max(1, -(-sum(sizes) // capacity))


def pack_lot(sizes: list[int], capacity: int, spare: int = 0) -> list[list[int]]:
    """Windows of at most ``capacity``, by differencing with as many windows as that takes.

    The count begins ``spare`` windows above the least and rises while a window exceeds the capacity.
    """
    windows = least_windows(sizes, capacity) + spare
    while True:
        sums, members = differencing(sizes, windows)
        if sums[0] <= capacity:
            return [m for m in members if m]
        windows += max(1, int(windows * (sums[0] / capacity - 1) / 4))


FIELDS = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    lot: int = LOT,
) -> DataFrame:
    """Pieces of whole documents: ``id_col`` and ``FIELDS``, one row per piece.

    A document is its ids by the tokenizer, then ``END_ID``; null and empty texts are the end
    alone. ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. Repeated
    rows are packed as often as they come, null ids stay null. ``sequence_id`` is unique over
    all tasks; its offsets run from 0 without gaps. No documents: no rows.
    """
    # what is broadcast stays with a worker, and so does the loaded tokenizer
    kept = docs.sparkSession.sparkContext.broadcast(SimpleNamespace(ids=None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if kept.value.ids is None:
            kept.value.ids = TextIds(tokenizer_path).load()
        table = kept.value.ids
        base = TaskContext.get().partitionId() << 40
        emit = _Pieces(id_col, schema)
        rest: list[tuple] = []
        sequence = ends = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = table.document(text.as_py()) + END_ID.to_bytes(4, "little")
                tokens = len(ids) // 4
                whole = tokens // capacity
                for k in range(whole):
                    at = k * capacity
                    emit.add(doc_id, at, ids[4 * at : 4 * (at + capacity)], tokens, base + sequence, 0)
                    sequence += 1
                at, left = whole * capacity, tokens % capacity
                if left:
                    ends += 1
                    cuts = -(-left // FINE_PART) if ends % FINE_EVERY == 0 else 1
                    for k in range(cuts):
                        length = left // cuts + (k < left % cuts)
                        rest.append((doc_id, at, ids[4 * at : 4 * (at + length)], tokens))
                        at += length
                if ends >= lot:
                    sequence = emit.windows(rest, capacity, base, sequence)
                    rest, ends = [], 0
                if emit.bytes > 8_000_000:
                    yield emit.batch()
        if rest:
            emit.windows(rest, capacity, base, sequence)
        if emit.rows:
            yield emit.batch()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = pa.schema(
        [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
         ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, {FIELDS}")


class _Pieces:
    """Rows of pieces until they are sent on."""

    def __init__(self, id_col: str, schema: pa.Schema):
        self.id_col, self.schema, self.rows, self.bytes = id_col, schema, [], 0
        self.spare = 0

    def add(self, doc_id, start, ids, tokens, sequence, offset) -> None:
        self.rows.append((doc_id, start, len(ids) // 4, ids, tokens, sequence, offset))
        self.bytes += len(ids) + 64

    def windows(self, rest, capacity, base, sequence) -> int:
        """Pack the parts; returns the next free sequence. Lots are alike, so each begins one window
        below what the last one needed."""
        sizes = [len(r[2]) // 4 for r in rest]
        found = pack_lot(sizes, capacity, max(0, self.spare - 1))
        self.spare = len(found) - least_windows(sizes, capacity)
        for members in found:
            offset = 0
            for i in members:
                doc_id, start, ids, tokens = rest[i]
                self.add(doc_id, start, ids, tokens, base + sequence, offset)
                offset += len(ids) // 4
            sequence += 1
        return sequence

    def batch(self) -> pa.RecordBatch:
        ids, *columns = zip(*self.rows, strict=True)
        arrays = [pa.array([i.as_py() for i in ids], type=ids[0].type)]
        arrays += [pa.array(c, type=f.type) for c, f in zip(columns, self.schema, strict=True)]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(arrays, names=[self.id_col, *self.schema.names])
