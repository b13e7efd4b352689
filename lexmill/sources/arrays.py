"""JSON array files read in byte ranges, so one large file gives many tasks.

A file is read in pieces that end at ``}``, which a scan can split anywhere. Whether a byte lies in a
string, how deep it is nested and in which element it lies depends on all bytes before it, so two
passes are made. The first notes for each range what it does to that state, for a start outside
and for one inside a string: a row per range. These rows are run through in order per file and
give each range its start state. The second pass cuts every range into elements; an element
that crosses a border comes as parts, which are put together by their number.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import run_path

END = b"}"
BLANKS = b" \t\r\n"
FAULT, ROOT = -1, -2  # in place of an element's number: something outside the array, and its opening

RANGES = "path string, start long, size long, bytes long, head binary, flips int, " + ", ".join(
    f"delta{s} long, levels{s} array<long>, commas{s} array<long>" for s in (0, 1)
)
STATES = "path string, start long, at long, inside boolean, depth long, number long, phantom long"
CLOSED = ", closed boolean"
PARTS = "path string, number long, start long, part binary, whole boolean, stray boolean"


def _pieces(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    text = spark.read.option("lineSep", END.decode()).text(list(paths))
    meta = {"path": "file_path", "start": "file_block_start", "size": "file_size"}
    return text.select(
        *[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()], F.col("value").cast("binary").alias("value")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, bytes, int]]:
    """Consecutive pieces of one range: path, start of the range, file size, bytes, row of the first."""
    path, start = batch.column("path"), batch.column("start").to_numpy()
    name = path.dictionary_encode().indices.to_numpy()
    change = np.flatnonzero((start[1:] != start[:-1]) | (name[1:] != name[:-1])) + 1
    borders = [0, *change.tolist(), len(start)]
    for low, high in zip(borders, borders[1:], strict=False):
        if high > low:
            data = END.join([v.as_py() or b"" for v in batch.column("value")[low:high]]) + END
            yield path[low].as_py(), int(start[low]), batch.column("size")[low].as_py(), data, low


class Bytes:
    """Marks of a run of bytes that ends with a brace; ``inside`` is where a string began before it."""

    def __init__(self, data: bytes):
        self.data = data
        codes = np.frombuffer(data, dtype=np.uint8)
        quote = codes == 0x22
        slash = codes == 0x5C
        if slash.any():
            place = np.arange(len(codes))
            last = np.maximum.accumulate(np.where(slash, -1, place))
            before = np.r_[0, place[:-1] - last[:-1]]
            quote &= before % 2 == 0
        self.codes, self.parity = codes, np.cumsum(quote) & 1
        self.change = np.isin(codes, (0x5B, 0x7B)).astype(np.int64) - np.isin(codes, (0x5D, 0x7D))
        self.comma = codes == 0x2C

    def outside(self, inside: bool) -> np.ndarray:
        return self.parity == int(inside)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range does to the state; ranges come one after another and in order."""

    def row(s: dict) -> pa.RecordBatch:
        columns = [[s["path"]], [s["start"]], [s["size"]], [s["bytes"]], [s["head"]], [s["flips"]]]
        for k in (0, 1):
            levels = sorted(s["commas"][k])
            columns += [[s["delta"][k]], [levels], [[s["commas"][k][x] for x in levels]]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()] + [
            pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())
        ] * 2
        names = [f.split()[0] for f in RANGES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    now = None
    for batch in batches:
        for path, start, size, data, _ in _runs(batch):
            if now is None or (now["path"], now["start"]) != (path, start):
                if now is not None:
                    yield row(now)
                now = {"path": path, "start": start, "size": size, "bytes": 0, "head": b"", "flips": 0,
                       "delta": [0, 0], "commas": [{}, {}]}
            marks = Bytes(data)
            if not now["head"]:
                now["head"] = data.lstrip(BLANKS)[:1]
            deltas = []
            for k in (0, 1):  # the range began outside, or inside a string
                outside = marks.outside(bool(k ^ now["flips"]))
                level = np.cumsum(np.where(outside, marks.change, 0)) + now["delta"][k]
                levels, numbers = np.unique(level[outside & marks.comma], return_counts=True)
                for x, n in zip(levels.tolist(), numbers.tolist(), strict=True):
                    now["commas"][k][x] = now["commas"][k].get(x, 0) + n
                deltas.append(int(level[-1]))
            now["delta"] = deltas
            now["flips"] ^= int(marks.parity[-1])
            now["bytes"] += len(data)
    if now is not None:
        yield row(now)


def _states(ranges: pa.Table) -> pa.Table:
    """Start states of the ranges of one file, in order, and whether its brackets close."""
    rows = sorted(ranges.to_pylist(), key=lambda r: r["start"])
    size, total = rows[0]["size"], sum(r["bytes"] for r in rows)
    # a file that does not end with the mark got one too many; a byte order mark of three bytes is not read
    phantom = total in (size + 1, size - 2)
    at, inside, depth, number, out = 0, False, 0, 0, []
    for r in rows:
        out.append([r["path"], r["start"], at, inside, depth, number, total if phantom else -1])
        k = int(inside)
        number += dict(zip(r[f"levels{k}"], r[f"commas{k}"], strict=True)).get(1 - depth, 0)
        depth += r[f"delta{k}"]
        inside ^= bool(r["flips"])
        at += r["bytes"]
    depth += int(phantom and not inside)
    first = next((r["head"] for r in rows if r["head"]), b"")
    closed = first == b"[" and depth == 0 and not inside
    names = [f.split()[0] for f in (STATES + CLOSED).split(", ")]
    return pa.Table.from_pylist([dict(zip(names, [*o, closed], strict=True)) for o in out])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements and parts of elements of each range, with the number of the element."""
    range_, state, carry, first = None, None, [], True
    for batch in batches:
        out: list[tuple] = []
        for path, start, _, data, low in _runs(batch):
            if range_ != (path, start):
                if range_ is not None and carry:
                    out.append((range_[0], state["number"], range_[1], b"".join(carry), False, False))
                range_, carry = (path, start), []
                state = {c: batch.column(c)[low].as_py() for c in ("at", "inside", "depth", "number", "phantom")}
                first = state["depth"] > 0
            state["at"] += len(data)
            if state["at"] == state["phantom"]:
                data = data[:-1]
            if not data:
                continue
            marks = Bytes(data)
            outside = marks.outside(state["inside"])
            change = np.where(outside, marks.change, 0)
            depth = np.cumsum(change) + state["depth"]
            opens = (change == 1) & (depth == 1)
            closes = (change == -1) & (depth == 0)
            borders = np.flatnonzero(opens | closes | (outside & marks.comma & (depth == 1)))
            blank = np.isin(marks.codes, list(BLANKS))
            stray = bool((outside & (depth <= 0) & ~closes & ~blank).any() or (closes & (marks.codes != 0x5D)).any()
                         or (opens & (marks.codes != 0x5B)).any())
            at, deep = 0, state["depth"] > 0
            for border in borders.tolist():
                if opens[border]:
                    out.append((path, ROOT, start, b"", False, True))
                    deep, at, carry, first = True, border + 1, [], False
                    continue
                if deep:
                    part = b"".join([*carry, data[at:border]])
                    out.append((path, state["number"], start, part, not first, False))
                carry, at, first = [], border + 1, False
                deep = not closes[border]
                state["number"] += int(deep)
            if deep:
                carry.append(data[at:])
            if stray:
                out.append((path, FAULT, start, b"", False, True))
            state["depth"] = int(depth[-1])
            state["inside"] ^= bool(marks.parity[-1])
        if out:
            yield _part_rows(out)
    if range_ is not None and carry:
        yield _part_rows([(range_[0], state["number"], range_[1], b"".join(carry), False, False)])


def _part_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]
    names = [f.split()[0] for f in PARTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_array_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Elements of JSON array files: ``file, root_ok, pos, raw``, in as many tasks as the files have ranges.

    ``raw`` is the element's text as it stands. A file whose root is no array, or that holds anything
    that is not JSON, has one row: ``root_ok`` false, ``pos`` and ``raw`` null; an empty array has one
    row with ``root_ok`` true. Spark's scans pass over a file without any byte. The start states have a row per range, so about one per 128 MB of
    input at Spark's default, and are the only thing that every task gets.
    """
    pieces = _pieces(spark, paths)
    name = F.element_at(F.split("path", "/"), -1)
    states_path = run_path(spark, "array_states")
    pieces.mapInArrow(_summaries, RANGES).groupBy("path").applyInArrow(_states, STATES + CLOSED).write.parquet(states_path)
    states = spark.read.schema(STATES + CLOSED).parquet(states_path)
    parts_path = run_path(spark, "array_parts")
    asked = F.broadcast(states.drop("closed").withColumnsRenamed({"path": "of_path", "start": "of_start"}))
    known = pieces.join(asked, (F.col("path") == F.col("of_path")) & (F.col("start") == F.col("of_start")))
    known.drop("of_path", "of_start").mapInArrow(_cut, PARTS).write.parquet(parts_path)
    parts = spark.read.schema(PARTS).parquet(parts_path)

    crossing = parts.where("NOT whole AND NOT stray").groupBy("path", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "part"))).alias("_parts")
    )
    joined = F.aggregate("_parts", F.lit(b""), lambda text, p: F.concat(text, p["part"]))
    texts = parts.where("whole").select("path", "number", "part").unionByName(
        crossing.select("path", "number", joined.alias("part"))
    )
    raw = F.regexp_replace(F.decode("part", "UTF-8"), r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    elements = texts.select("path", "number", raw.alias("raw"))
    judged = elements.select(
        "path", F.lit(0).alias("mark"), (F.col("raw") == "").alias("empty"), F.try_parse_json("raw").isNull().alias("broken")
    )
    marks = parts.where("stray").select(
        "path", F.col("number").cast("int").alias("mark"), F.lit(False).alias("empty"), (F.col("number") == FAULT).alias("broken")
    )
    found = judged.unionByName(marks).groupBy("path").agg(
        F.count_if(F.col("mark") == 0).alias("n"), F.count_if("broken").alias("faults"), F.count_if("empty").alias("empties"),
        F.count_if(F.col("mark") == ROOT).alias("roots"),
    )
    closed = states.groupBy("path").agg(F.bool_and("closed").alias("closed"))
    nothing = (F.col("n") == 1) & (F.col("empties") == 1) & (F.col("faults") == 1)
    files = closed.join(found, "path", "left").select(
        "path", nothing.alias("nothing"),
        F.coalesce(F.col("closed") & (F.col("roots") == 1) & ((F.col("faults") == 0) | nothing), F.lit(False)).alias("root_ok"),
    )
    # a row per file, fewer than the start states; joined by shuffle, a file's elements would be one task
    whole = elements.join(F.broadcast(files.where("root_ok AND NOT nothing").select("path")), "path")
    alone = files.where("NOT root_ok OR coalesce(nothing, true)")
    return whole.select(
        name.alias("file"), F.lit(True).alias("root_ok"), F.col("number").cast("int").alias("pos"), "raw"
    ).unionByName(
        alone.select(name.alias("file"), "root_ok", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("raw"))
    )
