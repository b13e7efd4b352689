"""Approximate nearest neighbours by low-dimensional stable projections and kd-trees.

Vectors are projected on a few Gaussian directions. The square of a projected distance, over that
of the true one, is chi-square distributed. A kd-tree of the projections gives neighbours in
order of projected distance; they are verified by their true distance until the test holds: a
row as near as the worst of those found would, with the chosen probability, have come by now.

Rows lie in cells of the projected space. A query first asks the cell it falls in, and then only
the cells that the test can't rule out at the distance found there.
"""

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import stored

DIRECTIONS = 8
CONFIDENCE = 0.98
LEAF = 256
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096
SAMPLE = 131_072  # rows of one dimension that the cells are cut by
MOST_CELLS = 16_384


def chi_square_quantile(share: float, degrees: int) -> float:
    """Quantile for an even number of degrees, where the distribution has a closed form."""
    if degrees % 2:
        raise ValueError("an even number of directions is needed")

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return high


class Tree:
    """A kd-tree: boxes of all nodes, the children of inner ones and the rows of leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.low, self.high, self.children, self.rows = [], [], [], []
        if len(points):
            self._grow(points, 0, len(points), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, points: np.ndarray, start: int, end: int, leaf: int) -> None:
        """Nodes by a stack; a node of equal points stays a leaf, however many they are."""
        stack = [(start, end, None, 0)]
        while stack:
            start, end, parent, side = stack.pop()
            own = points[self.order[start:end]]
            low, high = own.min(axis=0), own.max(axis=0)
            node = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.children.append([-1, -1])
            self.rows.append((start, end))
            if parent is not None:
                self.children[parent][side] = node
            axis = int(np.argmax(high - low))
            if end - start <= leaf or high[axis] == low[axis]:
                continue
            middle = (end - start) // 2
            place = np.argpartition(own[:, axis], middle)
            self.order[start:end] = self.order[start:end][place]
            stack.append((start, start + middle, node, 0))
            stack.append((start + middle, end, node, 1))

    def search(self, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, projected: np.ndarray,
               own_id: int, k: int, limit: float, worst: float = math.inf) -> list[tuple[float, int]]:
        """The ``k`` nearest rows found, as (distance, id), of rows that lie in the tree's order.

        ``limit`` is the chi-square quantile, ``worst`` a distance beyond which rows don't matter.
        """
        if not len(ids):
            return []
        gap = np.maximum(self.low - projected, 0) + np.maximum(projected - self.high, 0)
        bound = (gap * gap).sum(axis=1).tolist()
        heap, best, given = [(bound[0], 0)], [], worst
        while heap:
            reached, node = heapq.heappop(heap)
            # all that is left lies at least this far away in the projection
            if reached > limit * worst * worst:
                break
            left, right = self.children[node]
            if left >= 0:
                heapq.heappush(heap, (bound[left], left))
                heapq.heappush(heap, (bound[right], right))
                continue
            rows = slice(*self.rows[node])
            difference = vectors[rows] - query
            distance = np.sqrt((difference * difference).sum(axis=1))
            near = np.flatnonzero((distance <= worst) & (ids[rows] != own_id))
            if len(near):
                if len(near) > 4 * k:  # the others can't be among the k nearest
                    near = near[distance[near] <= np.partition(distance[near], k - 1)[k - 1]]
                found = zip(distance[near].tolist(), ids[rows][near].tolist(), strict=True)
                best = heapq.nsmallest(k, [*best, *found])
                worst = best[-1][0] if len(best) == k else given
        return best


class Cells:
    """Cells of the projected space: leaves of median cuts through a sample. Every point lies in one."""

    def __init__(self, sample: np.ndarray, most: int):
        self.axis, self.cut, self.next = [], [], []
        leaf = max(1, -(-len(sample) // max(1, most)))
        stack = [(sample, -1, 0)]
        while stack:
            own, parent, side = stack.pop()
            node = len(self.axis)
            if parent >= 0:
                self.next[parent][side] = node
            self.axis.append(-1)
            self.cut.append(0.0)
            self.next.append([node, node])
            if len(own) <= leaf:
                continue
            low, high = own.min(axis=0), own.max(axis=0)
            axis = int(np.argmax(high - low))
            if high[axis] == low[axis]:
                continue
            values = own[:, axis]
            cut = np.partition(values, len(own) // 2)[len(own) // 2]
            if cut == low[axis]:
                cut = values[values > cut].min()
            self.axis[node], self.cut[node] = axis, cut
            stack += [(own[values < cut], node, 0), (own[values >= cut], node, 1)]
        self.axis, self.cut, self.next = np.array(self.axis), np.array(self.cut), np.array(self.next)

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while True:
            inner = np.flatnonzero(self.axis[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            node[inner] = self.next[at, (points[inner, self.axis[at]] >= self.cut[at]).astype(int)]


def _plane(dim: int, directions: int) -> np.ndarray:
    return np.random.default_rng(2024).standard_normal((dim, directions))


def _by_dimension(batch: pa.RecordBatch, dims: str, vectors: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimension, places in the batch and vectors as a matrix, for every dimension."""
    found = batch.column(dims).to_numpy(zero_copy_only=False)
    for dim in np.unique(found).tolist():
        places = np.flatnonzero(found == dim)
        flat = batch.column(vectors).take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
        yield dim, places, flat.reshape(-1, dim).astype(np.float64)


def _sound(vector):
    """No null or non-finite component, and one that is not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    directions: int = DIRECTIONS, confidence: float = CONFIDENCE,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, by Euclidean distance.

    The projected space is cut into cells of about ``block_rows`` rows, by at most about ``sample`` rows of
    a dimension and into at most ``MOST_CELLS``; every row lies in a cell. Rows of a cell that is
    larger are dealt to blocks by a hash of their id. A query asks all blocks of its own cell, and
    then those of the other cells whose box lies within its chi-square radius. A task builds the tree of
    one block and asks it about ``query_rows`` queries at most; a block is copied only for more. The
    nearest over all blocks remain. Distances are exact, ties go to the smaller id. A query's own
    id is never its neighbour.

    Null vectors, zero vectors, those with null or non-finite components, and rows without an id
    take no part. Of rows that share an id the one with the smallest vector counts. Vectors are
    compared with those of as many components. No rows or no queries: no result.
    """
    limit = chi_square_quantile(confidence, directions)
    cast = F.col(vector_col).cast("array<double>")

    def clean(df: DataFrame, name: str) -> DataFrame:
        sound = df.where(F.col(id_col).isNotNull() & _sound(F.col(vector_col))).select(
            F.col(id_col).cast("long").alias("id"), cast.alias("vector"), F.size(vector_col).alias("dim")
        )
        return stored(sound.groupBy("dim", "id").agg(F.min("vector").alias("vector")), name)

    rows, queries = clean(rows, "nearest_rows"), clean(queries, "nearest_queries")
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, vectors in _by_dimension(batch, "dim", "vector"):
                points = vectors @ _plane(dim, directions)
                listed = pa.ListArray.from_arrays(np.arange(0, points.size + 1, directions, dtype=np.int32), points.ravel())
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(own)), listed], names=["id", "point"])

    cells: dict[int, Cells] = {}
    for dim, n in rows.groupBy("dim").count().collect():
        drawn = np.zeros((0, directions))
        if n > block_rows:
            share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30))
            table = rows.where((F.col("dim") == dim) & share).mapInArrow(project, "id long, point array<double>").toArrow()
            if table.num_rows:
                drawn = np.array(table.sort_by("id")["point"].to_pylist())
        cells[dim] = Cells(drawn, min(MOST_CELLS, -(-n // block_rows)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, points = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, directions))
            for dim, own, vectors in _by_dimension(batch, "dim", "vector"):
                points[own] = vectors @ _plane(dim, directions)
                at[own] = cells[dim].of(points[own]) if dim in cells else 0
            listed = pa.ListArray.from_arrays(np.arange(0, points.size + 1, directions, dtype=np.int32), points.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), listed], names=["dim", "id", "vector", "cell", "point"])

    kind = "dim int, id long, vector array<double>"
    placed = rows.mapInArrow(place, f"{kind}, cell long, point array<double>")
    edges = [f(F.col("point")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(directions)]
    # a row for each cell, of which there is a fixed number at most
    boxes = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), *edges).orderBy("dim", "cell").collect()
    boxed = {}
    for dim in {b.dim for b in boxes}:
        own = [b for b in boxes if b.dim == dim]
        sides = np.array([list(b)[3:] for b in own])
        blocks = [-(-b.n // block_rows) for b in own]
        boxed[dim] = np.array([b.cell for b in own]), np.array(blocks), sides[:, :directions], sides[:, directions:]

    def sends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the block numbers they ask: without a distance those of their own cell, else of the others reached."""
        for batch in batches:
            reach = batch.column("worst").to_pylist()
            for dim, own, vectors in _by_dimension(batch, "dim", "vector"):
                if dim not in boxed:
                    continue
                numbers, blocks, low, high = boxed[dim]
                points = vectors @ _plane(dim, directions)
                homes = cells[dim].of(points)
                for i, at, point, home in zip(range(len(own)), own.tolist(), points, homes, strict=True):
                    if reach[at] is None:
                        hit = numbers == home
                    else:
                        gap = np.maximum(low - point, 0) + np.maximum(point - high, 0)
                        hit = ((gap * gap).sum(axis=1) <= limit * reach[at] * reach[at]) & (numbers != home)
                    asked = [(c, b) for c, n in zip(numbers[hit].tolist(), blocks[hit].tolist(), strict=True) for b in range(n)]
                    for start in range(0, len(asked), 1024):
                        part = asked[start : start + 1024]
                        one = batch.slice(at, 1).take(pa.array(np.zeros(len(part), np.int64)))
                        yield pa.RecordBatch.from_arrays(
                            [*one.columns, pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.int64())],
                            names=["dim", "id", "vector", "worst", "cell", "block"],
                        )

    def block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.ones(batch.num_rows, np.int64)
            for dim in boxed:
                of_cell = dict(zip(boxed[dim][0].tolist(), boxed[dim][1].tolist(), strict=True))
                own = np.flatnonzero(batch.column("dim").to_numpy() == dim)
                counts[own] = [of_cell[c] for c in batch.column("cell").take(pa.array(own)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts)], names=["dim", "id", "vector", "cell", "n"])

    held = placed.select("dim", "id", "vector", "cell").mapInArrow(block_counts, f"{kind}, cell long, n long")
    held = held.select("dim", "id", "vector", "cell", F.pmod(F.xxhash64("id"), "n").alias("block"))
    where = ["dim", "cell", "block"]

    def search(group: pa.Table) -> pa.Table:
        asks, dim = group["asks"].to_numpy(), group["dim"][0].as_py()
        vectors = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        ids, worst = group["id"].to_numpy(), group["worst"].to_numpy()
        order = np.flatnonzero(~asks)
        order = order[np.argsort(ids[order])]
        own_ids, own = ids[order], vectors[order]
        plane = _plane(dim, directions)
        tree = Tree(own @ plane)
        own_ids, own = own_ids[tree.order], own[tree.order]
        query = vectors[asks]
        out = [
            (dim, q, i, d)
            for q, v, p, w in zip(ids[asks].tolist(), query, query @ plane, worst[asks].tolist(), strict=True)
            for d, i in tree.search(own, own_ids, v, p, q, k, limit, math.inf if w is None or math.isnan(w) else w)
        ]
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["dim", "query_id", "vec_id", "score"])

    def ask(asking: DataFrame, name: str) -> DataFrame:
        asked = stored(asking.mapInArrow(sends, f"{kind}, worst double, cell long, block long"), f"{name}_asked")
        parts = stored(
            asked.groupBy(where).agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("parts")), f"{name}_parts"
        )
        copies = held.join(parts, where).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        one = asked.join(parts, where).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
        columns = ["dim", "cell", "block", "part", "id", "vector"]
        both = copies.select(*columns, F.lit(None).cast("double").alias("worst"), F.lit(False).alias("asks")).unionByName(
            one.select(*columns, "worst", F.lit(True).alias("asks"))
        )
        found = both.groupBy("dim", "cell", "block", "part").applyInArrow(search, "dim int, query_id long, vec_id long, score double")
        return stored(found, f"{name}_found")

    order = Window.partitionBy("dim", "query_id").orderBy("score", "vec_id")
    first = ask(queries.withColumn("worst", F.lit(None).cast("double")), "nearest_home")
    reached = (
        first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
        .select("dim", F.col("query_id").alias("id"), F.col("score").alias("worst"))
    )
    # fewer than k in its own cell: a query asks everywhere
    others = queries.join(reached, ["dim", "id"], "left").fillna(float("inf"), ["worst"])
    found = first.unionByName(ask(others.select("dim", "id", "vector", "worst"), "nearest_others"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
