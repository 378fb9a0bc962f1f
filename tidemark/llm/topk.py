"""Exact top-k inner products by KD-trees over shards.

The table is parted into cells by median splits along the widest side, taken from a
bounded sample, and each cell into shards of bounded size, so that a shard is a
small region (a cell that holds many equal vectors is several shards). A task meets
one shard with one block of queries and builds the shard's KD-tree: median splits,
tight bounding boxes. The largest inner product that a point of a box could have
bounds the box. A query visits its best boxes first, then all others that can reach
its k-th score so far.

The k-th score passes from leaf to leaf, and from shard to shard: a query first
searches its home, the cell of the best bound, and then, with the score found there,
only cells whose bound reaches it. Queries at one leaf are scored by one product.
The sample decides how much is passed over, never a result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import slices
from tidemark.workspace import new_folder

#: Vectors of a shard, queries of a block, and points of a leaf.
SHARD_ROWS, BLOCK_ROWS, LEAF = 16_384, 4_096, 256
#: Leaves that a query visits in the order of its own bounds, before the rest are swept.
NEAREST = 3
#: Vectors that the cells are cut from, and numbers in the boxes of all cells.
SAMPLE_ROWS, BOX_NUMBERS = 20_000, 1 << 22
#: Products of whole numbers up to this size are exact in double precision.
_EXACT = 1 << 20


def _median_split(points: np.ndarray) -> tuple[int, float] | None:
    """Axis and value of the split of the widest side, both parts filled; None if all are equal."""
    low, high = points.min(0), points.max(0)
    axis = int((high - low).argmax())
    if not high[axis] > low[axis]:
        return None
    values = np.sort(points[:, axis])
    value = values[(len(values) - 1) // 2]
    if value == values[-1]:  # the upper half is one value: split below it
        value = values[np.searchsorted(values, value) - 1]
    return axis, value


@dataclass
class Cells:
    """A tree of splits; a point goes right if it is above the value on the axis."""

    axis: np.ndarray
    value: np.ndarray
    right: np.ndarray
    cell: np.ndarray

    @classmethod
    def cut(cls, points: np.ndarray, cells: int) -> Cells:
        """At most about ``cells`` cells with even shares of the points."""
        depth = max(0, int(np.ceil(np.log2(max(1, cells)))))
        axis, value, right, cell = [], [], [], []
        made = 0

        def grow(some: np.ndarray, left: int) -> None:
            nonlocal made
            at = len(axis)
            for column, start in ((axis, 0), (value, 0), (right, 0), (cell, -1)):
                column.append(start)
            found = _median_split(some) if left and len(some) > 1 else None
            if found is None:
                cell[at] = made
                made += 1
                return
            axis[at], value[at] = found
            above = some[:, axis[at]] > value[at]
            grow(some[~above], left - 1)
            right[at] = len(axis)
            grow(some[above], left - 1)

        grow(points, depth)
        return cls(*(np.array(x) for x in (axis, value, right, cell)))

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        at, rows = np.zeros(len(points), np.int64), np.arange(len(points))
        while (self.cell[at] < 0).any():
            inner = self.cell[at] < 0
            above = points[rows, self.axis[at]] > self.value[at]
            at = np.where(inner, np.where(above, self.right[at], at + 1), at)
        return self.cell[at]


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with any point of each box."""
    none = queries * 0
    return np.maximum(queries, none) @ high.T + np.minimum(queries, none) @ low.T


class Tree:
    """A KD-tree over points with ids: its leaves and their boxes."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order, parts, stack = np.arange(len(points)), [], [(0, len(points))]
        while stack:
            start, end = stack.pop()
            rows = order[start:end]
            found = _median_split(points[rows]) if end - start > leaf else None
            if found is None:
                parts.append((start, end))
                continue
            above = points[rows, found[0]] > found[1]
            middle = start + int((~above).sum())
            order[start:end] = np.concatenate([rows[~above], rows[above]])
            stack += [(start, middle), (middle, end)]
        self.points, self.ids, self.parts = points[order], ids[order], parts
        self.low = np.stack([self.points[i:j].min(0) for i, j in parts])
        self.high = np.stack([self.points[i:j].max(0) for i, j in parts])

    def best(
        self, queries: np.ndarray, own: np.ndarray, k: int, least: list | None = None
    ) -> tuple[list[list[tuple[int, int]]], int]:
        """(score, id) of the k best points of each query but those with its own id, smaller ids first.

        ``least`` are scores that must be reached, or None. Also how many products were taken.
        """
        heaps: list[list[tuple]] = [[] for _ in queries]  # the first entry is the worst: (score, -id)
        floor = np.array([-np.inf if x is None else x for x in least or [None] * len(queries)], queries.dtype)
        reach = bounds(queries, self.low, self.high)
        seen, taken = np.zeros(reach.shape, bool), 0

        def meet(node: int, asked: np.ndarray) -> int:
            start, end = self.parts[node]
            seen[asked, node] = True
            scores, ids = queries[asked] @ self.points[start:end].T, self.ids[start:end].tolist()
            for row, i in zip(*(x.tolist() for x in np.nonzero(scores >= floor[asked, None]))):
                q = asked[row]
                if ids[i] != own[q]:
                    entry, heap = (scores[row, i], -ids[i]), heaps[q]
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
            for q in asked.tolist():
                if len(heaps[q]) == k and heaps[q][0][0] > floor[q]:
                    floor[q] = heaps[q][0][0]
            return len(asked) * (end - start)

        # Each query's best leaves first; then, leaf by leaf, all queries that it can still serve.
        order = np.argsort(-reach, axis=1, kind="stable")[:, :NEAREST]
        rows = np.arange(len(queries))
        for step in range(order.shape[1]):
            leaf = order[:, step]
            may = reach[rows, leaf] >= floor
            for node in np.unique(leaf[may]).tolist():
                taken += meet(node, rows[may & (leaf == node)])
        for node in np.argsort(-reach.max(0), kind="stable").tolist():
            asked = np.flatnonzero((reach[:, node] >= floor) & ~seen[:, node])
            if len(asked):
                taken += meet(node, asked)
        found = [[(int(score), -i) for score, i in sorted(heap, reverse=True)] for heap in heaps]
        return found, taken


def _matrix(rows) -> np.ndarray:
    points = np.array(list(rows), np.int64)
    if len(points) and np.abs(points).max() < _EXACT:
        return points.astype(np.float64)
    return points.astype(object)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, whole components floor(256 * x) and their number, of the rows that take part.

    Rows take no part whose id or vector is null or that hold a null or non-finite
    component. Rows that repeat an id and a vector count once.
    """
    x = F.col("v")
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    return (
        vectors.select(
            F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
        )
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
        .select("vec_id", F.transform(x, lambda c: F.floor(256 * c)).alias("v"))
        .withColumn("n", F.size("v"))
        .distinct()
    )


def _stored(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def _vectors(part: pa.RecordBatch, column: int) -> list[np.ndarray]:
    """The vectors of a list column, which may differ in length."""
    held = part.column(column)
    flat, at = held.flatten().to_numpy(zero_copy_only=False), 0
    out = []
    for n in held.value_lengths().to_pylist():
        out.append(flat[at : at + n])
        at += n
    return out


def cells_of(vectors: DataFrame, shard_rows: int) -> dict[int, Cells]:
    """The splits for vectors of each length, from a sample of at most about ``SAMPLE_ROWS``."""
    counts = {row.n: row["count"] for row in vectors.groupBy("n").count().collect()}
    spread = max(1, sum(counts.values()) // SAMPLE_ROWS)
    sample = vectors.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(spread)) == 0).select("n", "v")
    held: dict[int, list] = {n: [] for n in counts}
    for n, v in sample.toPandas().itertuples(index=False):
        held[n].append(v)
    return {
        n: Cells.cut(_matrix(held[n]), min(-(-counts[n] // shard_rows), max(1, BOX_NUMBERS // (2 * n))))
        if held[n]
        else Cells.cut(np.zeros((1, n)), 1)
        for n in counts
    }


def with_cells(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    def place(batches):
        for part in slices(batches, 4_096):
            found, lengths = np.zeros(part.num_rows, np.int64), part.column(2).to_numpy()
            rows = _vectors(part, 1)
            for n in np.unique(lengths).tolist():
                some = np.flatnonzero(lengths == n)
                found[some] = cells[n].of(np.stack([rows[i] for i in some]))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(found)], ["vec_id", "v", "n", "cell"]
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(place, f"vec_id {kind}, v array<bigint>, n int, cell bigint")


def boxes_of(placed: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length of vectors: the cells that hold any, and the low and high ends of their boxes."""

    def widen(batches):
        held: dict = {}
        for part in slices(batches, 4_096):
            rows = zip(*(part.column(i).to_pylist() for i in (1, 2)), _vectors(part, 0))
            grouped: dict = {}
            for n, cell, v in rows:
                grouped.setdefault((n, cell), []).append(v)
            for key, some in grouped.items():
                some = np.stack(some)
                low, high = held.get(key, (some[0], some[0]))
                held[key] = np.minimum(low, some.min(0)), np.maximum(high, some.max(0))
        keys, ends = list(held), list(held.values())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n for n, _ in keys], pa.int32()),
                pa.array([cell for _, cell in keys], pa.int64()),
                *(pa.array([end[side].tolist() for end in ends], pa.list_(pa.int64())) for side in (0, 1)),
            ],
            ["n", "cell", "low", "high"],
        )

    schema = "n int, cell bigint, low array<bigint>, high array<bigint>"
    parts = placed.select("v", "n", "cell").mapInArrow(widen, schema)

    def merge(rows):
        low, high = (np.array(rows.column(i).to_pylist()) for i in (2, 3))
        ends = (pa.array([x.tolist()], pa.list_(pa.int64())) for x in (low.min(0), high.max(0)))
        first = rows.slice(0, 1)
        return pa.table([first.column(0), first.column(1), *ends], ["n", "cell", "low", "high"])

    found: dict = {}
    for row in parts.groupBy("n", "cell").applyInArrow(merge, schema).collect():
        found.setdefault(row.n, []).append((row.cell, row.low, row.high))
    out = {}
    for n, rows in found.items():
        which, low, high = zip(*sorted(rows))
        ends = _matrix([*low, *high])
        out[n] = np.array(which), ends[: len(rows)], ends[len(rows) :]
    return out


def targets(queries: DataFrame, boxes: dict, home: bool) -> DataFrame:
    """Where queries go: their home cell, or the other cells whose bound reaches ``least``."""

    def aim(batches):
        for part in slices(batches, 256):
            rows, cells = [], []
            lengths, least = part.column(2).to_numpy(), part.column(3).to_pylist()
            vectors = _vectors(part, 1)
            for n in np.unique(lengths).tolist():
                if n not in boxes:
                    continue
                which, low, high = boxes[n]
                some = np.flatnonzero(lengths == n)
                wanted = _matrix([vectors[i] for i in some])
                if object in (low.dtype, wanted.dtype):
                    low, high, wanted = (x.astype(object) for x in (low, high, wanted))
                reach = bounds(wanted, low, high)
                first = reach.argmax(1)
                for i, row in enumerate(some.tolist()):
                    if home:
                        go = [first[i]]
                    else:
                        may = reach[i] >= (reach[i].min() if least[row] is None else least[row])
                        go = [c for c in np.flatnonzero(may) if c != first[i]]
                    rows += [row] * len(go)
                    cells += which[go].tolist() if len(go) else []
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(column.take(taken) for column in part.columns), pa.array(cells, pa.int64())],
                ["query_id", "q", "n", "least", "cell"],
            )

    kind = queries.schema["query_id"].dataType.simpleString()
    return queries.select("query_id", "q", "n", "least").mapInArrow(
        aim, f"query_id {kind}, q array<bigint>, n int, least bigint, cell bigint"
    )


def searched(
    placed: DataFrame,
    asked: DataFrame,
    k: int,
    shard_rows: int,
    block_rows: int,
    taken: Accumulator | None,
) -> DataFrame:
    """query_id, vec_id and score: the k best of each shard of the cells that queries go to.

    A cell's vectors are dealt to shards and its queries to blocks, both of bounded size.
    """
    keys = ["n", "cell"]
    shards = placed.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(shard_rows)).alias("shards"))
    blocks = asked.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("blocks"))
    sizes = shards.join(blocks, keys)  # a row per cell
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = placed.join(sizes, keys).select(
        "vec_id", "v", *keys,
        F.pmod(F.xxhash64("vec_id"), F.col("shards")).alias("shard"),
        numbers("blocks").alias("block"),
    )
    right = asked.join(sizes, keys).select(
        "query_id", "q", "least", *keys,
        F.pmod(F.xxhash64("query_id"), F.col("blocks")).alias("block"),
        numbers("shards").alias("shard"),
    )

    def search(points, queries):
        rows = []
        if points.num_rows and queries.num_rows:
            data, wanted = (_matrix(x.column(name).to_pylist()) for x, name in ((points, "v"), (queries, "q")))
            if object in (data.dtype, wanted.dtype):
                data, wanted = data.astype(object), wanted.astype(object)
            tree = Tree(data, points.column("vec_id").to_numpy())
            own = queries.column("query_id").to_pylist()
            found, products = tree.best(wanted, own, k, queries.column("least").to_pylist())
            rows = [(q, i, score) for q, best in zip(own, found) for score, i in best]
            if taken is not None:
                taken.add(products)
        columns = zip(*rows) if rows else ((), (), ())
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["query_id", "vec_id", "score"])

    wanted = [*keys, "shard", "block"]
    grouped = left.groupBy(*wanted).cogroup(right.groupBy(*wanted))
    return grouped.applyInArrow(search, "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    taken: Accumulator | None = None,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` best vectors.

    Both frames are as ``quantised`` makes them. A vector with the query's own id is
    no candidate, nor is one of another number of components. Equal scores go to the
    smaller id. A query without candidates has no rows; no vectors or no queries give
    no rows. ``taken`` adds up the products that were taken, for a report.
    """
    stored = _stored(vectors, "vectors")
    placed = _stored(with_cells(stored, cells_of(stored, shard_rows)), "cells")
    boxes = boxes_of(placed)
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "n")
    first_asked = targets(asked.withColumn("least", F.lit(None).cast("long")), boxes, home=True)
    first = _stored(searched(placed, first_asked, k, shard_rows, block_rows, taken), "found")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kept = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    reached = kept.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    rest_asked = targets(asked.join(reached, "query_id", "left"), boxes, home=False)
    rest = searched(placed, _stored(rest_asked, "asked"), k, shard_rows, block_rows, taken)
    both = kept.drop("rank").unionByName(rest)
    ranked = both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
