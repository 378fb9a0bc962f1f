"""Near duplicates of embeddings by spherical-cap filters.

A filter is a direction; a vector passes it if its cosine with the direction reaches
its cap, so vectors at a small angle pass many filters together. Directions are a
random product code: a random rotation, then the space in two blocks with a code of
random unit vectors each; every pair of code words is a direction. All filters that
a vector passes are list-decoded from the products of its blocks with the words:
sorted by size, pairs are taken while they reach the cap. Vectors meet in their
filters and cosines decide.

A vector's cap is where it passes ``PER_VECTOR`` filters of a code, so none passes too
few. The words follow from the number of vectors: about ``PER_FILTER`` of them pass a
filter. What one code misses grows slowly with that number, so there are as many codes,
each rotated by itself, as it takes for a pair at the threshold to meet in none of them
with probability ``MISS`` at most. As rotations are random, that holds for every pair
alike, wherever it lies.

A filter that a large group passes is cut into chunks whose pairs are tasks of their
own. Pairs are counted where they first meet and never leave the task: it returns
counts, and one link per vector of a component.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.rows import slices
from tidemark.workspace import new_folder

PER_FILTER = 4
PER_VECTOR = 16
#: The most probable it may be that a pair at the threshold passes no filter together.
MISS = 1e-3
#: Pairs drawn at the threshold to see what one code misses.
TRIALS = 2_048
#: Vectors of one chunk of a filter.
CHUNK = 1_024
#: Vectors of fewer components are padded with zeros to this many, which keeps their cosines.
LEAST_DIMENSIONS = 16


def cap(p: float, d: int) -> float:
    """The cosine that a random direction of ``d`` dimensions reaches with probability ``p``."""
    u = np.linspace(-1, 1, 200_001)
    density = np.maximum(1 - u * u, 1e-300) ** ((d - 3) / 2)
    tail = np.cumsum(density[::-1])[::-1] / density.sum()
    return float(u[np.argmax(tail <= p)])


@lru_cache(maxsize=16)
def _best_ranks(least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in two lists whose pair can be among the ``least`` largest sums."""
    pairs = [(i, j) for i in range(least) for j in range(least // (i + 1))]
    return tuple(np.array(pairs).T)


def _own_cap(x: np.ndarray, falling: np.ndarray, least: int) -> float:
    """The size that ``least`` sums of a number of ``x`` and one of ``falling`` reach."""
    best = -np.sort(-x)[:least]
    i, j = _best_ranks(least)
    there = (i < len(best)) & (j < len(falling))
    sums = best[i[there]] + falling[j[there]]
    # A little lower, so that rounding keeps the last one.
    return float(np.partition(sums, len(sums) - least)[len(sums) - least]) - 1e-12


class ProductCode:
    """Filters for vectors of ``size`` components among about ``n`` vectors.

    Codes of another ``number`` are drawn independently.
    """

    def __init__(self, size: int, n: int, number: int = 0):
        self.size, self.d = size, max(size, LEAST_DIMENSIONS)
        p = min(1e-3, PER_FILTER / max(n, 1))
        self.words = max(8, round((PER_VECTOR / p) ** 0.5))
        self.alpha = cap(p, self.d)
        rng = np.random.default_rng(64_023 + number)
        self.rotation = np.linalg.qr(rng.normal(size=(self.d, self.d)))[0]
        self.cut = self.d // 2
        self.codes = []
        for width in (self.cut, self.d - self.cut):
            code = rng.normal(size=(self.words, width))
            code *= (width / self.d) ** 0.5 / np.linalg.norm(code, axis=1, keepdims=True)
            self.codes.append(code)

    def decode(self, vectors: np.ndarray, least: int = 0) -> list[np.ndarray]:
        """Sorted numbers of all filters that each unit vector passes.

        The cap is ``alpha``, or each vector's own at which it passes ``least``.
        """
        padded = np.zeros((len(vectors), self.d))
        padded[:, : self.size] = vectors
        turned = padded @ self.rotation
        first = turned[:, : self.cut] @ self.codes[0].T
        second = turned[:, self.cut :] @ self.codes[1].T
        found = []
        for x, y in zip(first, second):
            order = np.argsort(-y)
            ranked = -y[order]
            alpha = _own_cap(x, -ranked, least) if least else self.alpha
            rows = np.flatnonzero(x + y.max() >= alpha)
            reach = np.searchsorted(ranked, x[rows] - alpha, side="right")
            passed = [row * self.words + order[:n] for row, n in zip(rows.tolist(), reach.tolist())]
            found.append(np.sort(np.concatenate(passed)) if passed else np.zeros(0, np.int64))
        return found


@lru_cache(maxsize=16)
def product_codes(size: int, n: int, threshold: float) -> list[ProductCode]:
    """As many codes as keep the misses at ``threshold`` under ``MISS``, by trials with the first."""
    first = ProductCode(max(size, LEAST_DIMENSIONS), n)
    one, other = np.random.default_rng(95).normal(size=(2, TRIALS, first.d))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    other = threshold * one + max(0.0, 1 - threshold**2) ** 0.5 * other
    passed = zip(first.decode(one, PER_VECTOR), first.decode(other, PER_VECTOR))
    missed = sum(not len(np.intersect1d(a, b, True)) for a, b in passed)
    codes = math.ceil(math.log(MISS) / math.log((missed + 1) / (TRIALS + 2)))
    return [ProductCode(size, n, number) for number in range(codes)]


def filters_of(units: np.ndarray, n: int, threshold: float) -> list[np.ndarray]:
    """Sorted numbers of the filters of all codes that each unit vector passes."""
    codes = product_codes(units.shape[1], n, threshold)
    passed = [
        [filters + number * code.words**2 for filters in code.decode(units, PER_VECTOR)]
        for number, code in enumerate(codes)
    ]
    return [np.concatenate(each) for each in zip(*passed)]


def _stored(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def decoded(classes: DataFrame, n: int, threshold: float) -> DataFrame:
    """``classes`` with the filters that each passes; vectors become unit vectors.

    A filter's number is joined with the number of components, so that only vectors
    of one kind meet.
    """
    kind = classes.schema["class_id"].dataType
    schema = T.StructType(
        [
            T.StructField("class_id", kind),
            T.StructField("copies", T.LongType()),
            T.StructField("unit", T.ArrayType(T.DoubleType())),
            T.StructField("filters", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches):
        for part in slices(batches, 1_024):
            vectors = [np.array(v, np.float64) for v in part.column(2).to_pylist()]
            units: list = [None] * len(vectors)
            filters: list = [None] * len(vectors)
            for size in {len(v) for v in vectors}:
                rows = [i for i, v in enumerate(vectors) if len(v) == size]
                some = np.stack([vectors[i] for i in rows])
                some = some / np.abs(some).max(1, keepdims=True)
                some /= np.linalg.norm(some, axis=1, keepdims=True)
                for i, unit, passed in zip(rows, some, filters_of(some, n, threshold)):
                    units[i], filters[i] = unit, passed * 65_536 + size
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    _lists(units, pa.float64()),
                    _lists(filters, pa.int64()),
                ],
                schema.names,
            )

    return classes.select("class_id", "copies", "vector").mapInArrow(run, schema)


def _groups(batches, keys: int):
    """Runs of rows that agree in the first ``keys`` columns, of rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        changes = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1
        for start, end in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
            key = tuple(int(c[start]) for c in columns)
            if held and key != last:
                yield last, held
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield last, held


def _local_components(near: np.ndarray) -> np.ndarray:
    """The first row that each row of a link matrix is connected with."""
    label = np.arange(len(near))
    while True:
        least = np.where(near, label[None, :], len(near)).min(1)
        least = np.minimum(least, label)
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def _meet(filter_id: int, left: int, right: int, rows: list[pa.RecordBatch], threshold: float):
    """Link counts and one link per row of a component, of one filter's chunks."""
    ids = np.concatenate([r.column(4).to_numpy() for r in rows])
    chunk = np.concatenate([r.column(3).to_numpy() for r in rows])
    order = np.argsort(ids, kind="stable")
    units = np.array([u for r in rows for u in r.column(6).to_pylist()])[order]
    ids, chunk = ids[order], chunk[order]
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    if left != right:  # pairs inside a chunk meet where that chunk stands alone
        near &= chunk[:, None] != chunk[None, :]
    linked = np.flatnonzero(near.any(1))
    if not len(linked):
        return None
    near, ids = near[np.ix_(linked, linked)], ids[linked]
    copies = np.concatenate([r.column(5).to_numpy() for r in rows])[order][linked]
    filters = [f for r in rows for f in r.column(7).to_pylist()]
    earlier = [[f for f in filters[order[i]] if f < filter_id] for i in linked]
    number = {f: i for i, f in enumerate(sorted(set().union(*earlier)))}
    member = np.zeros((len(linked), len(number)), np.float32)
    for i, mine in enumerate(earlier):
        member[i, [number[f] for f in mine]] = 1
    first = near & (member @ member.T == 0)
    label = _local_components(near)
    return ids, first @ copies, ids[label]


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors``.

    Vectors link if their cosine in double precision is at least ``threshold``; those
    that are null, empty or zero, hold a null or non-finite component, or have a null
    id, link with nothing, nor do vectors of different numbers of components.
    ``n_links`` counts the other vectors linked directly, copies too; ``component_id``
    is the smallest id that links reach. A row without id has a null component and is
    kept. No rows give no rows.
    """
    v = F.col("vector")
    usable = (
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        & F.exists(v, lambda c: c != 0)
    )
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    keyed = rows.withColumn(
        "key", F.when(F.coalesce(usable, F.lit(False)), F.sha2(F.to_json(F.struct("vector")), 256))
    )
    keyed = _stored(keyed, "vectors")
    classes = keyed.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("class_id"),
        F.count("*").alias("copies"),
        F.first("vector").alias("vector"),
    )
    classes = _stored(classes, "classes")
    found = _stored(decoded(classes, classes.count(), threshold), "filters")

    places = found.select("class_id", F.explode("filters").alias("filter"))
    sizes = places.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("long")
    dealt = places.join(sizes, "filter").select(
        "filter", "class_id", chunks.alias("chunks"),
        F.pmod(F.xxhash64("class_id", "filter"), chunks).alias("chunk"),
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "filter",
        F.least("chunk", "other").alias("left"),
        F.greatest("chunk", "other").alias("right"),
        "chunk",
        "class_id",
    )
    met = dealt.join(found.select("class_id", "copies", "unit", "filters"), "class_id").select(
        "filter", "left", "right", "chunk", "class_id", "copies", "unit", "filters"
    )
    met = met.repartition("filter", "left", "right").sortWithinPartitions("filter", "left", "right")

    def run(batches):
        for (filter_id, left, right), group in _groups(batches, 3):
            if sum(r.num_rows for r in group) > 1:
                result = _meet(filter_id, left, right, group, threshold)
                if result:
                    ids, counts, leaders = result
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids, pa.int64()),
                            pa.array(counts, pa.int64()),
                            pa.array(leaders, pa.int64()),
                        ],
                        ["class_id", "n", "leader"],
                    )

    meetings = _stored(met.mapInArrow(run, "class_id long, n long, leader long"), "meetings")
    links = meetings.select(F.col("class_id").alias("a"), F.col("leader").alias("b"))
    counts = meetings.groupBy("class_id").agg(F.sum("n").alias("others"))
    placed = (
        classes.select("key", "class_id", "copies")
        .join(counts, "class_id", "left")
        .join(components(links).withColumnRenamed("id", "class_id"), "class_id", "left")
        .select(
            "key",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "class_id").alias("component_id"),
        )
    )
    joined = keyed.select("vec_id", "key").join(placed, "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
