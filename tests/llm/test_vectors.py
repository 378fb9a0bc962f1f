"""Top-k search and embedding near duplicates against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import capdedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int"
BROKEN = [
    (900, None, 0), (901, [None, 1.0], 0), (902, [math.nan, 1.0], 0), (903, [math.inf, 1.0], 0),
    (904, [0.0] * 8, 0), (905, [], 0), (None, [1.0] * 8, 0), (906, [1.0, 0.0], 0), (907, [2.0, 0.0], 0),
]


def _table(spark, points, first=0):
    rows = [(first + i, [float(x) for x in p], i % 3) for i, p in enumerate(points)]
    return spark.createDataFrame(rows + BROKEN, SCHEMA).repartition(5)


def _points(n, d, seed=0):
    rng = np.random.default_rng(seed)
    near = rng.normal(size=(n // 3, d))
    out = np.concatenate([near, near[: n // 4] + rng.normal(size=(n // 4, d)) * 0.08, rng.normal(size=(n, d))])
    return np.concatenate([out, out[:5], np.round(out[:40])]).astype(np.float32)


@pytest.mark.parametrize("scale,shard", [(1, 64), (3e5, 50), (0.01, 10_000)])
def test_top_k(spark, scale, shard):
    points = _points(150, 8) * np.float32(scale)
    vectors = topk.quantised(_table(spark, points).withColumn("rank", F.lit(1)))
    queries = vectors.where("vec_id % 10 = 0")
    rows = topk.top_k(vectors, queries, 5, shard_rows=shard, block_rows=7).collect()
    whole = [[math.floor(256 * float(x)) for x in p] for p in points]
    whole = dict(enumerate(whole)) | {904: [0] * 8}
    got = {}
    for row in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    for q in (i for i in whole if i % 10 == 0):
        scores = [(-sum(x * y for x, y in zip(whole[q], whole[i])), i) for i in whole if i != q]
        assert got[q] == [(i, -s) for s, i in sorted(scores)[:5]]
    assert set(got) == {i for i in whole if i % 10 == 0}


def test_cells_are_even_and_boxes_bound():
    rng = np.random.default_rng(4)
    points = np.floor(rng.normal(size=(3_000, 6)) * 256)
    points[:900] = points[0]
    cells = topk.Cells.cut(points, 16)
    found = cells.of(points)
    assert 8 <= len(set(found.tolist())) <= 16
    assert np.bincount(found[900:]).max() < 800 and len(set(found[:900].tolist())) == 1
    tree = topk.Tree(points, np.arange(3_000), leaf=32)
    queries = np.floor(rng.normal(size=(20, 6)) * 256)
    reach = topk.bounds(queries, tree.low, tree.high)
    for (start, end), bound in zip(tree.parts, reach.T):
        assert ((queries @ tree.points[start:end].T).max(1) <= bound).all()
    assert sorted(tree.ids.tolist()) == list(range(3_000))


def test_far_points_are_passed_over(spark):
    """Clustered vectors: most products are never taken; the results are exact all the same."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 6
    points = (centres[rng.integers(0, 40, 6_000)] + rng.normal(size=(6_000, 8)) * 0.2).astype(np.float32)
    vectors = topk.quantised(_table(spark, points).where("vec_id < 900 or vec_id >= 908"))
    queries = vectors.where("vec_id % 100 = 1")
    taken = spark.sparkContext.accumulator(0)
    rows = topk.top_k(vectors, queries, 5, shard_rows=400, taken=taken).collect()
    whole = np.floor(256 * points.astype(np.float64))
    keep = np.array([i for i in range(6_000) if not 900 <= i < 908])
    for q in range(1, 6_000, 100):
        if not 900 <= q < 908:
            scores = whole[keep] @ whole[q]
            order = sorted((-s, i) for s, i in zip(scores, keep.tolist()) if i != q)[:5]
            got = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
            assert [(i, s) for _, i, s in got] == [(i, -s) for s, i in order]
    assert taken.value < 0.3 * queries.count() * len(keep)


def test_top_k_of_few(spark):
    none = topk.quantised(spark.createDataFrame([], SCHEMA))
    assert topk.top_k(none, none).count() == 0
    two = topk.quantised(spark.createDataFrame([(0, [1.0], 0), (0, [1.0], 1), (1, [2.0], 0)], SCHEMA))
    assert [tuple(r) for r in topk.top_k(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1, 131072)]


def _brute(points):
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    near = units @ units.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(points))
    for _ in range(len(points)):
        label = np.minimum(label, np.where(near, label[None, :], len(points)).min(1))
    return near, label


@pytest.mark.parametrize("chunk", [1_024, 16])
def test_near_duplicates(spark, monkeypatch, chunk):
    monkeypatch.setattr(capdedup, "CHUNK", chunk)
    points = _points(400, 24, seed=3)
    points = np.concatenate([points, np.repeat(points[:1], 60, 0)]).astype(np.float32)
    points = points[np.linalg.norm(points, axis=1) > 0]
    near, label = _brute(points.astype(np.float64))
    found = {r.vec_id: r for r in capdedup.near_duplicates(_table(spark, points)).collect() if r.vec_id is not None}
    links = np.array([found[i].n_links for i in range(len(points))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.98 * near.sum()
    same = np.mean([found[i].component_id == label[i] for i in range(len(points))])
    assert same >= 0.98
    assert all(r.kept == (r.component_id == r.vec_id) for r in found.values())
    for broken in (900, 901, 902, 903, 904, 905):
        assert (found[broken].n_links, found[broken].component_id) == (0, broken)
    assert found[907].component_id == 906 and found[906].n_links == 1


def test_near_duplicates_of_nothing(spark):
    assert capdedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_all_filters_are_decoded():
    code = capdedup.ProductCode(20, 2_000)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(10, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    first = x @ code.rotation[:20] if code.d == 20 else None
    left = first[:, : code.cut] @ code.codes[0].T
    right = first[:, code.cut :] @ code.codes[1].T
    for row, found in enumerate(code.decode(x)):
        want = np.flatnonzero((left[row][:, None] + right[row][None, :] >= code.alpha).ravel())
        assert set(want) ^ set(found) <= set()


@pytest.mark.parametrize("n", [2_000, 50_000, 400_000])
@pytest.mark.parametrize("cosine", [0.95, 0.97, 0.999])
def test_pairs_meet_at_any_number_of_vectors(n, cosine):
    rng = np.random.default_rng(17)
    x, y = rng.normal(size=(2, 1_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (y * x).sum(1, keepdims=True) * x
    y = cosine * x + (1 - cosine**2) ** 0.5 * y / np.linalg.norm(y, axis=1, keepdims=True)
    ours, theirs = (capdedup.filters_of(v, n, 0.95) for v in (x, y))
    assert min(map(len, ours)) >= capdedup.PER_VECTOR
    assert sum(bool(set(a) & set(b)) for a, b in zip(ours, theirs)) >= 995
