"""MinHash near duplicates and connected components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash
from tidemark.llm.components import components

from .helpers import HARD, clashing, documents


def _set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def _brute(rows, size):
    sets = {doc: _set(text, size) for doc, text in rows}
    label = {doc: doc for doc in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {doc: root(doc) for doc in ids}, {doc: len(found) for doc, found in sets.items()}


def _corpus(seed, crowd):
    """Groups of copies with few to many changes, one of them large."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    texts = []
    for size in [crowd, 12, 5, 3, 2, 2, *[1] * 20]:
        source = [word() for _ in range(rng.choice((30, 80, 200)))]
        for _ in range(size):
            copy = list(source)
            for _ in range(rng.choice((0, 1, 2, len(copy) // 15))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [texts[0]] * 5 + ["", " ", "one", "one", "two words", "Two  words"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size,crowd,block", [(2, 90, 16), (5, 20, 256)])
def test_components(spark, monkeypatch, size, crowd, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = _corpus(size, crowd)
    want, sizes = _brute(rows, size)
    docs = documents(spark, [(i, t, "x", "s", 1) for i, t in rows])
    found = {r.doc_id: r for r in minhash.near_duplicates(clashing(docs), size).collect()}
    assert {i: r.n_shingles for i, r in found.items()} == sizes
    assert {i: r.component_id for i, r in found.items()} == want
    assert all(r.kept == (want[i] == i) for i, r in found.items())


def test_crowds_meet_in_blocks():
    rng = random.Random(9)
    rows = _corpus(3, 60)
    sets = {i: np.sort(minhash.shingles(t, 2)) for i, t in rows if t.strip()}
    right = [(i, i % 4, x.tobytes()) for i, x in sets.items()]
    left = [(i, x.tobytes()) for i, x in sets.items() if rng.random() < 0.3]
    want = set()
    for i, _ in left:
        for j, c, _ in right:
            shared = len(np.intersect1d(sets[i], sets[j]))
            if i != j and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                want.add((i, c))
    links = minhash.block_links(left, right, 80, minhash.least_matches(0.8))
    assert {(i, j % 4) for i, j in links} == want


def test_fewest_matches_grow_with_the_signature():
    least = minhash.least_matches(0.8)
    assert (np.diff(least) > 0).all() and least[-1] < 0.8 * minhash.HASHES


def test_hard_rows(spark):
    docs = clashing(documents(spark))
    found = minhash.near_duplicates(docs, 5).collect()
    assert len(found) == len(HARD)
    assert all(r.component_id == r.doc_id and r.kept for r in found)
    assert sorted((r.doc_id or 0, r.n_shingles) for r in found)[1:4] == [(1, 0), (2, 0), (3, 0)]
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    empty = documents(spark, [])
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.drop_near_duplicates(empty).count() == 0


def test_each_text_of_an_id_is_dropped_on_its_own(spark):
    rng = random.Random(3)
    one, other = (" ".join("".join(rng.choices("abcd", k=5)) for _ in range(60)) for _ in range(2))
    rows = [(1, one), (2, one), (2, other), (2, other), (None, one), (3, None), (3, None)]
    docs = documents(spark, [(i, t, "x", "s", 1) for i, t in rows]).withColumn("a.b", F.lit(1))
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id or 0, r.text or "") for r in kept.collect()))
    assert found == sorted([(1, one), (2, other), (0, one), (3, "")])


def test_texts_of_one_template_do_not_all_pair(spark, monkeypatch):
    """Many texts share three quarters of their shingles: no links, and few rows of pairs."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    shared = [word() for _ in range(150)]
    rows = [(i, " ".join([*shared, *(word() for _ in range(25))])) for i in range(150)]
    counted, plain = [], minhash.likely

    def likely(pairs, *rest):
        counted.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(minhash, "likely", likely)
    docs = documents(spark, [(i, t, "x", "s", 1) for i, t in rows])
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == _brute(rows, 2)[0] and sum(counted) < 40 * len(rows)


def test_components_of_links(spark):
    rng = random.Random(4)
    for n, links in ((40, 30), (60, 59)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(links)]
        pairs += [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
        label = list(range(200))
        for _ in label:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
        assert {r.id: r.component_id for r in rows} == {
            i: label[i] for a, b in pairs if a != b for i in (a, b)
        }
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
