"""Keyed tables on disk: steps, replay, torn writes, folding beside writers, expiry."""

import os

import pytest

from tidemark.operators import keyed
from tidemark.workspace import hidden, publish, settle_text

KEYS = ("k",)
ORDER = ("ts", "v")


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "k int, ts int, v string")


def _table(spark, root):
    table = keyed.read(spark, root, KEYS)
    return None if table is None else {tuple(r) for r in table.select("k", "ts", "v").collect()}


def _append(spark, root, *rows, **options):
    keyed.append(spark, root, _rows(spark, *rows), KEYS, **options)


def test_the_incoming_row_wins(spark, tmp_path):
    root = str(tmp_path / "t")
    assert _table(spark, root) is None
    _append(spark, root, (1, 9, "a"), (2, 1, "a"))
    _append(spark, root, (1, 1, "b"), (3, 1, "b"))
    want = {(1, 1, "b"), (2, 1, "a"), (3, 1, "b")}
    assert _table(spark, root) == want
    keyed.fold(spark, root, KEYS)
    assert _table(spark, root) == want
    _append(spark, root, (2, 0, "c"))
    assert _table(spark, root) == {(1, 1, "b"), (2, 0, "c"), (3, 1, "b")}


def test_the_newer_row_wins_in_an_ordered_table(spark, tmp_path):
    root = str(tmp_path / "t")
    _append(spark, root, (1, 5, "new"), (2, 1, "old"), order=ORDER)
    keyed.fold(spark, root, KEYS)
    _append(spark, root, (1, 1, "late"), (2, 2, "new"), order=ORDER)
    assert _table(spark, root) == {(1, 5, "new"), (2, 2, "new")}
    with pytest.raises(ValueError, match="ordered"):
        _append(spark, root, (1, 1, "x"))


def test_a_step_of_a_run_is_put_in_once(spark, tmp_path):
    root = str(tmp_path / "t")
    _append(spark, root, (1, 1, "a"), run="2024-01-31/q", step=0)
    _append(spark, root, (1, 2, "b"), run="2024-01-31/q", step=1)
    reader = keyed.read(spark, root, KEYS)
    for step in (0, 1):
        _append(spark, root, (1, 9, "again"), run="2024-01-31/q", step=step)
    assert _table(spark, root) == {(1, 2, "b")} and reader.count() == 1
    _append(spark, root, (1, 0, "other run"), run="p", step=0)
    assert _table(spark, root) == {(1, 0, "other run")}


def test_what_is_not_published_does_not_count(spark, tmp_path):
    """A writer that died while writing, and one that died before the rename."""
    root = str(tmp_path / "t")
    _append(spark, root, (1, 1, "a"))
    made, inside = keyed.prepare(root, "q", 0)
    _rows(spark, (1, 2, "lost")).write.parquet(f"{inside}/{keyed.KIND}={keyed.CHANGES}")
    torn = hidden(root)
    os.makedirs(torn)
    (tmp_path / "t" / os.path.basename(torn) / "part-0.parquet").write_bytes(b"PAR1 half")
    assert _table(spark, root) == {(1, 1, "a")}
    _append(spark, root, (2, 1, "b"))
    keyed.fold(spark, root, KEYS)
    assert _table(spark, root) == {(1, 1, "a"), (2, 1, "b")}
    assert not keyed.is_published(spark, root, "q", 0)
    keyed.publish_step(spark, root, made)  # as its writer would have done
    assert keyed.is_published(spark, root, "q", 0)
    assert _table(spark, root) == {(1, 2, "lost"), (2, 1, "b")}


def test_a_place_is_taken_once(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(str(tmp_path / name))
    assert publish(spark, str(tmp_path / "a"), str(tmp_path / "x" / "y"))
    assert not publish(spark, str(tmp_path / "b"), str(tmp_path / "x" / "y"))
    assert sorted(os.listdir(tmp_path)) == ["b", "x"]
    assert settle_text(spark, str(tmp_path / "t" / "f"), "one") == "one"
    assert settle_text(spark, str(tmp_path / "t" / "f"), "two") == "one"


def test_two_writers_get_numbers_of_their_own(spark, tmp_path):
    root = str(tmp_path / "t")
    _append(spark, root, (1, 1, "a"))
    slow, inside = keyed.prepare(root, "slow", 0)
    _rows(spark, (1, 2, "slow")).write.parquet(f"{inside}/{keyed.KIND}={keyed.CHANGES}")
    _append(spark, root, (1, 3, "fast"), (2, 1, "fast"))
    assert keyed.publish_step(spark, root, slow) == 3
    assert _table(spark, root) == {(1, 2, "slow"), (2, 1, "fast")}


def test_a_fold_beside_a_writer_loses_nothing(spark, tmp_path, monkeypatch):
    """Steps are published while a base is being written, and before that is published."""
    root = str(tmp_path / "t")
    _append(spark, root, (1, 1, "a"))
    real = keyed.publish

    def beside(session, made, final):
        if "/base/" in final:
            monkeypatch.setattr(keyed, "publish", real)
            _append(spark, root, (1, 2, "b"), (2, 1, "b"))
        return real(session, made, final)

    monkeypatch.setattr(keyed, "publish", beside)
    keyed.fold(spark, root, KEYS)
    assert keyed.base_of(spark, root) == 1
    assert _table(spark, root) == {(1, 2, "b"), (2, 1, "b")}
    assert keyed.expire(spark, root) == [f"{root}/steps/_stamp=1"]
    assert _table(spark, root) == {(1, 2, "b"), (2, 1, "b")}


def test_expiry_keeps_what_the_table_needs(spark, tmp_path):
    root = str(tmp_path / "t")
    assert keyed.expire(spark, root) == []
    for i in range(3):
        _append(spark, root, (1, i, "a"), (i, i, "a"))
    keyed.fold(spark, root, KEYS)
    want = {(0, 0, "a"), (1, 2, "a"), (2, 2, "a")}
    assert _table(spark, root) == want
    assert len(keyed.expire(spark, root, needed=lambda stamp: stamp == 2)) == 1
    assert len(keyed.expire(spark, root)) == 1
    assert keyed.stamps(spark, root) == [3] and _table(spark, root) == want
    _append(spark, root, (1, 9, "b"))
    keyed.fold(spark, root, KEYS)
    assert keyed.base_of(spark, root) == 4 and len(os.listdir(f"{root}/base")) == 2
    keyed.expire(spark, root)
    assert os.listdir(f"{root}/base") == ["upto=4"]
    assert _table(spark, root) == {(0, 0, "a"), (1, 9, "b"), (2, 2, "a")}
    with pytest.raises(ValueError):
        keyed.expire(spark, root, keep=0)


def test_folding_is_due_after_so_many_steps_and_shuffles_once(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(4):
        _append(spark, root, (i, i, "a"), fold_every=4)
    assert keyed.base_of(spark, root) == 4 and len(_table(spark, root)) == 4
    _append(spark, root, (1, 9, "b"))
    plan = keyed.read(spark, root, KEYS)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1
