"""What the text operators share: Arrow batches in, one result row per input row out."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that are Python objects at once; bounds a worker's memory beside the Arrow batch.
ROWS = 256
#: Bytes of text worked on at once, where that takes many times their memory.
BYTES = 1 << 20
#: Mean length of a remembered key above which fewer are remembered.
KEY_LENGTH = 16

Texts = list[str]
Work = Callable[[Texts], Iterable]


def crc_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


class Memory(dict):
    """What ``make`` gives for keys, remembered in two generations of bounded size.

    ``make`` turns a list of keys into their values, whose size is taken to go with the
    key's length. A generation is full with ``most`` keys, or ``KEY_LENGTH`` times as
    many characters. When the young generation is full it becomes the old one; an entry of the old one moves to the young when it is
    used, so what was used lately outlives the rest.
    """

    def __init__(self, make: Callable[[list], Iterable], most: int):
        super().__init__()
        self._make, self._most, self._old = make, most, {}
        self._length = 0

    def __missing__(self, key):
        self.fill({key})
        return self[key]

    def fill(self, keys: set) -> None:
        """Make all ``keys`` known at once, in time that grows with them alone."""
        # Not keys.difference(self), which goes through all of a dict of another class.
        unknown = {key for key in keys if key not in self}
        length = sum(map(len, unknown))
        if len(self) + len(unknown) > self._most or self._length + length > KEY_LENGTH * self._most:
            self._old, self._length = dict(self), 0
            self.clear()
            unknown, length = keys, sum(map(len, keys))
        self._length += length
        new = []
        for key in unknown:
            value = self._old.pop(key, None)
            if value is None:
                new.append(key)
            else:
                self[key] = value
        if new:
            self.update(zip(new, self._make(new)))


#: What a worker keeps from task to task: the last object made, of whatever kind.
_kept: dict = {}


def kept(kind: str, key, make: Callable):
    """The worker's object of a kind, made anew when the key is another.

    Objects of other kinds are let go, so that a job's stages do not add up in a worker.
    """
    held = _kept.get(kind)
    if held is None or held[0] != key:
        let_go()
        held = _kept[kind] = (key, make())
    return held[1]


def let_go() -> None:
    """Nothing is kept any more: for stages that need none of it."""
    if _kept:
        _kept.clear()
        gc.collect()  # a memory and its owner hold each other
        pa.default_memory_pool().release_unused()


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def portions(
    batches: Iterable[pa.RecordBatch], column: int, most: int = BYTES
) -> Iterator[pa.RecordBatch]:
    """As ``slices``, cut also where the texts of a column reach a multiple of ``most`` bytes."""
    for part in slices(batches):
        sizes = pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy()
        at = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), part.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield part.slice(lo, hi - lo)


def texts_of(column: pa.Array) -> Texts:
    """The texts of an Arrow column; null counts as empty."""
    return [text or "" for text in column.to_pylist()]


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def map_texts(
    docs: DataFrame,
    start: Callable[[], Work],
    results: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id and ``results`` (a DDL list of columns) for each row of ``docs``.

    ``start`` runs once per task and returns the function that turns a list of
    texts into one sequence per result column. No other column is read, so extra
    columns of any name do no harm; a row that occurs twice gives two results.
    """
    added = T.StructType.fromDDL(results)
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *added.fields])
    kinds = [arrow_type(field.dataType) for field in added.fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for part in slices(batches):
            found = work(texts_of(part.column(1)))
            columns = [pa.array(values, kind) for values, kind in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return read.mapInArrow(run, schema)
