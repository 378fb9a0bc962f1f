"""Token counts by a map-side two-tier lookup of pre-token lengths.

A pre-token is a run of Latin letters, or of other characters, with the spaces
before it. No piece of the model has a space behind another character, and none
joins a Latin letter with a character of another kind (``load`` verifies both), so
no token crosses from one pre-token into the next and a text's count is the sum
over its pre-tokens.

Tier one is a table of frequent pre-tokens and their token counts, broadcast in a
compact form and held as a hash table by each worker. Tier two is a bounded cache
in each worker for what the table lacks; a miss there is encoded. Only documents'
counts leave a task: there is no shuffle of pre-tokens, whatever their number.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import map_texts, slices

#: Rows read to choose the frequent pre-tokens. They decide speed only, never a count.
SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 8_000
#: Most entries of the broadcast table (about 1 MB) and of a worker's cache of misses.
FREQUENT = 100_000
CACHED = 200_000

SPACE = "▁"
_LETTER = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_UNITS = re.compile(f" *(?:[{_LETTER}]+|[^{_LETTER} ]+)| +")
_CROSSING = re.compile(f"[{_LETTER}][^{_LETTER}]|[^{_LETTER}][{_LETTER}]")


@lru_cache(maxsize=2)
def load(path: str):
    """The model, after a check that the cuts made here are exact for it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i).lstrip(SPACE)
        if SPACE in piece or "\n" in piece or _CROSSING.search(piece):
            raise ValueError(f"piece {i} crosses a cut: {piece!r}")
    return model


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a non-empty text; the library puts a space before it."""
    return _UNITS.findall(" " + text.replace(SPACE, " "))


def lengths_of(model, units: list[str]) -> list[int]:
    """Tokens of each pre-token in its place.

    One that starts with a space gets that space from the library. Another is
    encoded behind a line feed, which is joined with nothing: two tokens more. A
    space alone is one token.
    """
    texts = [unit[1:] if unit[0] == " " else "\n" + unit for unit in units]
    found = model.encode(texts, num_threads=1)
    return [
        (len(ids) if unit[0] == " " else len(ids) - 2) or 1
        for unit, ids in zip(units, found, strict=True)
    ]


class Lengths:
    """Tokens per pre-token: the given table, then a bounded cache, then the model."""

    def __init__(self, table: dict[str, int], model, cached: int = CACHED):
        self._table, self._model, self._cached = table, model, cached
        self._known = dict(table)

    def _learn(self, units: set[str]) -> None:
        new = units.difference(self._known)
        if len(self._known) + len(new) > len(self._table) + self._cached:
            self._known = dict(self._table)
            new = units.difference(self._known)
        new = list(new)
        self._known.update(zip(new, lengths_of(self._model, new)))

    def count(self, text: str) -> int:
        if not text:
            return 0
        units = pre_tokens(text)
        try:
            return sum(map(self._known.__getitem__, units))
        except KeyError:
            self._learn(set(units))
            return sum(map(self._known.__getitem__, units))


def frequent_pre_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    limit: int = FREQUENT,
) -> tuple[str, bytes]:
    """The most frequent pre-tokens of a sample and their lengths, in compact form.

    The sample is about ``sample_rows`` rows of at most ``SAMPLE_BYTES`` bytes, those
    whose hash of id and text is least, from all over the table. Each task counts its
    own and passes on the ``limit`` most frequent; only the first ``limit`` of all come
    to the driver. Entries are joined by null characters; lengths are 16-bit numbers.
    """
    text = F.col(text_col).cast("string").alias("text")
    spread = max(1, docs.count() // sample_rows)
    chosen = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(spread)) == 0
    sample = docs.where(chosen).select(text).where(
        F.octet_length("text").between(1, SAMPLE_BYTES)
    )

    def count(batches):
        seen = Counter()
        for part in slices(batches):
            for one in part.column(0).to_pylist():
                seen.update(u for u in pre_tokens(one) if len(u) < 64 and "\0" not in u)
        most = seen.most_common(limit)
        yield pa.RecordBatch.from_arrays(
            [pa.array([u for u, _ in most], pa.string()), pa.array([n for _, n in most], pa.int64())],
            ["unit", "n"],
        )

    counted = sample.mapInArrow(count, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "unit").limit(limit).select("unit")
    units = [row.unit for row in top.collect()]
    return "\0".join(units), np.array(lengths_of(load(model_path), units), "<u2").tobytes()


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row of ``docs``.

    Null and empty texts have no bytes and no tokens. Repeated rows count each.
    No rows give no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_pre_tokens(docs, model_path, id_col, text_col)
    )

    def start():
        lengths = _lengths(model_path, table)

        def work(texts):
            tokens = [lengths.count(text) for text in texts]
            yield [len(text.encode()) for text in texts]
            yield tokens
            yield [n > limit for n in tokens]

        return work

    return map_texts(
        docs, start, "n_bytes long, n_tokens long, over_limit boolean", id_col, text_col
    )


#: The last table a worker has unpacked, with its cache, kept from task to task.
_held: dict = {}


def _lengths(model_path: str, table) -> Lengths:
    units, lengths = table.value
    key = (model_path, hash(units), len(lengths))
    if key not in _held:
        _held.clear()
        known = dict(zip(units.split("\0"), np.frombuffer(lengths, "<u2").tolist())) if units else {}
        _held[key] = Lengths(known, load(model_path))
    return _held[key]
