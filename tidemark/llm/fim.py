"""Fill-in-middle transformation by one match with repeated captures.

A text is a run of units. One full match of ``(unit)*`` keeps every repetition of
its group, so that the match itself tells how many units there are and where each
ends: no loop looks for them. Two of these ends, drawn by a hash of the id, cut the
text into prefix, middle and suffix, which are written in another order behind
marks. The text comes back from what was written and its form, by SQL functions.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.rows import arrow_type, slices, texts_of

UNIT = "[A-Za-z]++|[^A-Za-z]"
#: Marks before prefix, suffix and middle. None may start as another ends.
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts, those that change, and of 100 of these, those with the suffix first.
CHANGED, SUFFIX_FIRST = 90, 20
SEED = "1"

PLAIN, PSM, SPM = "plain", "psm", "spm"


@lru_cache(maxsize=4)
def _units(unit: str):
    import regex

    # Possessive: the group is never given back, so a match takes linear time.
    return regex.compile(f"({unit})*+", regex.DOTALL)


def unit_ends(text: str, unit: str = UNIT) -> list[int]:
    """Where each unit of the text ends, in code points.

    Fails if the units do not make up the whole text.
    """
    match = _units(unit).fullmatch(text)
    if match is None:
        raise ValueError(f"a text is not made of {unit}")
    return match.ends(1)


def draws(doc_id: object, seed: str = SEED) -> list[int]:
    """Four numbers of 32 bits from the id; a null id is drawn as an empty one."""
    key = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(
    text: str, drawn: list[int], changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST
) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the text as it is written."""
    ends = unit_ends(text)
    n = len(ends)
    if not n or any(mark in text for mark in MARKS) or drawn[2] % 100 >= changed:
        return n, PLAIN, None, None, text
    first, last = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    at = ends[first - 1] if first else 0
    to = ends[last - 1] if last else 0
    prefix, middle, suffix = text[:at], text[at:to], text[to:]
    if drawn[3] % 100 < suffix_first:
        form, written = SPM, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, written = PSM, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, at, to - at, written


def transform_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    changed: int = CHANGED,
    suffix_first: int = SUFFIX_FIRST,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output for each row of ``docs``.

    Null and empty texts, and texts that hold a mark, stay plain; so does the share
    that ``changed`` leaves. A null id is drawn as an empty one. Repeated rows give one
    result each, all alike; no rows give no rows. No other column is read.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            *T.StructType.fromDDL(
                "n long, form string, prefix_chars long, middle_chars long, output string"
            ).fields,
        ]
    )
    kinds = [arrow_type(field.dataType) for field in schema.fields[1:]]

    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            ids, texts = part.column(0).to_pylist(), texts_of(part.column(1))
            found = [
                transform(text, draws(i, seed), changed, suffix_first)
                for i, text in zip(ids, texts)
            ]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*found), kinds)]
            if found:
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema.names)

    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return read.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was written as ``output`` in ``form``.

    No part holds a mark, so each mark stands once and splits what is around it.
    """

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def digest(transformed: DataFrame) -> DataFrame:
    """The transformed rows with digests of the output and of the restored text."""
    return transformed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
