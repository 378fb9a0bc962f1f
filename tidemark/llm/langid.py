"""Language identification by prediction by partial matching.

Each language has a context tree over the bytes of its words: a node is a context of
up to ``ORDER`` bytes, back to the space before the word at most, and counts the
bytes that followed. A byte not seen in a context escapes to the next shorter one
(a node with q different bytes among n gives each byte its count / (n + q) and the
escape q / (n + q)); below the root all 256 bytes are equally likely. With these
statistics frozen, the code length of a text in each language is exact, and the
language with the shortest one is the prediction.

A context never reaches past the space before a word, so the code length of a text
is the sum over its words. The trees of all languages are flattened to one table of
code lengths by run of bytes, and a worker caches words.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import kept, map_texts, slices, texts_of

ORDER = 4
#: Bounds of the training sample: rows per language, and bytes of a text.
SAMPLE_ROWS = 600
SAMPLE_BYTES = 8_000
#: Most languages that are learned, those of the most rows; bounds the table of code lengths.
LANGUAGES = 200
#: Rows of a language that a hash leaves to rank, as a multiple of ``SAMPLE_ROWS``.
SPARE = 4
CACHED = 150_000
UNKNOWN = "und"
#: A text whose shortest code is longer than this, in bits per byte, is in no learned language.
MOST_BITS = 6.0

#: Bytes of words: letters and all beyond ASCII; A-Z become small.
_TO_WORDS = bytes(
    b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def has_letter(text: str) -> bool:
    """Whether any character is of a Unicode category of letters."""
    return any(map(str.isalpha, text))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split()


def runs(word: bytes):
    """For each byte of a word, the run of its longest context and itself."""
    marked = b" " + word
    for i in range(1, len(marked)):
        yield marked[max(0, i - ORDER) : i + 1]


def count_runs(words: Counter) -> Counter:
    """Occurrences of each run of bytes, a context and the byte after it, of every order."""
    found: Counter = Counter()
    for word, n in words.items():
        for run in runs(word):
            for i in range(len(run)):
                found[run[i:]] += n
    return found


@dataclass
class Model:
    """Languages in order, and code lengths in bits by run and of escapes by context."""

    languages: list[str]
    runs: dict[bytes, int]
    escapes: dict[bytes, int]
    bits: np.ndarray


def build(counted: dict[str, Counter]) -> Model:
    """Flatten the trees: every run that any language has, priced in each language."""
    if not counted:
        return Model([], {}, {}, np.zeros((0, 0)))
    languages = sorted(counted)
    nodes: list[dict[bytes, list[int]]] = []
    for language in languages:
        tree: dict[bytes, list[int]] = {}
        for run, n in counted[language].items():
            node = tree.setdefault(run[:-1], [0, 0])
            node[0] += n
            node[1] += 1
        nodes.append(tree)
    rows: list[list[float]] = []
    escapes: dict[bytes, int] = {}
    for context in sorted(set().union(*nodes)):
        escapes[context] = len(rows)
        rows.append(
            [
                math.log2((tree[context][0] + tree[context][1]) / tree[context][1])
                if context in tree
                else 0.0
                for tree in nodes
            ]
        )
    at: dict[bytes, int] = {}
    nothing = [0.0] * len(languages)
    for run in sorted(set().union(*counted.values()), key=len):
        context, shorter = run[:-1], run[1:]
        below = rows[at[shorter]] if len(run) > 1 else [8.0] * len(languages)
        escape = rows[escapes[context]] if context in escapes else nothing
        prices = []
        for i, language in enumerate(languages):
            n = counted[language].get(run)
            if n:
                total, kinds = nodes[i][context]
                prices.append(math.log2((total + kinds) / n))
            else:
                prices.append(escape[i] + below[i])
        at[run] = len(rows)
        rows.append(prices)
    return Model(languages, at, escapes, np.array(rows, np.float64).reshape(-1, len(languages)))


class Scorer:
    """Code lengths of texts; remembers those of words."""

    def __init__(self, model: Model, cached: int = CACHED):
        self.model, self._cached = model, cached
        self._known: dict[bytes, int] = {}
        self._bits = np.zeros((cached, len(model.languages)), np.float32)

    def _prices(self, word: bytes) -> tuple[list[int], int]:
        """Rows of the table that a word adds up, and its bytes that no language has seen."""
        runs_, escapes, found, new = self.model.runs, self.model.escapes, [], 0
        for run in runs(word):
            row = runs_.get(run)
            while row is None:
                row = escapes.get(run[:-1])
                if row is not None:
                    found.append(row)
                run = run[1:]
                if not run:
                    new += 1
                    break
                row = runs_.get(run)
            else:
                found.append(row)
        return found, new

    def word_bits(self, words: list[bytes]) -> np.ndarray:
        """Code length of each word in each language, in bits."""
        priced = [self._prices(word) for word in words]
        flat = np.array([row for rows, _ in priced for row in rows], np.int64)
        owner = np.repeat(np.arange(len(words)), [len(rows) for rows, _ in priced])
        new = 8.0 * np.array([n for _, n in priced])
        return np.stack(
            [
                np.bincount(owner, self.model.bits[flat, i], len(words)) + new
                for i in range(len(self.model.languages))
            ],
            1,
        )

    def _learn(self, words: set[bytes]) -> None:
        new = list(words.difference(self._known))
        if len(self._known) + len(new) > self._cached:
            self._known.clear()
            new = list(words)
            if len(new) > len(self._bits):
                self._bits = np.zeros((2 * len(new), self._bits.shape[1]), np.float32)
        at = len(self._known)
        self._bits[at : at + len(new)] = self.word_bits(new)
        self._known.update(zip(new, range(at, at + len(new))))

    def bits(self, text: str) -> tuple[np.ndarray, int]:
        """Code length of a text in each language, and the bytes it codes."""
        words = words_of(text)
        if not words:
            return np.zeros(len(self.model.languages)), 0
        try:
            rows = np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))
        except KeyError:
            self._learn(set(words))
            rows = np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))
        return self._bits[rows].sum(0, dtype=np.float64), sum(map(len, words))

    def predict(self, text: str) -> tuple[str, float, float]:
        """Language, its share of the probability, and bits per byte.

        Equal code lengths go to the language first in order.
        """
        if not self.model.languages or not has_letter(text):
            return UNKNOWN, 0.0, 8.0
        bits, n = self.bits(text)
        best = int(bits.argmin())
        share = 1.0 / float(np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())
        return self.model.languages[best], share, float(bits[best]) / max(1, n)


def training_sample(
    docs: DataFrame, trainable: Column | None = None, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """lang and text of at most ``rows`` texts of each of at most ``LANGUAGES`` languages.

    Rows are chosen by a hash of id and text among those of at most ``SAMPLE_BYTES``
    bytes; a language needs one such row to be learned. Rows without language, or
    without text, are left out, and of rows that repeat one counts. Only rows whose
    hash is below the share of the language's rows that is wanted, with some to spare,
    are ranked, so no language's rows meet in one task.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang")
    if trainable is not None:
        known = known.where(trainable)
    known = known.where(
        F.col("lang").isNotNull() & (F.octet_length("text").between(1, SAMPLE_BYTES))
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("place"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    span = 1 << 63
    below = [
        (row["lang"], min(span - 1, int(-span + 2 * span * SPARE * rows / row["count"])))
        for row in counts.collect()
    ]
    spark = docs.sparkSession
    kind = docs.schema["lang"].dataType.simpleString()
    wanted = spark.createDataFrame(below, f"lang {kind}, below long")
    few = known.join(F.broadcast(wanted), "lang").where("place <= below")
    first = Window.partitionBy("lang").orderBy("place")
    return (
        few.dropDuplicates(["lang", "place"])
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= rows)
        .select("lang", "text")
    )


def fit(docs: DataFrame, trainable: Column | None = None, rows: int = SAMPLE_ROWS) -> Model:
    """Statistics of ``training_sample``."""
    sample = training_sample(docs, trainable, rows)

    def count(group: pd.DataFrame) -> pd.DataFrame:
        words: Counter = Counter()
        for text in group["text"]:
            words.update(words_of(text))
        found = count_runs(words)
        return pd.DataFrame(
            {
                "lang": [group["lang"].iloc[0]],
                "runs": [b"".join(bytes([len(run)]) + run for run in found)],
                "counts": [np.fromiter(found.values(), "<i8", len(found)).tobytes()],
            }
        )

    counted = {}
    for row in (
        sample.groupBy("lang")
        .applyInPandas(count, "lang string, runs binary, counts binary")
        .toLocalIterator()
    ):
        data, at, found = bytes(row.runs), 0, Counter()
        for n in np.frombuffer(bytes(row.counts), "<i8").tolist():
            size = data[at]
            found[data[at + 1 : at + 1 + size]] = n
            at += 1 + size
        counted[row.lang] = found
    return build(counted)


def _scorer(shared) -> Scorer:
    """The worker's scorer of a broadcast model, kept from task to task."""
    model = shared.value
    key = (tuple(model.languages), len(model.runs), zlib.crc32(model.bits.tobytes()))
    return kept("langid", key, lambda: Scorer(model))


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score and bits_per_byte for each row of ``docs``.

    Null and empty texts, texts without letters, and all texts where no language was
    learned are ``und`` with score 0. Repeated rows give one result each; no rows
    give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = _scorer(shared)

        def work(texts):
            return list(zip(*map(scorer.predict, texts))) or [[], [], []]

        return work

    return map_texts(
        docs, start, "lang_pred string, score double, bits_per_byte double", id_col, text_col
    )


def drop_unidentified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in a learned language, with all their columns.

    Rows whose prediction is ``und`` go, and those whose shortest code is longer
    than ``MOST_BITS`` bits per byte. Where nothing was learned, all rows stay that
    have a letter. Repeated rows stay or go together; no rows give no rows.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def stays(scorer: Scorer, text: str) -> bool:
        if not scorer.model.languages:
            return has_letter(text)
        language, _, bits = scorer.predict(text)
        return language != UNKNOWN and bits <= MOST_BITS

    def run(batches):
        scorer = _scorer(shared)
        for part in slices(batches):
            kept = [stays(scorer, text) for text in texts_of(part.column(at))]
            yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
