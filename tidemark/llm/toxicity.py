"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself, a passage
(about ``PASSAGE`` words) the mean of its words, and a softmax over two classes
reads the passage's vector. Vectors and softmax are trained jointly in numpy by
gradient descent, so that unseen inflections and misspellings share what their
n-grams have learned. A text scores as its worst passage: a few bad words weigh
the same in a short text and in a long one. Words end at spaces and punctuation of
any script. A longer run, as in scripts that write no spaces, is cut into pieces that
are words each and overlap, so that every n-gram of it is read.

Training reads a bounded sample of labelled rows (``SampleBounds``); scoring covers
every passage of every text. For scoring, each bucket's vector is reduced to the
difference that it makes between the classes, a table of ``BUCKETS`` numbers that
is broadcast; a worker caches words.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import Memory, kept, map_texts, slices, texts_of

BUCKETS = 1 << 18
DIMENSIONS = 8
PASSAGE = 4
SHORTEST, LONGEST = 3, 6
#: Bytes of the longest run that is one word, and bytes from piece to piece of a longer one.
WORD, PIECE = 40, 12
#: Steps of rarely moved buckets are damped, so that chance does not become evidence.
DAMPING = 0.02
CACHED = 200_000


@dataclass(frozen=True)
class SampleBounds:
    """The most labelled rows of each class that training reads, and the longest text in bytes.

    Rows are chosen by a hash of their id, whatever their text, language or source.
    """

    toxic: int = 1_200
    clean: int = 2_400
    longest: int = 8_000


#: Bytes of words: letters, digits and all beyond ASCII; A-Z become small.
_TO_WORDS = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)


#: Spaces and punctuation beyond ASCII, also those of no width that part words.
_SEPARATORS = re.compile(
    "[%s\x85\u200b\u2060\ufeff]+"
    % "".join(c for c in map(chr, range(128, 1 << 16)) if unicodedata.category(c)[0] in "ZP")
)


def _pieces(run: bytes) -> list[bytes]:
    """Pieces of a long run; each n-gram of the run lies within one."""
    last = max(1, len(run) - LONGEST + 1)
    return [run[i : i + PIECE + LONGEST - 1] for i in range(0, last, PIECE)]


def words_of(text: str) -> list[bytes]:
    if not text.isascii():
        text = _SEPARATORS.sub(" ", text)
    words = text.encode().translate(_TO_WORDS).split()
    if words and max(map(len, words)) > WORD:
        words = list(chain.from_iterable(_pieces(w) if len(w) > WORD else (w,) for w in words))
    return words


def _crc_table() -> np.ndarray:
    """The table of the common 32-bit checksum, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of their n-grams of bytes, ends marked, and whose each is.

    Buckets are checksums. One pass over the bytes of all words carries the checksums
    of the n-grams that start at each byte from size to size.
    """
    marked = [b"<" + word + b">" for word in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))
    codes = np.frombuffer(b"".join(marked) + bytes(LONGEST), np.uint8)
    crc = np.full(len(owner), 0xFFFFFFFF, np.uint32)
    buckets = [np.fromiter(map(zlib.crc32, marked), np.int64, len(marked)) % BUCKETS]
    owners = [np.arange(len(marked))]
    for i in range(LONGEST):
        crc = _CRC[(crc ^ codes[i : i + len(owner)]) & 0xFF] ^ (crc >> 8)
        if i + 1 >= SHORTEST:
            inside = left > i
            buckets.append((~crc[inside]).astype(np.int64) % BUCKETS)
            owners.append(owner[inside])
    return np.concatenate(buckets), np.concatenate(owners)


def passages(n_words: int) -> np.ndarray:
    """Starts of the passages of a text, of ``PASSAGE`` to twice as many words."""
    count = max(1, n_words // PASSAGE)
    return np.arange(count) * n_words // count


@dataclass
class Model:
    """Weights of the frozen classifier: by bucket, and the bias."""

    weights: np.ndarray
    bias: float


class Scorer:
    """Scores texts; remembers the weights of words."""

    def __init__(self, model: Model, cached: int = CACHED):
        self._model, self._known = model, Memory(self._weights, cached)

    def _weights(self, words: list[bytes]) -> list[float]:
        """The mean weight of each word's n-grams."""
        buckets, owners = subwords(words)
        sums = np.bincount(owners, self._model.weights[buckets], len(words))
        return (sums / np.bincount(owners, minlength=len(words))).tolist()

    def margin(self, text: str) -> float:
        return self.margins([text])[0]

    def margins(self, texts: list[str]) -> list[float]:
        """Log odds of the worst passage of each text."""
        parted = [words_of(text) for text in texts]
        self._known.fill(set(chain.from_iterable(parted)))
        return [self._worst(words) for words in parted]

    def _worst(self, words: list[bytes]) -> float:
        n, margin = len(words), self._model.bias
        if n:
            weights = np.fromiter(map(self._known.__getitem__, words), np.float64, n)
            starts = passages(n)
            sizes = np.diff(starts, append=n)
            margin += float((np.add.reduceat(weights, starts) / sizes).max())
        return margin

    def scores(self, texts: list[str]) -> list[float]:
        margins = np.clip(self.margins(texts), -30, 30)
        return (1 / (1 + np.exp(-margins))).tolist()


def _scorer(shared) -> Scorer:
    """The worker's scorer of a broadcast model, kept from task to task."""
    model = shared.value
    key = (zlib.crc32(model.weights.tobytes()), model.bias)
    return kept("toxicity", key, lambda: Scorer(model))


class _Training:
    """Joint descent over bucket vectors and the softmax, by mini-batches of bags.

    A bag's logits depend on its vector only through the difference of the classes'
    weights, ``direction``, so one number per bucket carries a step forwards and
    one carries it back; the steps on vectors and softmax are exact.
    """

    def __init__(self, texts: list[list[bytes]], labels: np.ndarray, seed: int = 7):
        self.rng = rng = np.random.default_rng(seed)
        number: dict[bytes, int] = {}
        coded = [np.array([number.setdefault(w, len(number)) for w in t], np.int64) for t in texts]
        self.labels = labels
        flat, owners = subwords(list(number))
        order = np.argsort(owners, kind="stable")
        flat, sizes = flat[order], np.bincount(owners, minlength=len(number))
        grams = np.split(flat, np.cumsum(sizes)[:-1])
        self.gram_starts = np.cumsum([0, *sizes[:-1]])
        self.buckets, self.flat = np.unique(flat, return_inverse=True)
        self.word_of_gram = np.repeat(np.arange(len(sizes)), sizes)
        self.scale = 1.0 / sizes
        # A bucket must occur in some texts of the sample to be worth a vector.
        seen = np.zeros(BUCKETS, np.int64)
        for words in coded:
            seen[np.unique(np.concatenate([grams[w] for w in np.unique(words)]))] += 1
        self.active = seen[self.buckets] >= max(2, min(8, len(texts) // 150))
        self.vectors = rng.normal(0, 0.01, (len(self.buckets), DIMENSIONS)) * self.active[:, None]
        self.softmax = rng.normal(0, 0.5, (DIMENSIONS, 2))
        self.bias = 0.0
        self.moved = np.zeros(len(self.buckets))
        starts = [passages(len(words)) for words in coded]
        first = np.cumsum([0, *map(len, coded[:-1])])
        self.tokens = np.concatenate(coded)
        self.text_starts, self.text_sizes = first, np.array([len(x) for x in coded])
        self.starts = np.concatenate([f + s for f, s in zip(first, starts)])
        self.sizes = np.diff(self.starts, append=len(self.tokens))
        self.text_of = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        self.first_passage = np.cumsum([0, *[len(s) for s in starts[:-1]]])

    def _by_word(self) -> np.ndarray:
        direction = self.softmax[:, 1] - self.softmax[:, 0]
        by_bucket = self.vectors @ direction
        return np.add.reduceat(by_bucket[self.flat], self.gram_starts) * self.scale

    def margins(self) -> np.ndarray:
        """Of every passage."""
        sums = np.add.reduceat(self._by_word()[self.tokens], self.starts)
        return sums / self.sizes + self.bias

    def step(self, starts: np.ndarray, sizes: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step on a batch of bags of tokens; each class weighs one half."""
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        words = self.tokens[at]
        margin = np.add.reduceat(self._by_word()[words], ends - sizes) / sizes + self.bias
        toxic = max(1, target.sum())
        weight = np.where(target == 1, 0.5 / toxic, 0.5 / max(1, len(target) - toxic))
        wrong = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) * weight
        to_words = np.bincount(words, np.repeat(wrong / sizes, sizes), len(self.scale)) * self.scale
        to_bucket = np.bincount(self.flat, to_words[self.word_of_gram], len(self.buckets))
        to_bucket *= self.active
        direction = self.softmax[:, 1] - self.softmax[:, 0]
        to_direction = to_bucket @ self.vectors
        self.moved += to_bucket**2
        size = np.sqrt(self.moved)
        shrunk = rate * to_bucket / (size + DAMPING * size.max() + 1e-12)
        self.vectors -= shrunk[:, None] * direction
        half = 0.05 * rate * to_direction / (np.abs(to_direction).max() + 1e-12)
        self.softmax += np.stack([half, -half], 1)
        self.bias -= rate * wrong.sum()

    def _epoch(self, bags, target: np.ndarray, batch: int, rate: float) -> None:
        starts, sizes = bags
        order = self.rng.permutation(len(starts))
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            self.step(starts[some], sizes[some], target[some], rate)

    def run(self, epochs: int = 4, rounds: int = 6) -> Model:
        """Whole texts first, then the passages that decide each text's score."""
        for _ in range(epochs):
            self._epoch((self.text_starts, self.text_sizes), self.labels, 64, 2.0)
        toxic = self.labels[self.text_of] == 1
        for _ in range(rounds):
            margins = self.margins()
            worst = np.maximum.reduceat(margins, self.first_passage)[self.text_of]
            drawn = self.rng.random(len(margins)) < 0.02
            picked = (margins >= worst) | (~toxic & drawn)
            self._epoch(
                (self.starts[picked], self.sizes[picked]), toxic[picked].astype(int), 256, 2.0
            )
        weights = np.zeros(BUCKETS, np.float32)
        weights[self.buckets] = self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])
        return Model(weights, float(self.bias))


def settle(model: Model, texts: list[str], labels: list[int]) -> Model:
    """``model`` with the bias that errs least on these texts, in the middle of that range."""
    scorer = Scorer(model)
    worst = np.array(scorer.margins(texts))
    order = np.argsort(worst)
    worst, toxic = worst[order], np.array(labels)[order] == 1
    errors = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate(
        [np.cumsum(~toxic[::-1])[::-1], [0]]
    )
    best = np.flatnonzero(errors == errors.min())
    at = best[len(best) // 2]
    low = worst[at - 1] if at else worst[0] - 1
    high = worst[at] if at < len(worst) else worst[-1] + 1
    return Model(model.weights, model.bias - float(low + high) / 2)


def train(texts: list[str], labels: list[int]) -> Model:
    """A model for texts labelled 0 or 1. Without both classes it scores the one there is.

    Every fourth text, in the order given, only settles the bias.
    """
    rows = [(text, words, label) for text, label in zip(texts, labels) if (words := words_of(text))]
    kinds = {label for *_, label in rows}
    if len(kinds) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 4.0 if kinds == {1} else -4.0)
    kept, held = [row for i, row in enumerate(rows) if i % 4], rows[::4]
    if min(sum(row[2] == kind for row in part) for kind in kinds for part in (kept, held)) < 10:
        kept = held = rows
    model = _Training([words for _, words, _ in kept], np.array([row[2] for row in kept])).run()
    return settle(model, [text for text, _, _ in held], [label for *_, label in held])


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    trainable: Column | None = None,
    bounds: SampleBounds = SampleBounds(),
) -> DataFrame:
    """text and toxic of a bounded number of labelled rows of ``docs``.

    Of a document with several labels, the toxic one counts. The chosen ids are
    bounded, so that they may be broadcast.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    if trainable is not None:
        usable = usable.where(trainable)
    known = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    by_hash = F.xxhash64("doc_id")
    chosen = (
        known.where("toxic = 1").orderBy(by_hash, "doc_id").limit(bounds.toxic)
    ).unionAll(known.where("toxic = 0").orderBy(by_hash, "doc_id").limit(bounds.clean))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(
        F.octet_length("text") <= bounds.longest
    )
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    trainable: Column | None = None,
    bounds: SampleBounds = SampleBounds(),
) -> Model:
    """Train on the sample, in one task; an id that repeats counts once for each different text.

    Only the finished weights come to the driver.
    """
    most = bounds.toxic + bounds.clean
    sample = training_sample(docs, labels, trainable, bounds).dropDuplicates(["doc_id", "text"])
    by_hash = F.xxhash64("doc_id", "text")
    sample = sample.select("text", "toxic", by_hash.alias("place")).orderBy("place").limit(most)

    def run(batches):
        texts, labelled = [], []
        for batch in batches:
            texts += texts_of(batch.column(0))
            labelled += batch.column(1).to_pylist()
        model = train(texts, labelled)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])],
            ["weights", "bias"],
        )

    row = sample.repartition(1).mapInArrow(run, "weights binary, bias double").first()
    if row is None:  # no task had a row
        return train([], [])
    return Model(np.frombuffer(bytes(row.weights), np.float32), row.bias)


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (0 or 1) for each row of ``docs``.

    Null and empty texts, and texts without words, score as the bias alone.
    Repeated rows give one result each; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = _scorer(shared)

        def work(texts):
            scores = scorer.scores(texts)
            yield scores
            yield [int(score >= 0.5) for score in scores]

        return work

    return map_texts(docs, start, "score double, predicted int", id_col, text_col)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    Null and empty texts score as the bias alone; repeated rows stay or go together;
    no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        scorer = _scorer(shared)
        for part in slices(batches):
            clean = [score < 0.5 for score in scorer.scores(texts_of(part.column(at)))]
            yield part.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
