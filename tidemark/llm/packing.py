"""Best-fit-decreasing packing of tokenised documents into sequences.

Texts are tokenised map-side to the lengths and checksums of their pieces, which
are written once. Pieces are dealt to shards of bounded size by a salted hash, and
each shard packs its own: longest first, each piece into the open sequence with
the least room that still holds it. A segment tree over the remaining capacities
finds that sequence in logarithmic time. Shards share nothing, so packing takes as
long at any input size; what it costs is at most about one part-filled sequence
for each ``SHARD_PIECES`` pieces.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import byte_letters
from tidemark.llm.rows import slices, texts_of
from tidemark.workspace import new_folder

CAPACITY = 4096
END_ID = 1
#: Pieces packed together by one task: bounds its memory and time.
SHARD_PIECES = 60_000
#: Entries of each of a worker's two caches.
CACHED = 200_000

#: The tokenizer's own pattern, which its file is checked against, and the same
#: for texts of the first Unicode blocks, in which nothing is above U+024F.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_PRE_TOKENS = re.compile(
    f"'(?:[stmd]|re|ve|ll)|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
)
_OTHER_TEXT = re.compile("[^\x01-\u024f]|<\\||\u0130")
_END_OF_WORD = "</w>"
#: Stands for the end of a word where bytes are joined by rank.
_END = "\0"


def ranked(vocabulary: dict[str, int]):
    """The vocabulary for the library that joins bytes by rank, words ending with a null byte.

    It numbers merges in the order in which they apply, and the ends of words before
    all other merges.
    """
    import tiktoken

    letters = byte_letters()
    ranks = {}
    for token, i in vocabulary.items():
        if not token.startswith("<|"):
            word = token.removesuffix(_END_OF_WORD)
            end = b"" if word == token else _END.encode()
            ranks[bytes(letters[x] for x in word) + end] = i
    return tiktoken.Encoding(
        "words", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={}
    )


class WordTokenizer:
    """Ids of whole texts, pre-token by pre-token from a cache.

    White space separates pre-tokens and is dropped, so the ids of a text are those
    of its pre-tokens. A pre-token's last id ends a word, so many unknown ones are
    encoded by one call and told apart. A text with characters above U+024F, a null
    character, a special token, or a letter whose lower case is longer, is cut at
    spaces only, and the library encodes its words as they stand.
    """

    def __init__(self, path: str, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        split = stated["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if split != _PATTERN or stated["model"]["end_of_word_suffix"] != _END_OF_WORD:
            raise ValueError(f"{path} is not a tokenizer of this kind")
        if any("<|" not in token["content"] for token in stated["added_tokens"]):
            raise ValueError(f"{path} has special tokens of another form")
        vocabulary = stated["model"]["vocab"]
        self._ends = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in vocabulary.items():
            self._ends[i] = token.endswith(_END_OF_WORD)
        self._ranked = ranked(vocabulary)
        self._cached = cached
        self._plain: dict[str, bytes] = {}
        self._other: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, units: set[str]) -> None:
        """Put the ids of pre-tokens into the cache, which is bounded."""
        if len(self._plain) + len(units) > self._cached:
            self._plain.clear()
        new = list(units.difference(self._plain))
        ids = np.array(self._ranked.encode_ordinary(_END.join(new) + _END), "<u4")
        ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
        data = ids.tobytes()
        self._plain.update(
            (unit, data[i:j]) for unit, i, j in zip(new, [0, *ends], ends, strict=False)
        )

    def _by_words(self, text: str) -> bytes:
        out = []
        for word in text.replace("\n", " ").split(" "):
            found = self._other.get(word)
            if found is None:
                if len(self._other) >= self._cached:
                    self._other.clear()
                found = self._other[word] = self._library(word)
            out.append(found)
        return b"".join(out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out = []
        for text in texts:
            if _OTHER_TEXT.search(text):
                out.append(self._by_words(text))
                continue
            units = _PRE_TOKENS.findall(text.lower())
            try:
                ids = b"".join(map(self._plain.__getitem__, units))
            except KeyError:
                self._learn(set(units))
                ids = b"".join(map(self._plain.__getitem__, units))
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenise(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every row.

    A row's ids end with ``end_id``; a null or empty text has that id alone. Only
    documents longer than ``capacity`` are cut.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        held = tokenizer(path)
        for part in slices(batches, 128):
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(held.encode_all(texts_of(part.column(1)))):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    rows.append(row)
                    pieces.append(n)
                    starts.append(at // 4)
                    lengths.append(len(cut) // 4)
                    sums.append(zlib.crc32(cut))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                schema.names,
            )

    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return read.mapInArrow(run, schema)


class OpenSequences:
    """Open sequences by remaining capacity, under a segment tree.

    A leaf holds the sequences with exactly that much room, an inner node whether
    any leaf below it holds one.
    """

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._counts = [0] * (2 * self._leaves)
        self._open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self._leaves
        while at:
            self._counts[at] += by
            at >>= 1

    def put(self, room: int, sequence: int) -> None:
        self._open[room].append(sequence)
        self._add(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take the open sequence with the least room of at least ``length``."""
        counts, at = self._counts, length + self._leaves
        if not counts[at]:
            while at > 1 and (at & 1 or not counts[at ^ 1]):
                at >>= 1
            if at <= 1:
                return None
            at ^= 1
            while at < self._leaves:
                at = 2 * at if counts[2 * at] else 2 * at + 1
        room = at - self._leaves
        self._add(room, -1)
        return room, self._open[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each length, none above ``capacity``."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    still, made = OpenSequences(capacity), 0
    for i in order:
        length = lengths[i]
        found = still.tightest(length)
        if found is None:
            room, number = capacity, made
            made += 1
        else:
            room, number = found
        sequence[i], offset[i] = number, capacity - room
        if room > length:
            still.put(room - length, number)
    return sequence, offset


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """``pieces`` with sequence_id and offset. Needs stored rows, since it reads them twice.

    A piece's shard follows from its place in the stored table, so rows that repeat
    an id are dealt like any others. A sequence's id is its shard's number times
    2^32 plus its number there.
    """
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn(
        "shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    )
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], kind="stable")
        sequence, offset = best_fit_decreasing(rows["length"].tolist(), capacity)
        rows["sequence_id"] = (int(key[0]) << 32) + np.array(sequence, np.int64)
        rows["offset"] = np.array(offset, np.int64)
        return rows[schema.names]

    return dealt.groupBy("shard").applyInPandas(pack, schema)


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Every piece of every row of ``docs`` with its sequence and offset.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and
    empty texts are one piece of one id. No rows give no rows.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "pieces")
    tokenise(docs, path, id_col, text_col, capacity, end_id).write.parquet(folder)
    return pack_pieces(spark.read.parquet(folder), capacity, shard_pieces)
