"""Vector bin packing of training examples by the dot-product heuristic.

An example demands some of each resource: tokens, segments and loss-bearing tokens.
A sequence is filled while anything fits: of the examples that fit in every resource
it takes the one whose demand has the largest dot product with what is left of the
sequence, each resource weighted by how scarce it is. So a sequence that has many
tokens but few segments left takes few long examples.

With ``cut``, examples may be cut. A sequence that nothing fits any more is then
filled by the front of the example that the heuristic likes best, whose rest goes
back among the others; one that has no segment left, or that ends a shard, is cut
down to a power of two, where no padding is due. Instruction data are not cut.

Examples are dealt to shards of bounded size, which share nothing, so packing takes
as long at any input size. Pieces that fill a sequence alone are never shuffled.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.byte_words import byte_words
from tidemark.llm.rows import slices, texts_of
from tidemark.workspace import new_folder

END_ID = 0
#: Examples packed together by one task: bounds its memory and time.
SHARD_EXAMPLES = 20_000


@dataclass(frozen=True)
class Limits:
    """The most tokens, segments and loss-bearing tokens of a sequence."""

    tokens: int = 1024
    segments: int = 256
    loss: int = 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], np.int64)


@dataclass
class Packed:
    """Pieces in order: example, its first token, length, sequence, offset."""

    example: list[int]
    start: list[int]
    length: list[int]
    sequence: list[int]
    offset: list[int]


def _power_below(n: int) -> int:
    """The largest power of two that is at most ``n``."""
    return 1 << (n.bit_length() - 1)


class Shard:
    """The examples of one shard that are not placed yet, by kind of demand.

    A kind is one vector of demand. Examples of a kind are alike to the heuristic and
    wait in one list, as (example, first token).
    """

    def __init__(self, tokens: np.ndarray, loss: np.ndarray, limits: Limits):
        self.limits = limits
        demand = np.stack([tokens, np.ones_like(tokens), loss], 1).astype(np.int64)
        if len(demand) and (demand > limits.vector()).any():
            raise ValueError("an example demands more than a sequence holds")
        kinds, kind_of = np.unique(demand, axis=0, return_inverse=True)
        self.number = {tuple(kind): i for i, kind in enumerate(kinds.tolist())}
        self.waiting: list[list[tuple[int, int]]] = [[] for _ in kinds]
        for example, kind in reversed(list(enumerate(kind_of.ravel().tolist()))):
            self.waiting[kind].append((example, 0))
        self.left = len(demand)
        #: Demand by resource and kind, as it weighs, and as it fits: a kind without
        #: examples fits nowhere.
        self.demand = kinds.T.astype(float)
        self.fitting = self.demand.copy()
        # A resource is the scarcer the more sequences its whole demand would fill.
        self.scarcity = demand.sum(0) / limits.vector().astype(float) ** 2

    def best(self, room: np.ndarray, whole: bool = True) -> int:
        """The kind to place next, or -1; without ``whole`` it may exceed the room."""
        liked = (self.scarcity * room) @ self.demand
        if whole:
            tokens, segments, loss = self.fitting
            liked *= (tokens <= room[0]) & (segments <= room[1]) & (loss <= room[2])
        else:
            liked *= np.isfinite(self.fitting[0])
        kind = int(liked.argmax()) if len(liked) else -1
        return kind if kind >= 0 and liked[kind] > 0 else -1

    def take(self, kind: int) -> tuple[int, int, np.ndarray]:
        """One example of a kind: its number, first token and demand."""
        waiting = self.waiting[kind]
        example, start = waiting.pop()
        self.left -= 1
        if not waiting:
            self.fitting[:, kind] = np.inf
        return example, start, self.demand[:, kind].astype(np.int64)

    def give(self, example: int, start: int, tokens: int, loss: int) -> None:
        """Put back the rest of an example that was cut."""
        demand = (tokens, 1, loss)
        kind = self.number.get(demand)
        if kind is None:
            kind = self.number[demand] = len(self.waiting)
            self.waiting.append([])
            column = np.array(demand, float)[:, None]
            self.demand = np.hstack([self.demand, column])
            self.fitting = np.hstack([self.fitting, column])
        self.fitting[:, kind] = demand
        self.left += 1
        self.waiting[kind].append((example, start))


def pack_shard(
    tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool = False
) -> Packed:
    """Place every example, none above the limits; with ``cut`` their tokens may part.

    All tokens of an example that is cut must bear loss alike, so that a piece
    demands as much loss as tokens, at most.
    """
    shard, done = Shard(tokens, loss, limits), Packed([], [], [], [], [])
    sequence = 0

    def place(example: int, start: int, length: int, used: int) -> None:
        done.example.append(example)
        done.start.append(start)
        done.length.append(length)
        done.sequence.append(sequence)
        done.offset.append(used)

    while shard.left:
        room, held = limits.vector(), []
        while room[1] and (kind := shard.best(room)) >= 0:
            held.append(shard.take(kind))
            room -= held[-1][2]
        if cut and room[0]:
            held = _closed(shard, held, room)
        used = 0
        for example, start, demand in held:
            place(example, start, int(demand[0]), used)
            used += int(demand[0])
        sequence += 1
    return done


def _closed(shard: Shard, held: list, room: np.ndarray) -> list:
    """The segments of a sequence that ends without padding, by one cut at most."""
    used = shard.limits.tokens - int(room[0])
    kind = shard.best(room, whole=False) if room[1] and room[2] else -1
    if kind >= 0 and shard.demand[0, kind] > room[0] <= room[2]:
        # Something is left but too long: its front fills the sequence.
        example, start, demand = shard.take(kind)
        part = np.minimum(demand, [room[0], 1, room[0]])
        shard.give(example, start + int(part[0]), *_rest(demand, part))
        return [*held, (example, start, part)]
    # Nothing is left to add, or no segment: cut back to a power of two.
    goal = _power_below(used)
    while used > goal:
        example, start, demand = held.pop()
        keep = max(0, int(demand[0]) - (used - goal))
        used -= int(demand[0]) - keep
        part = np.array([keep, 1, min(int(demand[2]), keep)])
        shard.give(example, start + keep, *_rest(demand, part))
        if keep:
            held.append((example, start, part))
    return held


def _rest(demand: np.ndarray, part: np.ndarray) -> tuple[int, int]:
    return int(demand[0] - part[0]), int(demand[2] - part[2])


def dealt(examples: DataFrame, shard_examples: int) -> DataFrame:
    """Stored ``examples`` with a shard by their place, so repeated ids are no matter."""
    shards = max(1, -(-examples.count() // shard_examples))
    return examples.withColumn(
        "shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    )


def _sequences(key: tuple, found: Packed) -> list[pa.Array]:
    """sequence_id and offset of placed pieces; the key is their shard."""
    numbers = (key[0].as_py() << 32) + np.array(found.sequence, np.int64)
    return [pa.array(numbers, pa.int64()), pa.array(found.offset, pa.int64())]


def pack_examples(
    examples: DataFrame,
    tokens: Column,
    loss: Column,
    limits: Limits = Limits(),
    shard_examples: int = SHARD_EXAMPLES,
) -> DataFrame:
    """Whole examples with sequence_id and offset, none cut: for instruction data.

    ``tokens`` and ``loss`` are the demands of a row, which is one segment. The
    columns of ``examples`` stay, whatever their names; sequence_id is a shard's
    number times 2^32 plus the sequence's number there. Rows that demand more than a
    sequence holds fail the job. Null demands count as zero. No rows give no rows.
    """
    taken = {*examples.columns, "shard"}
    if taken & {"sequence_id", "offset"} or "shard" in examples.columns:
        raise ValueError("sequence_id, offset and shard are reserved column names")
    folder = new_folder(examples.sparkSession, "examples")
    none = F.lit(0).cast("long")
    demand = [F.coalesce(c.cast("long"), none) for c in (tokens, loss)]
    row = F.struct(*[F.col(f"`{name}`") for name in examples.columns]).alias("row")
    examples.select(row, demand[0].alias("tokens"), demand[1].alias("loss")).write.parquet(folder)
    stored = examples.sparkSession.read.parquet(folder)
    place = F.monotonically_increasing_id().alias("place")
    numbered = dealt(stored.select(place, "tokens", "loss"), shard_examples)

    schema = "place long, sequence_id long, offset long"

    def pack(key, rows):
        rows = rows.sort_by("place")
        demand = [rows.column(name).to_numpy() for name in ("tokens", "loss")]
        found = pack_shard(*demand, limits)
        places = rows.column("place").take(pa.array(found.example, pa.int64()))
        return pa.table([places, *_sequences(key, found)], ["place", "sequence_id", "offset"])

    placed = numbered.groupBy("shard").applyInArrow(pack, schema)
    return (
        stored.select("row", place)
        .join(placed, "place")
        .select("row.*", "sequence_id", "offset")
    )


def conversation_examples(
    conversations: DataFrame, path: str, end_id: int = END_ID
) -> DataFrame:
    """conv_id, tokens and loss of each conversation, as one example.

    A turn's tokens are its text's and ``end_id``; those of the assistant bear loss.
    Null texts have the end alone. Repeated turns count each.
    """

    def run(batches):
        held = byte_words(path)
        for part in slices(batches):
            found = [len(held.encode(text)) // 4 + 1 for text in texts_of(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found, pa.int64()), part.column(2)],
                ["conv_id", "tokens", "bears"],
            )

    bears = F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("bears")
    text = F.col("text").cast("string").alias("text")
    kind = conversations.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("tokens", T.LongType()),
            T.StructField("bears", T.BooleanType()),
        ]
    )
    turns = conversations.select("conv_id", text, bears).mapInArrow(run, schema)
    return turns.groupBy("conv_id").agg(
        F.sum("tokens").alias("tokens"),
        F.sum(F.when(F.col("bears"), F.col("tokens")).otherwise(0)).alias("loss"),
    )


_PIECE = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"


def tokenise(
    docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int, end_id: int
) -> DataFrame:
    """The pieces of ``capacity`` ids of every row, and the rest as one more piece with its ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = T.StructType.fromDDL(_PIECE.format(kind=kind) + ", ids binary")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        held = byte_words(path)
        for part in slices(batches, 128):
            rows, starts, lengths, sums, totals, kept = [], [], [], [], [], []
            for row, text in enumerate(texts_of(part.column(1))):
                ids = held.encode(text) + end
                for at in range(0, len(ids), 4 * capacity):
                    cut = ids[at : at + 4 * capacity]
                    full = len(cut) == 4 * capacity
                    rows.append(row)
                    starts.append(at // 4)
                    lengths.append(len(cut) // 4)
                    sums.append(zlib.crc32(cut) if full else None)
                    totals.append(len(ids) // 4)
                    kept.append(None if full else cut)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)),
                    pa.array(kept, pa.binary()),
                ],
                schema.names,
            )

    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return read.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limits: Limits = Limits(),
    end_id: int = END_ID,
    shard_examples: int = SHARD_EXAMPLES,
) -> DataFrame:
    """Every piece of every row of ``docs`` with its sequence and offset, cut where it helps.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Every
    id bears loss. A sequence is full or ends at a power of two, so none is padded.
    Null and empty texts are their end alone; rows that repeat are packed each; no
    rows give no rows. The ids of a row's last, partial piece travel to its shard,
    which cuts them and takes the checksums. Pieces that fill a sequence alone get
    negative sequence ids and do not travel; others get their shard's number times
    2^32 plus their sequence's number there.
    """
    if limits.loss < limits.tokens:
        raise ValueError("documents bear loss on every id, so loss may not be below tokens")
    spark = docs.sparkSession
    folder = new_folder(spark, "examples")
    tokenise(docs, path, id_col, text_col, limits.tokens, end_id).write.parquet(folder)
    stored = spark.read.parquet(folder)
    full = stored.where("ids IS NULL").select(
        *stored.columns[:5],
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    kind = stored.schema["doc_id"].dataType.simpleString()
    schema = T.StructType.fromDDL(_PIECE.format(kind=kind) + ", sequence_id long, offset long")

    def pack(key, rows):
        rows = rows.combine_chunks()
        lengths = rows.column("length").to_numpy()
        found = pack_shard(lengths, lengths, limits, cut=True)
        order = pa.array(found.example, pa.int64())
        ids, sums = rows.column("ids").to_pylist(), []
        for example, start, length in zip(found.example, found.start, found.length):
            sums.append(zlib.crc32(ids[example][4 * start : 4 * (start + length)]))
        starts = rows.column("start").take(order).to_numpy() + np.array(found.start, np.int64)
        columns = [
            rows.column("doc_id").take(order),
            pa.array(starts, pa.int64()),
            pa.array(found.length, pa.int64()),
            pa.array(sums, pa.int64()),
            rows.column("doc_tokens").take(order),
            *_sequences(key, found),
        ]
        return pa.table(columns, schema.names)

    rest = dealt(stored.where("ids IS NOT NULL").drop("ids_crc32"), shard_examples)
    return full.unionByName(rest.groupBy("shard").applyInArrow(pack, schema))
