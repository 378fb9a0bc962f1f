"""Near duplicates by MinHash, with sequential Bayesian verification.

Texts with the same set of shingles are one class; from there on, only classes
are compared. A class's signature of ``HASHES`` minima is cut into bands, and
classes that agree in a band are candidates. A candidate pair's signatures are
compared batch by batch: after each, the posterior probability that the true
similarity reaches the threshold decides whether the pair is dropped (below
``MISS``). The survivors' full shingle sets are compared exactly.

Candidates of a band are not all paired. First each class is paired with the most
central one in its band, and the links found are joined to components. Only where
a band still holds several components is there more to compare: the classes outside
the band's largest component with all others there. If that component has few
classes in the band, these are pairs like the first. If it has many, the outsiders
and the component meet in blocks of bounded size, one task each, which test all
their pairs by the same steps and return only links; no pair of such a group is
ever a row. So a group of copies costs a few rows per member, and no link between
components goes untested.

Shingles are compared as 64-bit hashes of their words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.rows import slices, texts_of
from tidemark.workspace import new_folder

BANDS, BAND_ROWS = 21, 6
HASHES = 128
#: Minima compared between two looks at the posterior.
BATCH = 16
#: A pair is dropped if its similarity reaches the threshold with less probability than this.
MISS = 0.0005
#: Classes of one band from which on those of several components meet in blocks.
CROWD = 16
#: Classes on each side of a block.
BLOCK = 256
#: Most ids that are broadcast to find their texts (16 MB); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Shingles hashed at once; bounds memory for very long texts.
CHUNK = 2_048

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_101)
    factors = draw.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``size`` words, or of the one run of fewer."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and white space of ASCII
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) <= size:
        whole = np.uint64(len(words))
        for x in hashed:
            whole = _mixed(np.array([whole]) * _MIX + x)[0]
        return np.array([whole])
    found = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        found = _mixed(found * _MIX + hashed[i : len(hashed) - size + 1 + i])
    return np.unique(found)


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of the hashed set under each hash function, to 32 bits."""
    factors, shifts = _multipliers()
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for i in range(0, len(found), CHUNK):
        some = found[i : i + CHUNK, None] * factors + shifts
        np.minimum(least, (some ^ (some >> np.uint64(32))).min(0), out=least)
    return _mixed(least).astype(np.uint32)


def least_matches(threshold: float, miss: float = MISS) -> np.ndarray:
    """Fewest equal minima among the first ``BATCH``, 2 x ``BATCH``, ... that keep a pair.

    The prior of the similarity is even on 0 to 1, so the posterior after m equal of
    n minima is a beta distribution; its tail is summed on a fine grid.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    least = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
        density = np.exp(logs - logs.max(1, keepdims=True))
        tail = density[:, grid >= threshold].sum(1) / density.sum(1)
        least.append(int(np.argmax(tail >= miss)))
    return np.array(least)


def surviving(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Rows whose two signatures are alike enough at every look."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    for i, fewest in enumerate(least):
        some = slice(i * BATCH, (i + 1) * BATCH)
        equal[alive] += (left[alive, some] == right[alive, some]).sum(1)
        alive = alive[equal[alive] >= fewest]
    return alive


def _stored(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def text_key(text: Column) -> Column:
    """Tells the texts of rows that repeat an id apart."""
    return F.xxhash64(text).alias("text_key")


def sign(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (of the whole set) and signature of each row.

    Without a word, key and signature are null.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("text_key", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("signature", T.BinaryType()),
        ]
    )

    def run(batches):
        for part in slices(batches):
            found = [shingles(text, size) for text in texts_of(part.column(1))]
            keys = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in found]
            signed = [signature(x).tobytes() if len(x) else None for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(signed, pa.binary()),
                ],
                schema.names,
            )

    text = F.col(text_col).cast("string")
    read = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), text_key(text))
    return read.mapInArrow(run, schema)


def band_keys(classes: DataFrame) -> DataFrame:
    """(class_id, band) for each band of each class; a band's key names its place too."""

    def run(batches):
        width = 4 * BAND_ROWS
        for part in slices(batches, 2_048):
            keys = []
            for data in part.column(1).to_pylist():
                for i in range(BANDS):
                    keys.append(xxhash.xxh3_64_intdigest(data[i * width : (i + 1) * width], seed=i))
            rows = pa.array(np.repeat(np.arange(part.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), pa.array(np.array(keys, np.uint64).view(np.int64))],
                ["class_id", "band"],
            )

    kind = classes.schema["class_id"].dataType
    schema = T.StructType([T.StructField("class_id", kind), T.StructField("band", T.LongType())])
    return classes.select("class_id", "signature").mapInArrow(run, schema)


def likely(pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that sequential Bayesian verification does not drop."""
    least = least_matches(threshold)

    def run(batches):
        for part in slices(batches, 4_096):
            left, right = (
                np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint32).reshape(-1, HASHES)
                for i in (2, 3)
            )
            alive = pa.array(surviving(left, right, least))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(alive), part.column(1).take(alive)], ["a", "b"]
            )

    both = pairs.join(
        signed.select(F.col("class_id").alias("a"), F.col("signature").alias("left")), "a"
    ).join(signed.select(F.col("class_id").alias("b"), F.col("signature").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(run, pairs.select("a", "b").schema)


def sets_of(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, found): full sets of the documents named by ``ids``; equal rows give equal sets."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema["doc_id"].dataType),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("found", T.BinaryType()),
        ]
    )

    def run(batches):
        for part in slices(batches):
            sets = [shingles(text, size).tobytes() for text in texts_of(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()),
                    pa.array(sets, pa.binary()),
                ],
                schema.names,
            )

    wanted = ids.select(F.col("id").alias("doc_id"))
    if ids.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    chosen = docs.join(wanted, "doc_id", "left_semi")
    return chosen.select("doc_id", "text").mapInArrow(run, schema)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets share at least ``percent`` in 100 of their union."""

    def run(batches):
        for part in slices(batches, 512):
            linked = []
            for left, right in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"]
            )

    both = pairs.join(
        sets.select(F.col("id").alias("a"), F.col("found").alias("left")), "a"
    ).join(sets.select(F.col("id").alias("b"), F.col("found").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(run, pairs.select("a", "b").schema)


def star_pairs(bands: DataFrame) -> DataFrame:
    """Each class with the most central one of each of its bands.

    A class is the more central the more others share its bands, all bands counted:
    the text that a group was copied from is closer to its copies than they are to
    each other. Of equals the smallest id leads.
    """
    sizes = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = bands.join(sizes, "band")
    weight = shared.groupBy("class_id").agg(F.sum("n").alias("weight"))
    weighed = shared.select("band", "class_id").join(weight, "class_id")
    leaders = weighed.groupBy("band").agg(
        F.max_by("class_id", F.struct("weight", -F.col("class_id"))).alias("leader")
    )
    joined = weighed.join(leaders, "band").where("class_id <> leader")
    return joined.select(
        F.least("class_id", "leader").alias("a"), F.greatest("class_id", "leader").alias("b")
    ).distinct()


def open_bands(bands: DataFrame, found: DataFrame) -> DataFrame:
    """(band, class_id, component_id, largest, n) of bands that hold several components.

    ``n`` counts the classes of the band; ``largest`` is its component of most classes.
    """
    placed = bands.join(
        found.withColumnRenamed("id", "class_id"), "class_id", "left"
    ).withColumn("component_id", F.coalesce("component_id", "class_id"))
    held = placed.groupBy("band", "component_id").agg(F.count("*").alias("n"))
    largest = held.groupBy("band").agg(
        F.max(F.struct("n", "component_id")).alias("first"),
        F.count("*").alias("held"),
        F.sum("n").alias("n"),
    )
    several = largest.where("held > 1").select(
        "band", F.col("first.component_id").alias("largest"), "n"
    )
    return placed.join(several, "band")


def open_pairs(several: DataFrame) -> DataFrame:
    """Pairs of different components in one band, but for two of its largest component."""
    outside = several.where("component_id <> largest").select(
        "band", F.col("class_id").alias("x"), F.col("component_id").alias("of_x")
    )
    every = several.select(
        "band", F.col("class_id").alias("y"), F.col("component_id").alias("of_y"), "largest"
    )
    crossed = outside.join(every, "band").where(
        "of_x <> of_y and (of_y = largest or x < y)"
    )
    return crossed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def block_links(
    left: list[tuple[int, bytes]], right: list[tuple[int, int, bytes]], percent: int, least
) -> list[tuple[int, int]]:
    """Links from (id, set) rows to (id, component, set) rows, one to each component."""
    ids = np.array([row[0] for row in right])
    component = np.array([row[1] for row in right])
    sets = [np.frombuffer(row[2], np.uint64) for row in right]
    sizes = np.array([len(x) for x in sets])
    signed = np.stack([signature(x) for x in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    links = []
    for own, data in left:
        x = np.frombuffer(data, np.uint64)
        mine = np.broadcast_to(signature(x), signed.shape)
        alive = surviving(mine, signed, least)
        if not len(alive):
            continue
        low, high = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
        many = high - low
        at = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        shared = np.bincount(owner[at], minlength=len(sets))
        near = 100 * shared >= percent * (len(x) + sizes - shared)
        linked = alive[near[alive] & (ids[alive] != own)]
        for c in np.unique(component[linked]).tolist():
            links.append((own, int(ids[linked][component[linked] == c].min())))
    return links


def crowd_links(crowded: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) of outsiders with the large components of their bands, and with each other."""
    outside = crowded.where("component_id <> largest").select("largest", "class_id", "component_id")
    every = _stored(crowded.select("largest", "class_id", "component_id").distinct(), "crowds")
    outside = _stored(outside.distinct(), "outsiders")

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        count = F.ceil(F.count("*") / F.lit(BLOCK)).cast("int")
        return rows.groupBy("largest").agg(count.alias(name))

    counts = blocks(outside, "lefts").join(blocks(every, "rights"), "largest")
    ids = every.select(F.col("class_id").alias("id")).distinct()
    sets = _stored(sets_of(docs, ids, size).dropDuplicates(["id"]), "sets").select(
        F.col("id").alias("class_id"), "found"
    )
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = F.xxhash64("class_id")
    left = (
        outside.join(counts, "largest")
        .withColumn("i", F.pmod(place, F.col("lefts")).cast("int"))
        .withColumn("j", numbers("rights"))
        .join(sets, "class_id")
    )
    right = (
        every.join(counts, "largest")
        .withColumn("j", F.pmod(place, F.col("rights")).cast("int"))
        .withColumn("i", numbers("lefts"))
        .join(sets, "class_id")
    )
    least = least_matches(percent / 100)

    def meet(lefts: pd.DataFrame, rights: pd.DataFrame) -> pd.DataFrame:
        links = []
        if len(lefts) and len(rights):
            links = block_links(
                list(zip(lefts["class_id"], lefts["found"])),
                list(zip(rights["class_id"], rights["component_id"], rights["found"])),
                percent,
                least,
            )
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    keys = ["largest", "i", "j"]
    wanted = [*keys, "class_id", "component_id", "found"]
    left = left.select(wanted).toDF(*wanted)
    right = right.select(wanted).toDF(*wanted)
    grouped = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return grouped.applyInPandas(meet, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``.

    Documents are linked if their sets of ``size``-word shingles share at least
    ``percent`` in 100 of their union; ``component_id`` is the smallest id that links
    reach, and ``kept`` marks the document with that id. A document without a word
    (null or empty text) is linked with nothing. A row without id stands alone: its
    component is null and it is kept. Rows that repeat an id and a text give equal
    rows; with other texts under one id, each text is linked on its own. No rows give
    no rows. Ids are whole numbers.
    """
    return _placed(docs, size, percent, id_col, text_col).drop("text_key")


def _placed(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """:func:`near_duplicates` with the key of each row's text."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = _stored(sign(docs, size), "signatures")
    classed = F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()
    named = signed.where(classed)
    classes = named.groupBy("set_key").agg(
        F.min("doc_id").alias("class_id"), F.first("signature").alias("signature")
    )
    classes = _stored(classes, "classes")
    bands = _stored(band_keys(classes), "bands")

    def verified(pairs: DataFrame) -> DataFrame:
        survivors = _stored(likely(pairs, classes, percent / 100), "survivors")
        ids = survivors.select(F.col("a").alias("id")).union(survivors.select("b")).distinct()
        sets = sets_of(docs, ids, size).join(
            classes.select(F.col("class_id").alias("id"), "set_key"), ["id", "set_key"], "left_semi"
        )
        sets = _stored(sets.dropDuplicates(["id", "set_key"]), "sets")
        return _stored(confirmed(survivors, sets, percent), "confirmed")

    stars = _stored(star_pairs(bands), "stars")
    links = verified(stars)
    found = components(links)
    several = _stored(open_bands(bands, found), "open")
    rest = open_pairs(several.where(F.col("n") < CROWD)).join(stars, ["a", "b"], "left_anti")
    more = verified(_stored(rest, "pairs"))
    crowds = _stored(
        crowd_links(several.where(F.col("n") >= CROWD), docs, size, percent), "crowd-links"
    )
    found = components(links.union(more).union(crowds))
    placed = classes.join(found.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "set_key", F.coalesce("component_id", "class_id").alias("component_id")
    )
    # Rows without a class are many alike (null keys); they are not joined.
    joined = signed.where(classed).join(placed, "set_key", "left")
    joined = joined.unionByName(signed.where(~classed), allowMissingColumns=True).select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
            "component_id"
        ),
    )
    return joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group of near duplicates, with all columns of ``docs``.

    Rows without id all stay; of rows that repeat an id and a text, one stays. Where
    an id has several texts, each stays or goes on its own.
    """
    found = _stored(_placed(docs, size, percent, id_col, text_col), "groups")
    dropped = found.where("not kept").select(
        F.col("doc_id").alias("_dropped_id"), F.col("text_key").alias("_dropped_key")
    )
    key = text_key(F.col(f"`{text_col}`").cast("string"))
    same = (F.col(f"`{id_col}`") == F.col("_dropped_id")) & (key == F.col("_dropped_key"))
    left = docs.join(dropped.distinct(), same, "left_anti")
    named = found.where("doc_id is not null")
    rows = named.agg(F.count("*").alias("n"), F.countDistinct("doc_id", "text_key").alias("texts"))
    counts = rows.first()
    if counts.n == counts.texts:
        return left
    columns = [F.col(f"`{name}`") for name in docs.columns]
    whole = F.struct(*columns).alias("row")
    identity = F.col(f"`{id_col}`").alias("id")
    one = left.where(identity.isNotNull()).select(identity, key, whole)
    one = one.dropDuplicates(["id", "text_key"]).select("row.*")
    return one.union(left.where(identity.isNull()).select(*columns))
