"""Cross-tokenizer alignment by an associative monoid of fragments.

Two tokenizers part the same bytes. Where tokens of both end at the same byte, a
group closes: the tokens since the last such place stand for the same bytes. A byte
range of a text has the tokens that end in it. As long as both know no common end
in it, it is open; else it is an open prefix (up to its first common end), closed
groups, and an open suffix (after its last). Two neighbouring ranges compose by
joining the suffix of the one to the prefix of the other, which closes a group.
That is associative, so ranges may be worked on anywhere and reduced in a tree.

A text is parted into units where both tokenizers cut for certain, whatever stands
around; a unit is a closed fragment, which a worker remembers. Texts of more than
``RANGE`` bytes are dealt to tasks as byte ranges, each with so much text around it
that its tokens are those of the whole text, and their fragments are reduced by
``FAN_IN`` in as many rounds as the longest text needs. Ranges end anywhere, also
within tokens.

Counts of linked id pairs over the corpus are summed from what each document holds.
Frequent pairs, at most ``FREQUENT``, are broadcast; documents' other pairs, of which
each occurs rarely, meet their counts by a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.byte_words import LETTER, ByteWords, is_plain
from tidemark.llm.rows import Memory, kept, let_go, portions, slices, texts_of
from tidemark.workspace import new_folder

#: Bytes of a range, and fragments composed by one step of the tree.
RANGE, FAN_IN = 1 << 16, 8
#: Most pairs that are broadcast with their counts, 17 bytes each.
FREQUENT = 1 << 20
#: Distinct pairs that a task sums before it passes them on.
SUMMED = 1 << 20
CACHED = 100_000

SPACE = "▁"
#: What a token stands behind: the start, the group before, its neighbour, the other side.
_START, _NEXT, _MORE, _SIDE = range(4)

#: Units of plain texts. Both tokenizers cut before white space and between a Latin
#: letter and any other character, but for an apostrophe before letters.
_UNITS = re.compile(
    f"[ \n\t]*(?:[{LETTER}]+|[^{LETTER} \n\t]+(?:(?<=')[{LETTER}]+)?)|[ \n\t]+"
)
#: Units of any text: both cut before a space or line feed behind another character.
_WORDS = re.compile(r"\s*\S+(?:(?![ \n])\s+\S+)*|\s+")
_CROSSING = re.compile(f"[{LETTER}][^{LETTER}]|[^{LETTER}][{LETTER}]")

Ids = np.ndarray


@dataclass
class Fragment:
    """Tokens that end in a byte range; ``groups`` is None while no end is common.

    Groups are written ``a1,a2|b1;a3|b2,b3``; links are pairs of the last ids of each,
    a * 2^32 + b.
    """

    prefix: tuple[list[int], list[int]]
    groups: bytes | None = None
    links: bytes = b""
    suffix: tuple[list[int], list[int]] = ((), ())
    n_a: int = 0
    n_b: int = 0

    @property
    def n_groups(self) -> int:
        return len(self.links) // 8


def written(a: list[int], b: list[int]) -> bytes:
    """One group."""
    if len(a) == len(b) == 1:
        return b"%d|%d" % (a[0], b[0])
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}".encode()


def link(a: list[int], b: list[int]) -> bytes:
    return (a[-1] << 32 | b[-1]).to_bytes(8, "little")


#: The start of a text: a common end before all tokens.
START = Fragment(([], []), b"", b"", ([], []))


def _joined(x: tuple, y: tuple) -> tuple[list[int], list[int]]:
    return [*x[0], *y[0]], [*x[1], *y[1]]


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative."""
    n_a, n_b = x.n_a + y.n_a, x.n_b + y.n_b
    if x.groups is None:
        prefix = _joined(x.prefix, y.prefix)
        return Fragment(prefix, y.groups, y.links, y.suffix, n_a, n_b)
    if y.groups is None:
        suffix = _joined(x.suffix, y.prefix)
        return Fragment(x.prefix, x.groups, x.links, suffix, n_a, n_b)
    seam = _joined(x.suffix, y.prefix)
    parts = [part for part in (x.groups, written(*seam), y.groups) if part]
    links = x.links + link(*seam) + y.links
    return Fragment(x.prefix, b";".join(parts), links, y.suffix, n_a, n_b)


def fragment(a: Ids, a_ends: np.ndarray, b: Ids, b_ends: np.ndarray) -> Fragment:
    """The fragment of a range from its tokens and where they end."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_list, b_list = a.tolist(), b.tolist()
    n_a, n_b = len(a_list), len(b_list)
    if not len(common):
        return Fragment((a_list, b_list), None, n_a=n_a, n_b=n_b)
    i = (np.searchsorted(a_ends, common) + 1).tolist()
    j = (np.searchsorted(b_ends, common) + 1).tolist()
    inner = zip(i, i[1:], j, j[1:])
    groups = b";".join(written(a_list[p:q], b_list[r:s]) for p, q, r, s in inner)
    last = np.array([i, j])[:, 1:] - 1
    links = (a.astype(np.int64)[last[0]] << 32 | b.astype(np.int64)[last[1]]).tobytes()
    prefix = (a_list[: i[0]], b_list[: j[0]])
    return Fragment(prefix, groups, links, (a_list[i[-1] :], b_list[j[-1] :]), n_a, n_b)


class Broken(ValueError):
    """The tokens of a text do not join to its bytes."""


class Aligner:
    """Fragments of texts, which start with the space that stands before every text."""

    def __init__(self, path_a: str, path_b: str, cached: int = CACHED):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = ByteWords(path_a, cached=20_000)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        self.b_bytes = [self._piece(i) for i in range(size)]
        self._check()
        tokens = self.a.tokens
        self.a_size = np.zeros(max(tokens) + 1, np.int64)
        self.a_size[list(tokens)] = [len(x) for x in tokens.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self._start = self.b.encode("\n")
        self._units = Memory(self.rows, cached)
        # Ids behind each sign, as they are written.
        self._ids = max(len(self.a_size), size)
        signs = (b"", b";", b",", b"|")
        self._written = [b"%b%d" % (sign, i) for sign in signs for i in range(self._ids)]
        self._written_size = np.fromiter(map(len, self._written), np.int64, 4 * self._ids)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return self.b.id_to_piece(i).replace(SPACE, " ").encode()

    def _check(self) -> None:
        """The model must cut at the ends of units."""
        for i, piece in enumerate(self.b_bytes):
            if self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i):
                continue
            text = piece.decode().lstrip(" ")
            if re.search("[ \n\t]", text) or _CROSSING.search(text) or not piece:
                raise ValueError(f"piece {i} crosses a cut: {text!r}")

    def tokens(self, text: str) -> tuple[Ids, Ids]:
        """Ids of a stretch of text between certain cuts, by both tokenizers."""
        a = np.frombuffer(self.a.plain(text), "<u4")
        b = self._behind([text])[0]
        if b"".join(map(self.b_bytes.__getitem__, b)) != text.encode():
            raise Broken
        if b"".join(map(self.a.tokens.__getitem__, a.tolist())) != text.encode():
            raise Broken
        return a, np.array(b, np.int64)

    def ends(self, a: Ids, b: Ids) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])

    def rows(self, units: list[str]) -> list[tuple[bytes, bytes, int, int] | bool]:
        """Groups, links and token counts of stretches between certain cuts; False for a broken one.

        All are worked on at once: their tokens lie one after the other, and each is
        written behind the sign that separates it from the one before.
        """
        a_lists, b_lists = [self.a.ids_of(text) for text in units], self._behind(units)
        a_counts, b_counts = (np.fromiter(map(len, x), np.int64, len(units)) for x in (a_lists, b_lists))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a_lists, b_lists))
        data = "".join(units).encode()
        for ids, tokens in ((a, self.a.tokens), (b, self.b_bytes)):
            if b"".join(map(tokens.__getitem__, ids.tolist())) != data:
                if len(units) == 1:
                    return [False]
                return [row for text in units for row in self.rows([text])]
        a_ends, b_ends = self.ends(a, b)
        a_closes, b_closes = np.isin(a_ends, b_ends), np.isin(b_ends, a_ends)
        # Tokens of the groups before each one's own, of the other tokenizer.
        a_group, b_group = (np.cumsum(x) - x for x in (a_closes, b_closes))
        n = int(a_closes.sum())
        a_upto = np.cumsum(np.bincount(a_group, minlength=n))
        b_before = np.cumsum(np.bincount(b_group, minlength=n)) - np.bincount(b_group, minlength=n)
        a_first, b_first = (np.diff(x, prepend=-1) > 0 for x in (a_group, b_group))
        a_sign = np.where(a_first, _NEXT, _MORE)
        a_sign[np.cumsum(a_counts) - a_counts] = _START
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + b_before[a_group]] = a_sign * self._ids + a
        codes[np.arange(len(b)) + a_upto[b_group]] = np.where(b_first, _SIDE, _MORE) * self._ids + b
        text = b"".join(map(self._written.__getitem__, codes.tolist()))
        ends = np.cumsum(self._written_size[codes])[np.cumsum(a_counts + b_counts) - 1].tolist()
        links = (a[a_closes] << 32 | b[b_closes]).tobytes()
        unit = np.repeat(np.arange(len(units)), a_counts)[a_closes]
        to = (8 * np.cumsum(np.bincount(unit, minlength=len(units)))).tolist()
        spans = zip([0, *ends], ends, [0, *to], to, a_counts.tolist(), b_counts.tolist())
        return [(text[i:j], links[p:q], n_a, n_b) for i, j, p, q, n_a, n_b in spans]

    def _behind(self, units: list[str]) -> list[list[int]]:
        """The second tokenizer's ids; it gets each unit behind a line feed, joined with nothing."""
        skipped = len(self._start)
        found = self.b.encode(["\n" + text for text in units], num_threads=1)
        return [ids[skipped:] for ids in found]

    def whole(self, text: str) -> Fragment:
        """The fragment of a text that starts and ends at certain cuts."""
        found = self.wholes([text])[0]
        if found is None:
            raise Broken
        return found

    def wholes(self, texts: list[str]) -> list[Fragment | None]:
        """The fragments of such texts; None for a broken one.

        Units are closed, so their composition is their groups one after the other.
        """
        parted = [_UNITS.findall(text) if is_plain(text) else None for text in texts]
        self._units.fill(set(chain.from_iterable(units or () for units in parted)))
        return [self._whole(text, units) for text, units in zip(texts, parted)]

    def _whole(self, text: str, units: list[str] | None) -> Fragment | None:
        if units is None:
            found = self.rows([text])
        else:
            found = list(map(self._units.__getitem__, units))
        if not all(found):
            return None
        groups, links, n_a, n_b = zip(*found)
        return Fragment(
            ([], []), b";".join(groups), b"".join(links), ([], []), sum(n_a), sum(n_b)
        )

    def part(self, text: str, lo: int, hi: int) -> Fragment:
        """The fragment of the tokens that end behind byte ``lo`` of a window, up to ``hi``.

        The window starts and ends at certain cuts. Units that lie in the range come
        from memory; only those across its ends are looked at token by token.
        """
        if not is_plain(text):
            return self._slice(text, lo, hi)
        units = _UNITS.findall(text)
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left")
        start = int(ends[first - 1]) if first else 0
        if first >= last:  # within one unit, or up to its end
            return self._slice(units[first], lo - start, hi - start)
        found = Fragment(([], []))
        if start < lo:
            found = self._slice(units[first], lo - start, int(ends[first]) - start)
            first += 1
        whole = int(ends[last]) == hi
        if inner := units[first : last + whole]:
            found = compose(found, self._range(inner))
        if not whole:
            start = int(ends[last - 1])
            found = compose(found, self._slice(units[last], 0, hi - start))
        return found

    def _range(self, units: list[str]) -> Fragment:
        """Whole units as the fragment of their range, which does not know that it starts at a cut."""
        self._units.fill(set(units))
        found = self._whole("", units)
        if found is None:
            raise Broken
        first, _, rest = found.groups.partition(b";")
        prefix = tuple([int(i) for i in side.split(b",")] for side in first.split(b"|"))
        return Fragment(prefix, rest, found.links[8:], ([], []), found.n_a, found.n_b)

    def _slice(self, text: str, lo: int, hi: int) -> Fragment:
        a, b = self.tokens(text)
        a_ends, b_ends = self.ends(a, b)
        in_a, in_b = (a_ends > lo) & (a_ends <= hi), (b_ends > lo) & (b_ends <= hi)
        return fragment(a[in_a], a_ends[in_a], b[in_b], b_ends[in_b])


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker, kept from task to task until a stage lets go of it."""
    return kept("aligner", (path_a, path_b), lambda: Aligner(path_a, path_b))


def ranges(text: str, size: int = RANGE) -> list[tuple[str, int, int]]:
    """Byte ranges of a text that starts with a space: window, first and last byte in it.

    Ranges end at multiples of ``size``; a window reaches to the certain cuts around
    its range. Of several ends in one stretch without such a cut only the first
    counts, so a byte is in two windows at most.
    """
    cuts, at = [0], 0
    for word in _WORDS.findall(text):
        at += len(word.encode())
        cuts.append(at)
    total = at
    found, lo, data, seen = [], 0, text.encode(), -1
    places = np.array(cuts)
    for hi in [*range(size, total, size), total]:
        stretch = int(np.searchsorted(places, hi))
        if hi < total and stretch == seen:
            continue
        seen = stretch
        start = cuts[int(np.searchsorted(places, lo, "right")) - 1]
        end = cuts[stretch]
        found.append((data[start:end].decode(), lo - start, hi - start))
        lo = hi
    return found


_FRAGMENT = (
    "ok boolean, n_a long, n_b long, open boolean, prefix_a binary, prefix_b binary, "
    "groups binary, links binary, suffix_a binary, suffix_b binary"
)
_COLUMNS = [part.split()[0] for part in _FRAGMENT.split(", ")]
_ARROW = [pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), *[pa.binary()] * 6]


def _packed(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def to_row(found: Fragment | None) -> tuple:
    """A fragment as columns; None is that of a broken text."""
    if found is None:
        return (False, 0, 0, True, b"", b"", b"", b"", b"", b"")
    ends = [*map(_packed, found.prefix), found.groups or b"", found.links]
    ends += map(_packed, found.suffix)
    return (True, found.n_a, found.n_b, found.groups is None, *ends)


def from_row(row: dict) -> Fragment | None:
    if not row["ok"]:
        return None
    return Fragment(
        (_unpacked(row["prefix_a"]), _unpacked(row["prefix_b"])),
        None if row["open"] else row["groups"],
        row["links"],
        (_unpacked(row["suffix_a"]), _unpacked(row["suffix_b"])),
        row["n_a"],
        row["n_b"],
    )


def range_fragments(docs: DataFrame, path_a: str, path_b: str, size: int = RANGE) -> DataFrame:
    """Fragments of the byte ranges of each row of ``docs`` (doc_key, doc_id, text).

    The ranges are dealt anew, so that those of one text are worked on by many tasks.
    """
    id_kind = docs.schema["doc_id"].dataType
    key = [T.StructField("doc_key", T.LongType()), T.StructField("doc_id", id_kind)]
    place = T.StructType.fromDDL("place int, ranges int")
    window = T.StructType([*key, *place, *T.StructType.fromDDL("window string, lo int, hi int")])

    def part(batches):
        for batch in slices(batches, 1):
            found = ranges(" " + batch.column(2)[0].as_py(), size)
            n = len(found)
            windows, lows, highs = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    *(column.take(pa.array([0] * n)) for column in batch.columns[:2]),
                    pa.array(range(n), pa.int32()),
                    pa.array([n] * n, pa.int32()),
                    pa.array(windows, pa.string()),
                    pa.array(lows, pa.int32()),
                    pa.array(highs, pa.int32()),
                ],
                window.names,
            )

    schema = T.StructType([*key, *place, *T.StructType.fromDDL(_FRAGMENT)])

    def align(batches):
        held = aligner(path_a, path_b)
        for batch in slices(batches, 16):
            rows = []
            for text, lo, hi in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6))):
                try:
                    rows.append(to_row(held.part(text, lo, hi)))
                except Broken:
                    rows.append(to_row(None))
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), _ARROW)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns], schema.names)

    # A stated number of tasks: small windows would be put together by their bytes, but
    # what counts is the work on them.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.mapInArrow(part, window).repartition(tasks, "doc_key", "place")
    return dealt.mapInArrow(align, schema)


def reduced(fragments: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One fragment per doc_key: neighbours composed by ``fan_in``, round after round."""
    most = fragments.agg(F.max("ranges")).first()[0] or 1
    schema = fragments.schema

    def step(rows):
        rows = rows.sort_by("place")
        found = [from_row(row) for row in rows.select(_COLUMNS).to_pylist()]
        whole = None if None in found else found[0]
        for other in found[1:] if whole else ():
            whole = compose(whole, other)
        first = rows.slice(0, 1)
        place, ranges_ = (first.column(name)[0].as_py() for name in ("place", "ranges"))
        place = pa.array([place // fan_in], pa.int32())
        ranges_ = pa.array([-(-ranges_ // fan_in)], pa.int32())
        columns = [pa.array([x], kind) for x, kind in zip(to_row(whole), _ARROW)]
        heads = [first.column(name) for name in ("doc_key", "doc_id")]
        return pa.table([*heads, place, ranges_, *columns], schema.names)

    while most > 1:
        step_of = F.floor(F.col("place") / fan_in)
        fragments = fragments.groupBy("doc_key", step_of).applyInArrow(step, schema)
        most = -(-most // fan_in)
    return fragments


_ALIGNED = (
    "n_a long, n_b long, n_groups long, groups string, pairs binary, times binary"
)


def _counted(links: bytes) -> tuple[bytes, bytes]:
    pairs, times = np.unique(np.frombuffer(links, "<i8"), return_counts=True)
    return pairs.tobytes(), times.astype("<i4").tobytes()


def _result(found: Fragment | None, digest: bool) -> tuple:
    """Columns of a whole text; None is one without tokens."""
    if found is None:
        return 0, 0, 0, "", b"", b""
    groups = hashlib.sha256(found.groups).hexdigest() if digest else found.groups.decode()
    return found.n_a, found.n_b, found.n_groups, groups, *_counted(found.links)


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    size: int = RANGE,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups, and distinct links with their times, of each row.

    ``groups`` is the text of all groups, or with ``digest`` its sha256. pairs and
    times are arrays of 64 and 32 bits. Texts that are null, empty, or not the bytes
    of both tokenizers' tokens have zeros and empty groups. Repeated rows give one
    result each; no rows give no rows. A document's groups must fit a row.
    """
    id_kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", id_kind), *T.StructType.fromDDL(_ALIGNED)])
    kinds = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.binary()]
    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    long = F.coalesce(F.octet_length("text") > size, F.lit(False))

    def short(batches):
        held = aligner(path_a, path_b)
        for part in portions(batches, 1):
            texts = texts_of(part.column(1))
            found = iter(held.wholes([" " + text for text in texts if text]))
            rows = [_result(next(found) if text else None, digest) for text in texts]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema.names)

    def finish(batches):
        for part in slices(batches, 16):
            names = [part.schema.get_field_index(name) for name in _COLUMNS]
            rows = []
            for values in zip(*(part.column(i).to_pylist() for i in names)):
                found = from_row(dict(zip(_COLUMNS, values)))
                rows.append(_result(compose(START, found) if found else None, digest))
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
            at = part.schema.get_field_index("doc_id")
            yield pa.RecordBatch.from_arrays([part.column(at), *columns], schema.names)

    spark = docs.sparkSession
    numbered = read.where(long).select(F.monotonically_increasing_id().alias("doc_key"), "*")
    folder = new_folder(spark, "fragments")
    range_fragments(numbered, path_a, path_b, size).write.parquet(folder)
    # Written before it goes on, so that no task has two Python workers, each with its tables.
    whole_folder = new_folder(spark, "whole-fragments")
    reduced(spark.read.parquet(folder), fan_in).write.parquet(whole_folder)
    whole = spark.read.parquet(whole_folder)
    return read.where(~long).mapInArrow(short, schema).unionByName(
        whole.mapInArrow(finish, schema)
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links that hold it) and best (whether no pair of its second id has more)."""

    def add(batches):
        let_go()
        pairs, times, held = [], [], 0
        for part in slices(batches):
            for p, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                pairs.append(np.frombuffer(p, "<i8"))
                times.append(np.frombuffer(t, "<i4"))
                held += len(pairs[-1])
            if held > 2 * SUMMED:
                pairs, times = _summed(pairs, times)
                held = len(pairs[0])
                if held > SUMMED:
                    yield _batch(pairs, times)
                    pairs, times, held = [], [], 0
        if held:
            yield _batch(*_summed(pairs, times))

    sums = aligned.select("pairs", "times").mapInArrow(add, "pair long, n long")
    counted = sums.groupBy("pair").agg(F.sum("n").alias("n"))
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    most = counted.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    return counted.join(most, second == F.col("second")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _summed(pairs: list, times: list) -> tuple[list, list]:
    found, at = np.unique(np.concatenate(pairs), return_inverse=True)
    sums = np.bincount(at, np.concatenate(times), len(found))
    return [found], [sums.astype(np.int64)]


def _batch(pairs: list, times: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs[0], pa.int64()), pa.array(times[0], pa.int64())], ["pair", "n"]
    )


def frequent_pairs(counts: DataFrame, limit: int = FREQUENT) -> DataFrame:
    """The pairs of at least some power of two links, the least that leaves ``limit`` of them."""
    power = F.floor(F.log2("n")).cast("int").alias("power")
    rows = counts.groupBy(power).count().orderBy(F.desc("power")).collect()
    held, least = 0, 64
    for row in rows:  # one per power of two
        held += row["count"]
        if held > limit:
            break
        least = row["power"]
    return counts.where(power >= least)


def with_pair_counts(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` with n_links, n_best and count_sum instead of pairs and times.

    Writes ``aligned`` and the counts before it reads them back. n_best is the links
    whose pair is, over all rows, the most frequent one of its second id, ties
    included; count_sum adds the pairs' counts over all links.
    """
    spark = aligned.sparkSession
    folder, counts_folder = new_folder(spark, "aligned"), new_folder(spark, "pair_counts")
    aligned.write.parquet(folder)
    stored = spark.read.parquet(folder)
    pair_counts(stored).write.parquet(counts_folder)
    counts = spark.read.parquet(counts_folder)
    table = frequent_pairs(counts, frequent).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(
        tuple(table.column(i).to_numpy() for i in range(3))
    )
    names = [name for name in aligned.columns if name not in ("pairs", "times")]
    schema = T.StructType(
        [
            T.StructField("row_key", T.LongType()),
            *[aligned.schema[name] for name in names],
            *T.StructType.fromDDL(
                "n_links long, n_best long, count_sum long, pairs array<long>, times array<int>"
            ).fields,
        ]
    )

    def look_up(batches):
        let_go()
        keys, counted, best = shared.value
        for part in slices(batches):
            sums, rest = [], []
            columns = (part.column(len(names) + i).to_pylist() for i in (1, 2))
            for pairs, times in zip(*columns):
                pairs, times = np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i4")
                at = np.searchsorted(keys, pairs)
                known = at < len(keys)
                known[known] = keys[at[known]] == pairs[known]
                hit, n = at[known], times[known].astype(np.int64)
                sums.append((times.sum(), n[best[hit]].sum(), (n * counted[hit]).sum()))
                rest.append((pairs[~known], times[~known]))
            added = [pa.array(x, pa.int64()) for x in zip(*sums)]
            others = [
                pa.array(x, pa.list_(kind))
                for x, kind in zip(zip(*rest), (pa.int64(), pa.int32()))
            ]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(names) + 1], *added, *others], schema.names
            )

    found_folder = new_folder(spark, "links")
    keyed = stored.select(
        F.monotonically_increasing_id().alias("row_key"), *names, "pairs", "times"
    )
    keyed.mapInArrow(look_up, schema).write.parquet(found_folder)
    found = spark.read.parquet(found_folder)
    rare = found.where(F.size("pairs") > 0).select(
        "row_key", F.explode(F.arrays_zip("pairs", "times")).alias("link")
    )
    rare = rare.select("row_key", F.col("link.pairs").alias("pair"), "link.times")
    more = (
        rare.join(counts, "pair")
        .groupBy("row_key")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    none = F.lit(0).cast("long")
    return found.join(more, "row_key", "left").select(
        *names,
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"),
    )
