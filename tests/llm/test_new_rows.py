"""Vector packing, fill-in-middle and tokenizer alignment against brute force and the libraries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, byte_words, fim, vector_packing
from tidemark.llm.bpe import byte_letters
from tidemark.llm.vector_packing import Limits

from .helpers import HARD, clashing, documents, fuzz

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [*fuzz(2_000), *(row[1] or "" for row in HARD)]
LONG = [" ".join(fuzz(60, seed=s, longest=30)).replace("▁", "_") for s in range(6)]
ROWS = [*HARD, *((100 + i, text, "en", "s", 1) for i, text in enumerate(LONG + TEXTS[:40]))]


def test_ids_of_whole_texts_are_those_of_the_library():
    library, own = Tokenizer.from_file(BYTES), byte_words.ByteWords(BYTES, cached=300)
    plain = Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = True
    for text in TEXTS:
        for held, found in ((library, own.encode(text)), (plain, own.plain(text))):
            ids = held.encode(text, add_special_tokens=False).ids
            assert found == np.array(ids, "<u4").tobytes(), repr(text)


# --- vector packing


def _filled(rows, tokens):
    """Tokens of each sequence, after a check of offsets without gaps."""
    at = defaultdict(int)
    for sequence, offset, length in sorted(rows):
        assert at[sequence] == offset and (length > 0 or tokens is None)
        at[sequence] += length
    return at


@pytest.mark.parametrize("n,longest,segments", [(700, 1023, 256), (900, 9, 16), (300, 40, 1), (3, 5, 2), (0, 1, 1)])
def test_cut_shards_have_no_padding(n, longest, segments):
    lengths = np.random.default_rng(n).integers(1, longest + 1, n)
    limits = Limits(1024, segments, 1024)
    found = vector_packing.pack_shard(lengths, lengths, limits, cut=True)
    filled = _filled(zip(found.sequence, found.offset, found.length), 1024)
    assert all(total <= 1024 and total & (total - 1) == 0 for total in filled.values())
    assert max(Counter(found.sequence).values(), default=0) <= segments
    pieces = defaultdict(list)
    for example, start, length in zip(found.example, found.start, found.length):
        pieces[example].append((start, length))
    for example, length in enumerate(lengths.tolist()):
        at = 0
        for start, size in sorted(pieces[example]):
            assert start == at
            at += size
        assert at == length


def _next_by_dot_product(demands, room, weights):
    """The demand that the heuristic likes best, by its definition."""
    fits = [d for d in demands if all(x <= y for x, y in zip(d, room))]
    return max((sum(w * x * y for w, x, y in zip(weights, d, room)) for d in fits), default=None)


def test_whole_examples_are_placed_by_the_heuristic():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 400, 200)
    loss = (tokens * rng.random(200)).astype(int)
    limits = Limits(1000, 7, 450)
    found = vector_packing.pack_shard(tokens, np.minimum(loss, 450), limits)
    loss = np.minimum(loss, 450)
    weights = [tokens.sum() / 1000**2, 200 / 7**2, loss.sum() / 450**2]
    left = {i: (int(t), 1, int(x)) for i, (t, x) in enumerate(zip(tokens, loss))}
    room, at = (1000, 7, 450), -1
    for example, sequence in zip(found.example, found.sequence):
        if sequence != at:
            assert at < 0 or _next_by_dot_product(left.values(), room, weights) is None
            room, at = (1000, 7, 450), sequence
        demand = left.pop(example)
        liked = sum(w * x * y for w, x, y in zip(weights, demand, room))
        room_now = _next_by_dot_product([*left.values(), demand], room, weights)
        assert liked == pytest.approx(room_now)
        room = tuple(x - y for x, y in zip(room, demand))
    assert not left and min(room) >= 0
    with pytest.raises(ValueError):
        vector_packing.pack_shard(np.array([1001]), np.array([0]), limits)


def test_packed_documents(spark):
    library = Tokenizer.from_file(BYTES)
    rows = vector_packing.pack_documents(
        clashing(documents(spark, ROWS)), BYTES, limits=Limits(64, 16, 64), shard_examples=40
    ).collect()
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append((row.start, row.length, row.ids_crc32, row.doc_tokens))
    for doc, text, *_ in ROWS:
        ids = np.append(library.encode(text or "", add_special_tokens=False).ids, 0).astype("<u4")
        copies = sum(row[0] == doc for row in ROWS)
        assert sum(length for _, length, *_ in pieces[doc]) == copies * len(ids)
        for start, length, crc, total in pieces[doc]:
            assert total == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
        if copies == 1:
            assert len({start for start, *_ in pieces[doc]}) == len(pieces[doc])
    filled = _filled([(r.sequence_id, r.offset, r.length) for r in rows], 64)
    assert all(total <= 64 and total & (total - 1) == 0 for total in filled.values())
    assert vector_packing.pack_documents(documents(spark, []), BYTES).count() == 0


def test_packed_conversations(spark):
    turns = [
        (c, t, "assistant" if t % 2 else "user", text)
        for c in range(40)
        for t, text in enumerate(fuzz(4, seed=c, longest=60))
    ] + [(40, 0, "assistant", None), (41, 0, None, ""), (41, 0, None, ""), (None, 0, "user", "x")]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    examples = vector_packing.conversation_examples(table, BYTES)
    library = Tokenizer.from_file(BYTES)
    want = defaultdict(lambda: [0, 0])
    for conv, _, role, text in turns:
        n = len(library.encode(text or "", add_special_tokens=False).ids) + 1
        want[conv][0] += n
        want[conv][1] += n * (role == "assistant")
    assert {r.conv_id: [r.tokens, r.loss] for r in examples.collect()} == dict(want)
    limits = Limits(400, 5, 200)
    named = clashing(examples).drop("shard").withColumn("a.b", F.lit(1))
    packed = vector_packing.pack_examples(named, F.col("tokens"), F.col("loss"), limits, 20)
    rows = packed.collect()
    assert packed.columns == [*named.columns, "sequence_id", "offset"] and len(rows) == len(want)
    used = defaultdict(lambda: np.zeros(3, int))
    for row in rows:
        used[row.sequence_id] += (row.tokens, 1, row.loss)
    assert all((x <= limits.vector()).all() for x in used.values())
    _filled([(r.sequence_id, r.offset, r.tokens) for r in rows], None)
    with pytest.raises(ValueError):
        vector_packing.pack_examples(clashing(examples), F.col("tokens"), F.col("loss"))


# --- fill-in-middle


def _brute_fim(doc, text):
    units = regex.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = ("".join(part) for part in (units[:i], units[i:j], units[j:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    marks = ["a <P> b", "<S>", "x<M>", "<P", "S><S", "<<PP>> <<MM>>", "line\nline\r\n", "<M", "a<S b>P>"]
    rows = [*ROWS, *((1_000 + i, marks[i % 9], "en", "s", 1) for i in range(90))]
    made = fim.transform_documents(clashing(documents(spark, rows)))
    found = made.collect()
    for (doc, text, *_), row in zip(rows, found):
        assert tuple(row)[:1] + tuple(row)[1:] == (doc, *_brute_fim(doc, text or ""))
    assert {row.form for row in found} == {"plain", "psm", "spm"}
    back = made.select(fim.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert [r.text for r in back] == [text or "" for _, text, *_ in rows]
    for row, (_, text, *_) in zip(fim.digest(made).collect(), rows):
        assert row.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert fim.transform_documents(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        fim.unit_ends("a1", "[a-z]")


# --- alignment


def _tokens(text, a, b):
    """Ids, and byte ends of the tokens, of both libraries; None if their bytes are not the text's."""
    letters = byte_letters()
    coded, ids = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    own = [bytes(letters[c] for c in token) for token in coded.tokens]
    other = [
        bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids
    ]
    if any(b"".join(x) != (" " + text).encode() for x in (own, other)):
        return None
    return [(i, e) for i, e in zip(coded.ids, np.cumsum([*map(len, own)]).tolist())], [
        (i, e) for i, e in zip(ids, np.cumsum([*map(len, other)]).tolist())
    ]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def _brute_alignment(texts, libraries):
    """(n_a, n_b, groups) of each text and the links of each, by comparing all ends."""
    out, links = [], []
    for text in texts:
        found = _tokens(text, *libraries) if text else None
        if found is None:
            out.append((0, 0, 0, ""))
            links.append([])
            continue
        a, b = found
        ends, groups, low = sorted({e for _, e in a} & {e for _, e in b}), [], 0
        for end in ends:
            sides = [",".join(str(i) for i, e in x if low < e <= end) for x in (a, b)]
            groups.append("|".join(sides))
            low = end
        out.append((len(a), len(b), len(groups), ";".join(groups)))
        by_end = dict((e, i) for i, e in b)
        links.append([(i, by_end[e]) for i, e in a if e in by_end])
    return out, links


def test_fragments_compose_in_any_order(libraries):
    rng = random.Random(2)
    held = alignment.Aligner(BYTES, PIECES, cached=50)
    texts = [t for t in [*LONG, *TEXTS[:150]] if t and _tokens(t, *libraries)]
    want, _ = _brute_alignment(texts, libraries)
    for text, row in zip(texts, want):
        whole = held.whole(" " + text)
        assert (whole.n_a, whole.n_b, whole.n_groups, whole.groups.decode()) == row
        parts = [held.part(*x) for x in alignment.ranges(" " + text, rng.choice((3, 8, 30)))]
        while len(parts) > 1:  # any tree gives the same
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [alignment.compose(parts[i], parts[i + 1])]
        parts = alignment.compose(alignment.START, parts[0])
        assert (parts.n_a, parts.n_b, parts.n_groups, parts.groups.decode()) == row
        assert parts.links == whole.links and not any(parts.suffix)
    nothing = alignment.Fragment(([], []))
    for x in (whole, nothing, alignment.fragment(np.array([5]), np.array([1]), np.array([6]), np.array([2]))):
        assert alignment.compose(nothing, x) == alignment.compose(x, nothing)


def test_ranges_cover_a_text_once():
    for text in [*LONG, "漢" * 500, "a b " * 100]:
        found = alignment.ranges(" " + text, 40)
        data = (" " + text).encode()
        assert b"".join(w.encode()[lo:hi] for w, lo, hi in found) == data
        assert sum(len(w.encode()) for w, *_ in found) <= 3 * len(data) + 200


@pytest.mark.parametrize("size,fan_in,frequent", [(1 << 16, 8, 1 << 20), (3_000, 2, 30), (20_000, 3, 1)])
def test_aligned_documents(spark, libraries, size, fan_in, frequent):
    rows = [*ROWS, (900, "▁ mark", "x", "s", 1), (901, "▁" + LONG[0], "x", "s", 1)]
    texts = [row[1] or "" for row in rows]
    want, links = _brute_alignment(texts, libraries)
    total = Counter(pair for found in links for pair in found)
    most = defaultdict(int)
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    docs = clashing(documents(spark, rows))
    aligned = alignment.align_documents(docs, BYTES, PIECES, size=size, fan_in=fan_in)
    found = alignment.with_pair_counts(aligned, frequent).collect()
    expected = sorted(
        (doc or 0, *row, len(pairs), sum(total[p] == most[p[1]] for p in pairs), sum(total[p] for p in pairs))
        for (doc, *_), row, pairs in zip(rows, want, links)
    )
    assert sorted((r[0] or 0, *r[1:]) for r in found) == expected


def test_alignment_of_no_rows(spark):
    aligned = alignment.align_documents(documents(spark, []), BYTES, PIECES, digest=True)
    assert alignment.with_pair_counts(aligned).count() == 0
