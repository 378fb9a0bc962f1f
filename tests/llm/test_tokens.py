"""Token counts, byte-level BPE and packing against the libraries themselves."""

import hashlib
import weakref
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, rows, token_counts
from tidemark.llm.rows import Memory

from .helpers import HARD, clashing, documents, fuzz

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [*fuzz(3_000), *(row[1] or "" for row in HARD)]


def _ids(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")


@pytest.mark.parametrize("table", [{}, {" the": 1, ".": 1}])
def test_counts_are_those_of_the_library(table):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lengths = token_counts.Lengths(table, token_counts.load(PIECES), cached=500)
    assert [lengths.count(t) for t in TEXTS] == [len(x) for x in model.encode(TEXTS)]


def test_forced_boundaries_change_no_id():
    library, codec = Tokenizer.from_file(BYTES), bpe.Codec(BYTES, cached=500)
    for text in TEXTS:
        ids = codec.encode(text)
        assert ids == _ids(library, text).tobytes(), repr(text[:60])
        back = library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert codec.decode(ids).decode() == back
    parts = codec.fragments(b"some words, cut.")
    assert len(parts) > 3 and b"".join(parts) == b"some words, cut."


def test_word_ids_are_those_of_the_library():
    library, own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS, cached=500)
    for text, ids in zip(TEXTS, own.encode_all(TEXTS)):
        assert ids == _ids(library, text).tobytes(), repr(text[:60])


class Unwalked(Memory):
    """Fails where all that is remembered would be gone through."""

    def __iter__(self):
        raise AssertionError("a miss went through the whole memory")


def test_a_miss_looks_only_at_its_own_key():
    """As for every new pre-token of op11_vector_packing."""
    made = []
    held = Unwalked(lambda keys: [made.append(key) or len(key) for key in keys], 10)
    words = ["a", "to", "the", "a", "this", "to", "a", "these", "the", "these"]
    assert [held[word] for word in words] == list(map(len, words))
    held.fill({"a", "those"})
    assert held["those"] == 5 and sorted(made) == sorted({*words, "those"})


def test_a_memory_is_bounded_in_characters():
    held = Memory(lambda keys: list(map(len, keys)), 100)
    for n in range(300):
        key = f"{n:03}" * 200
        assert held[key] == len(key) and len(held) + len(held._old) <= 4
    short = [f"{n:02}" for n in range(100)]
    held.fill(set(short))
    assert len(held) == 100 and held._length == 200


def test_portions_are_bounded_in_bytes():
    texts = ["é" * 30, None, "", *["x" * 9] * 600, "y" * 500, "z" * 70, None]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    found = [part.column(1).to_pylist() for part in rows.portions([batch], 1, 100)]
    assert [text for part in found for text in part] == texts
    for part in found:
        sizes = [len((text or "").encode()) for text in part]
        assert sum(sizes[:-1]) <= 100 and len(part) <= rows.ROWS
    assert list(rows.portions([batch.slice(0, 0)], 1, 100)) == []


def test_what_a_worker_lets_go_of_is_freed():
    class Owner:
        def __init__(self):
            self.known = Memory(self.work, 10)

        def work(self, keys):
            return keys

    held = weakref.ref(rows.kept("owner", 1, Owner))
    assert held() is rows.kept("owner", 1, Owner)
    rows.let_go()
    assert held() is None


def test_hard_rows(spark):
    docs = clashing(documents(spark))
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    library = Tokenizer.from_file(BYTES)
    counted = token_counts.count_tokens(docs, PIECES).collect()
    digests = bpe.digest_documents(docs, BYTES).collect()
    coded = bpe.encode_documents(docs, BYTES).collect()
    for (doc, text, *_), n, digest, code in zip(HARD, counted, digests, coded):
        text = text or ""
        assert (n.doc_id, n.n_bytes, n.n_tokens) == (doc, len(text.encode()), len(model.encode(text)))
        assert n.over_limit == (n.n_tokens > 4096)
        ids = _ids(library, text)
        assert digest.n_tokens == len(ids) and code.ids == ids.tolist() and code.decoded == text
        assert digest.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert digest.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert token_counts.count_tokens(empty, PIECES).count() == 0
    assert bpe.digest_documents(empty, BYTES).count() == 0
    assert packing.pack_documents(empty, WORDS).count() == 0


@pytest.mark.parametrize("capacity", [7, 64])
def test_best_fit_decreasing_takes_the_tightest_sequence(capacity):
    rng = np.random.default_rng(capacity)
    lengths = rng.integers(1, capacity + 1, 300).tolist()
    rooms, want = [], [0] * len(lengths)
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        fits = [room for room in rooms if room >= lengths[i]]
        if fits:
            rooms[rooms.index(min(fits))] -= lengths[i]
        else:
            rooms.append(capacity - lengths[i])
    sequence, offset = packing.best_fit_decreasing(lengths, capacity)
    assert len(set(sequence)) == len(rooms)
    filled = {}
    for s, o, n in sorted(zip(sequence, offset, lengths)):
        assert filled.get(s, 0) == o
        filled[s] = o + n
    assert sorted(capacity - x for x in filled.values()) == sorted(rooms) and max(filled.values()) <= capacity


def test_packed_pieces(spark):
    library = Tokenizer.from_file(WORDS)
    docs = clashing(documents(spark))
    rows = packing.pack_documents(docs, WORDS, capacity=100, shard_pieces=50).collect()
    pieces = {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append((row.piece, row.start, row.length, row.ids_crc32))
    copies = {doc: sum(r[0] == doc for r in HARD) for doc, *_ in HARD}
    for doc, text, *_ in HARD:
        ids = np.append(_ids(library, text or ""), 1).astype("<u4")
        want = [
            (i // 100, i, len(ids[i : i + 100]), zlib.crc32(ids[i : i + 100].tobytes()))
            for i in range(0, len(ids), 100)
        ]
        assert sorted(pieces[doc]) == sorted(want * copies[doc])
    filled = {}
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(row.sequence_id, 0) == row.offset
        filled[row.sequence_id] = row.offset + row.length
    assert max(filled.values()) <= 100
