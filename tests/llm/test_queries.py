"""The registered queries over whole given tables, against brute force and the libraries."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import queries

from .test_near_copies import _brute as brute_components
from .test_new_rows import _brute_alignment

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def _found(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def _library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def _ids(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")


def test_near_duplicates(spark, docs):
    want, sizes = brute_components(list(docs.items()), 2)
    rows = _found(spark, "op2_minhash_near_dedup")
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        doc: (sizes[doc], want[doc], want[doc] == doc) for doc in docs
    }


def test_token_counts(spark, docs):
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    for r in _found(spark, "op4_token_counts"):
        n = len(model.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_byte_bpe(spark, docs):
    library = _library("byte_bpe_50k.json")
    for r in _found(spark, "op8_byte_bpe"):
        ids = _ids(library, docs[r.doc_id])
        back = library.decode(ids.tolist(), skip_special_tokens=False).encode()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back).hexdigest(),
        )


@pytest.mark.parametrize(
    "name,vocabulary,end,capacity",
    [("op9_best_fit_packing", "word_bpe_49k.json", 1, 4096), ("op11_vector_packing", "byte_bpe_50k.json", 0, 1024)],
)
def test_packing(spark, docs, name, vocabulary, end, capacity):
    library, rows = _library(vocabulary), _found(spark, name)
    pieces, filled = defaultdict(list), defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled[r.sequence_id] == r.offset
        filled[r.sequence_id] += r.length
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    total = 0
    for doc, text in docs.items():
        ids, at = np.append(_ids(library, text), end).astype("<u4"), 0
        for start, length, crc in sorted(pieces[doc]):
            assert start == at and crc == zlib.crc32(ids[at : at + length].tobytes())
            at += length
        assert at == len(ids)
        total += at
    assert max(filled.values()) <= capacity and len(filled) <= total / capacity + 7
    if name.startswith("op11"):
        assert all(n & (n - 1) == 0 for n in filled.values())


def test_embedding_links(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in table])
    vectors = np.array([r.embedding for r in table], np.float64)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = vectors @ vectors.T >= 0.95
    np.fill_diagonal(linked, False)
    label = ids.copy()
    for _ in ids:
        label = np.array([min([label[i], *label[linked[i]]]) for i in range(len(ids))])
    rows = {r.vec_id: r for r in _found(spark, "op10_cap_near_dedup")}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in rows.items()} == {
        int(i): (int(n), int(c), bool(c == i)) for i, n, c in zip(ids, linked.sum(1), label)
    }


def test_alignment(spark, docs):
    a = _library("byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows, links = _brute_alignment(list(docs.values()), (a, b))
    total = Counter(pair for found in links for pair in found)
    most = defaultdict(int)
    for (_, second), n in total.items():
        most[second] = max(most[second], n)
    want = {}
    for doc, (n_a, n_b, n_groups, groups), pairs in zip(docs, rows, links):
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        best = sum(total[p] == most[p[1]] for p in pairs)
        want[doc] = (n_a, n_b, n_groups, len(pairs), best, sum(total[p] for p in pairs), digest)
    got = {
        r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
        for r in _found(spark, "op13_tokenizer_alignment")
    }
    assert got == want


def test_surrogates_keep_every_document(spark, docs):
    rows = {r.doc_id: r for r in _found(spark, "op5_pii_surrogates")}
    assert set(rows) == set(docs)
    for doc, r in rows.items():
        assert (r.text or "") == docs[doc] or r.n_entities > 0
        for word in ("AKIA", "password="):
            at = docs[doc].find(word)
            if at >= 0:
                assert docs[doc][at : at + 20] not in r.text


def test_pipeline(spark, docs):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} <= set(docs) and len({r.doc_id for r in rows}) > 0.5 * len(docs)
    filled = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled[r.sequence_id] == r.offset
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 4096
