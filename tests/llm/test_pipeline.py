"""The pipeline over small tables of its own, and the queries against the whole given ones."""

import random

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline

from .helpers import HARD, documents
from .test_text_models import BAD, _text, _toxic

SF_DIR = "/root/testdata/sf0.01"


def _tables(spark, root, rows, labels):
    documents(spark, rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")


def test_stages(spark, tmp_path):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(20, 320):
        label = int(i % 3 == 0)
        lang = "aa" if i % 2 else "bb"
        text = _toxic(rng, BAD, lang=lang) if label else _text(rng, lang)
        rows.append((i, text, lang, "s", len(text)))
        labels.append((i, 1, label))
    clean = [row for row, (*_, label) in zip(rows, labels) if not label]
    copies = [(1_000 + i, row[1], *row[2:]) for i, row in enumerate(clean[:10])]
    mail = (2_000, clean[0][1].replace(".", " x.y@mail.example.com") + " " + _text(rng), "bb", "s", 1)
    rows = [*rows, *copies, mail, *HARD, (3_000, "12 34 || --", "aa", "s", 1)]
    _tables(spark, tmp_path, rows, labels)
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    toxic = {doc for doc, _, label in labels if label}
    assert len(toxic - set(seen["toxicity"])) >= 0.9 * len(toxic)
    left = {row[0] for row in clean}
    assert len(left & set(seen["toxicity"])) >= 0.95 * len(left)
    assert left & set(seen["toxicity"]) <= set(seen["language_id"]) and 3_000 not in seen["language_id"]
    assert not {c[0] for c in copies} & set(seen["minhash_near_dedup"])
    if 2_000 in seen["pii_surrogates"]:
        assert "mail.example.com" not in seen["pii_surrogates"][2_000].text
    assert set(seen["best_fit_packing"]) == set(seen["pii_surrogates"])


def test_empty_tables(spark, tmp_path):
    _tables(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_a_query():
    found = [name for name in contract.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in found) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", ["op6_exact_top_k", "op12_fill_in_middle"])
def test_queries_match_their_sql(spark, name):
    from tidemark.llm import queries

    db = duckdb.connect()
    for table in ("embeddings", "documents"):
        db.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    want = db.execute(queries.ORACLES[name]).fetchall()
    rows = queries.QUERIES[name](spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == sorted(want)


@pytest.mark.parametrize("name", ["op1_license_scan", "op3_toxicity", "op7_language_id", "op13_tokenizer_alignment"])
def test_one_row_per_document(spark, name):
    from tidemark.llm import queries

    rows = queries.QUERIES[name](spark, SF_DIR)
    assert rows.select("doc_id").distinct().count() == rows.count() == 1_000
