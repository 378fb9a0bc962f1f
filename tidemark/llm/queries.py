"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    bpe,
    capdedup,
    fim,
    langid,
    licenses,
    minhash,
    packing,
    pii,
    token_counts,
    topk,
    toxicity,
    vector_packing,
)
from tidemark.llm.rows import crc_bucket

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark, sf_dir):
    return licenses.digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query
def op2_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@query
def op3_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_bucket("doc_id", 5) == 0
    scored = toxicity.score_documents(docs, toxicity.fit(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op4_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, "key of the registered query", report=True)


@query
def op6_exact_top_k(spark, sf_dir):
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 4) == 2
    found = langid.identify(docs, langid.fit(docs, ~held_out))
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


@query
def op8_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe.digest_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_cap_near_dedup(spark, sf_dir):
    return capdedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query
def op11_vector_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return vector_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_fill_in_middle(spark, sf_dir):
    return fim.digest(fim.transform_documents(table(spark, sf_dir, "documents")))


@query
def op13_tokenizer_alignment(spark, sf_dir):
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents")
    aligned = alignment.align_documents(docs, *paths, digest=True)
    return alignment.with_pair_counts(aligned).withColumnRenamed("groups", "groups_sha256")


#: SQL for the queries that SQL can express; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op6_exact_top_k": """
        WITH v AS (
            SELECT DISTINCT vec_id,
                [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
            WHERE a.vec_id % 50 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id
            ) AS rank
            FROM scored
        )
        WHERE rank <= 5
    """,
    "op12_fill_in_middle": """
        WITH units AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), drawn AS (
            SELECT *, CAST(len(unit) AS BIGINT) AS n,
                   CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM units
        ), cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i,
                   greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT doc_id, text, n, form,
                   array_to_string(unit[1:i], '') AS prefix,
                   array_to_string(unit[i + 1:j], '') AS middle,
                   array_to_string(unit[j + 1:], '') AS suffix
            FROM cut
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form
                   WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE text END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
}
