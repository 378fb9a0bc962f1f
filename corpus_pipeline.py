"""A training-data pipeline over the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid, minhash, packing, pii, toxicity
from tidemark.workspace import new_folder


#: The session's setting that holds the key of surrogates.
PII_KEY = "spark.tidemark.pii.key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows not predicted toxic, by a classifier of the labelled ones. Null and empty texts
    score as the bias alone; repeated rows go together; no rows give no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in one of the languages that the table names. Texts that are
    null or have no letter go; repeated rows go together; no rows give no rows.
    """
    return langid.drop_unidentified(docs, langid.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that share 80 in 100 of their five-word shingles."""
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with surrogates in place of personal data."""
    return pii.pseudonymise(docs, spark.conf.get(PII_KEY, "no key is set"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row with its sequence and offset. Null and empty texts
    are one piece of one id; repeated rows are packed each; no rows give no rows.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_languages),
    ("minhash_near_dedup", drop_near_copies),
    ("pii_surrogates", replace_personal_data),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


#: The stages train models and link near copies, which SQL cannot express.
ORACLE_SQL = None
