"""From raw documents to packed training sequences: toxicity, language, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir), reads what the stage before kept, and returns a DataFrame; all but
the last return the columns of documents. Each row has its own verdict, also where its doc_id is null or repeated.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.llm import langid, toxicity
from helio.llm.common import keep_rows, shared_folder
from helio.llm.exact_dedup import exact_dedup
from helio.llm.minhash import near_dedup, text_sha
from helio.llm.packing import pack_documents

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC, LEAST_LANGUAGE = 0.7, 0.3
#: SQL can't express the trained stages; tests hold run() against the stages' operators and brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below TOXIC; the model learns from the labelled ones."""
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    return _keep_scored(docs, toxicity.score, model, f"score < {TOXIC}")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known, at a mean marginal of at least LEAST_LANGUAGE; texts without letters go."""
    docs = docs.select(*COLUMNS)
    return _keep_scored(docs, langid.identify, langid.train(docs), f"lang_pred <> 'und' AND score >= {LEAST_LANGUAGE}")


def _keep_scored(docs: DataFrame, operator, model, condition: str) -> DataFrame:
    return operator(docs, model, carry=COLUMNS[1:]).where(condition).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: one with the least id."""
    docs = docs.select(*COLUMNS)
    return exact_dedup(docs, carry=COLUMNS[1:]).where("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words a shingle, similarity 0.8): one with the least id."""
    docs = docs.select(*COLUMNS)
    return keep_rows(docs, near_dedup(docs).where("kept"), text_sha(F.col("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 1024 tokens."""
    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
