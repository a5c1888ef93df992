"""Training-corpus pipeline over the documents table, five stages of ``tessera.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``; all but the last return
the columns of ``documents``. Lost executors cost at most a part of one stage.

Defined results: a null text counts as empty (and may be rejected for its
quality); null ids pass through all stages; an empty table stays empty; further
columns are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, stage
from tessera.llm.exact_dedup import drop_copies
from tessera.llm.minhash_dedup import drop_near_duplicates
from tessera.llm.mixing import mixed_documents
from tessera.llm.piece_codec import encode_documents
from tessera.llm.quality import good_documents
from tessera.llm.queries import tokenizer_path
from tessera.session import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, gives 0.5 or more."""
    return good_documents(docs, table(spark, sf_dir, "labels"), least=0.5)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return drop_copies(docs, keep="max")


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingle similarity 0.75) the document with the smallest doc_id."""
    return drop_near_duplicates(docs, percent=75)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by weight: a document comes back as often as its text is taken."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids with the end id, their number."""
    return encode_documents(docs, tokenizer_path()).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_one_copy),
    ("near dedup", keep_one_of_similar),
    ("source mixing", mix),
    ("sentencepiece", encode),
]

#: The classifier and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = documents(spark, sf_dir)
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
