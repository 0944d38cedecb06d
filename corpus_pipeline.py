"""A training corpus from the table of documents: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
one's docs. All but the last return the columns of documents, empty tables included. Extra columns of
documents pass through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkatlas.llm import bpe, minhash, mixing, quality, secrets
from chunkatlas.llm.queries import tokenizer
from chunkatlas.session import materialize, prepare


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the statistics and the ratio of good to raw n-grams; all others go."""
    prepare(spark)
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return quality.keep_good(docs, trusted)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingle sets with a similarity of 0.8 or more link."""
    prepare(spark)
    return minhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and n_chars counted anew."""
    prepare(spark)
    return secrets.redacted(docs, repository=F.concat_ws("/", "source", "lang"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target says; the copies are equal rows."""
    prepare(spark)
    return mixing.mix(docs, mixing.word_count(F.col("text")))


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each row."""
    prepare(spark)
    encoded = bpe.encode(docs, tokenizer())
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("secret scan", secret_scan),
    ("mixing", mix_sources),
    ("bpe", encode_text),
]

#: Hashes and the tokenizer are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
