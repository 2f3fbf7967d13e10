"""A corpus pipeline of five stages; each function takes (spark, docs, folder of tables) and returns a DataFrame.

All stages but the last return the columns of documents. Language and benchmark judge rows one by one. A row without doc_id
is near nothing and stays; rows that share a doc_id are taken into the mix alike, as often as the most taken of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch
from ledgerspark.llm.decontaminate import clean_documents
from ledgerspark.llm.jaccard import near_duplicates
from ledgerspark.llm.language import in_known_language
from ledgerspark.llm.mixing import mix_sources
from ledgerspark.llm.token_files import token_digest


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps documents in a language: text with letters that some learned language writes in fewer than the 8 bits a byte
    of plain storage."""
    return in_known_language(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate class."""
    later = near_duplicates(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("_later")).distinct()
    return docs.join(later, docs["doc_id"] == F.col("_later"), "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return clean_documents(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeats each document as often as the mix takes it."""
    mixed = mix_sources(docs).where("copies > 0").groupBy(F.col("doc_id").alias("_taken")).agg(F.max("copies").alias("_copies"))
    taken = docs.join(mixed, docs["doc_id"].eqNullSafe(F.col("_taken"))).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return taken.select(*(docs[name] for name in docs.columns))


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Writes the mix as token ids and returns the digest read back from the files."""
    import public_tokenizers

    return token_digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_each_group),
    ("benchmark", without_benchmark),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

# Language models and tokenizers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again before the next one."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.store(f"stage-{number}", stage(spark, docs, folder))
    return docs
