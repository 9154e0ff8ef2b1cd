"""A training-data pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, is written as
Parquet and read again as the next one's documents. All stages but the last
return the columns of documents and drop the rows they reject. A stage learns
what it needs from its own input and the tables of ``sf_dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decision_list, decontamination, language, pieces, setsketch
from quarry.llm.queries import vocabulary
from quarry.llm.spread import small_batches, stage

# A document in which no language has this share of the text is rejected.
LEAST_LANGUAGE = 0.3

# The learned rules and the language model are not expressible in SQL.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the base rules and the learned list."""
    rules = decision_list.learn(docs, _table(spark, sf_dir, "labels"))
    return decision_list.judge(docs, rules).where("kept").select("_row.*")


@small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with letters in which one language leads; the
    language model is learned from the documents with a known language."""
    found = language.identify(docs, language.learn(docs))
    return found.where((F.col("lang") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)).select("_row.*")


@small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: the one with the
    smallest id, once if its row is repeated. Documents without an id are kept
    once for each text that has no other member with an id. An id with several
    texts stands for each of them on its own."""
    heads = setsketch.representatives(docs.select("doc_id", "text"))
    heads = stage(heads.select(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"), F.col("rows").alias("_rows")), "heads")
    same = docs["doc_id"].eqNullSafe(heads["_doc"]) & (F.xxhash64(docs["text"]) == heads["_digest"])
    kept = docs.join(heads, same).drop("_doc")
    if heads.where("_rows > 1").isEmpty():
        return kept.select(docs.columns)
    again = kept.where("_rows > 1").dropDuplicates(["doc_id", "_digest"])
    return kept.where("_rows = 1").unionByName(again).select(docs.columns)


@small_batches
def decontamination_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that are not contaminated by the benchmark."""
    found = decontamination.find(docs, _table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select("_row.*")


@small_batches
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left."""
    return pieces.encode(docs, vocabulary(), carry=["doc_id"]).select("_row.doc_id", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination_),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
