"""Parquet table access for a scale-factor folder.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers select only what they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Tables whose rows carry long text and get per-row regex work.
TEXT_TABLES = ("documents", "pages", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Give per-row text work at least one task per core. A large input
    already has many splits and is returned unchanged; a small file with a
    single row group (one split) is redistributed round-robin. Steps that
    filter on expensive text expressions wrap them with ``materialize`` so
    the filter is not pushed back into the single scan task."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def materialize(df: DataFrame, **exprs) -> DataFrame:
    """Return ``df`` (plus the named expressions) as generator output.
    Later filters and projections refer to the produced columns instead of
    re-evaluating (or pushing down) the expressions, so an expensive value
    such as a cleaned text is computed once per row."""
    cols = [F.col(c) for c in df.columns if c not in exprs] + [e.alias(n) for n, e in exprs.items()]
    return df.select(F.inline(F.array(F.struct(*cols))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if name in TEXT_TABLES:
        df = spread(df)
    return df


class Tables:
    """Attribute access to the tables of one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
