"""Helpers that keep hot keys apart and cut lineage on shared storage."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def stage(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and go on from
    the copy: later jobs and repeated tasks read the files, so a lost executor
    costs no more than its own tasks."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/quarry-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of one Arrow batch of whole texts. The batch is held by the executor and
# by its Python worker, once for each task at a time.
ARROW_ROWS = 2_000


def small_batches(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A step on (spark, ...) whose rows reach Python in batches of at most
    ``ARROW_ROWS``. A smaller bound that the session has is kept."""
    @functools.wraps(step)
    def run(spark: SparkSession, *args) -> DataFrame:
        at = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(at)) <= ARROW_ROWS:
            spark.conf.set(at, ARROW_ROWS)
        return step(spark, *args)

    return run


# Bytes of one Arrow batch of rows that hold a block each.
ARROW_BYTES = 8_000_000


@contextmanager
def batches_of(spark: SparkSession, most: int = ARROW_BYTES) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of about ``most``
    bytes, however long the rows are."""
    at = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(at)
    spark.conf.set(at, most)
    try:
        yield
    finally:
        spark.conf.set(at, old)


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], share: int = 1000) -> DataFrame:
    """Inner join of ``left`` with ``right``, which holds each key once.

    A key with more than 1/``share`` of the left rows is split: its left rows
    are dealt over enough salts to bring each below that share, and its right
    row is repeated once per salt. At most ``share`` keys can be that frequent,
    so the table of salts that is broadcast has at most ``share`` rows,
    whatever the input's size. Null keys join nothing. ``left`` is read three
    times and should be a written table. Keys are compared by equality; other
    columns of the two sides must not share names.
    """
    on = list(on)
    sizes = stage(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), "sizes")
    total = sizes.agg(F.sum("_rows")).first()[0] or 0
    hot = sizes.where(F.col("_rows") * share > total).select(
        *on, F.ceil(F.col("_rows") * share / max(total, 1)).cast("int").alias("_salts"))
    rest = [c for c in left.columns if c not in on] or on
    dealt = left.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*rest), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    repeated = right.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return dealt.join(repeated, [*on, "_salt"]).drop("_salt")


# Rows of a table that may be broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", bound: int | None = None) -> DataFrame:
    """Join ``left`` with ``right``, which holds each key once and is written:
    broadcast up to ``bound`` rows (by default ``BROADCAST_ROWS``), else by a
    shuffle whose hot keys are split. Null keys join nothing."""
    bound = BROADCAST_ROWS if bound is None else bound
    if right.limit(bound + 1).count() <= bound:
        return left.join(F.broadcast(right), list(on), how)
    left = stage(left, "looked-up")
    if how == "inner":
        return salted_join(left, right, on)
    rest = [c for c in right.columns if c not in on]
    keys = left.select(*on).distinct().join(right, list(on), "left").select(*on, *rest)
    keyless = left.where(" or ".join(f"`{c}` is null" for c in on))
    keyless = keyless.select(*left.columns, *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rest))
    return salted_join(left, stage(keys, "keys"), on).unionByName(keyless)


def running_totals(df: DataFrame, order: Sequence[str], value: str, keys: Sequence[str] = (), name: str = "before") -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows that come before a row
    of the same ``keys`` in ``order``.

    No key's rows meet in one task: rows are range-partitioned by keys and
    order, summed inside each partition, and one row per (key, partition)
    gives each partition its offset. Rows with equal keys and order follow
    each other in any order. Keys must not be null.
    """
    keys, order = list(keys), list(order)
    cut = stage(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = cut.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")), "offsets")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return lookup(own, base, [*keys, "_part"]).withColumn(name, F.col(name) + F.col("_base")).drop("_part", "_base")
