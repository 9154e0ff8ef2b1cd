"""Cleaning, de-duplication, ordered lists and identifier linking.

Scale notes
-----------
* First/last-wins de-duplication is a min/max over a struct whose first
  field is the ordering key. It is an ordinary aggregate, so Spark combines
  map-side: a key holding a third of the rows ships one row per map task.
* Positions inside a group (``positional_index``) do not use a window
  partitioned by the group key (one task per key). Rows are range-
  partitioned on (key, order), numbered inside each partition and written
  once; a small per-(key, partition) count table of that copy provides the
  offset of each slice, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import stage


def first_wins(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
               keep: Sequence[str] | None = None, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``. ``order`` must make
    rows of one key unique for a deterministic result."""
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    keep = [c for c in (keep if keep is not None else df.columns) if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + keep]).alias("_w")
    agg = F.max(packed) if last else F.min(packed)
    out = df.groupBy(*key).agg(agg.alias("_w"))
    return out.select(*key, *[F.col(f"_w.{c}").alias(c) for c in order + keep])


def last_wins(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
              keep: Sequence[str] | None = None) -> DataFrame:
    return first_wins(df, key, order, keep, last=True)


def positional_index(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
                     pos_col: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position of each row inside its key group, following
    ``order`` (which must be unique within a key).

    Skew-safe: no single task ever holds a whole group (see module doc). The
    numbered rows are written once and both the slice counts and the positions
    are taken from that copy: a second evaluation of the range exchange may
    choose other bounds. Null keys form a group of their own.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *[F.col(c) for c in key + order])
        .sortWithinPartitions(*key, *order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = stage(ranged, "ranged")
    # One row per (key, partition slice): rows per slice and its first id.
    slices = ranged.groupBy(*key, "_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first")
    )
    w = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    slices = slices.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_pid").alias("_slice"), "_first", "_off")
    same = ranged["_pid"] == slices["_slice"]
    for i, k in enumerate(key):
        same = same & ranged[k].eqNullSafe(slices[f"_k{i}"])
    out = ranged.join(slices, same)
    return out.select(*[ranged[c] for c in df.columns], (F.col("_off") + F.col("_mid") - F.col("_first")).alias(pos_col))


def first_occurrence_distinct(df: DataFrame, key: Sequence[str] | str, value: str,
                              order: Sequence[str] | str, pos_col: str = "pos") -> DataFrame:
    """AG2: distinct values per key in order of first occurrence, as
    (key, value, pos). The (key, value) reduction is a partial aggregate."""
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    firsts = df.groupBy(*key, value).agg(F.min(F.struct(*order)).alias("_first"))
    firsts = firsts.select(*key, value, *[F.col(f"_first.{c}").alias(c) for c in order])
    return positional_index(firsts, key, order + [value], pos_col).drop(*order)


def nested_list(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
                fields: Sequence[str], name: str = "items") -> DataFrame:
    """AG1/AG3/AG5: one array<struct> per key in ``order``. This materialises
    a whole group in one row, so use it for display-sized groups (documents
    with their child records); the long form is ``positional_index``."""
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in fields])
    arr = F.array_sort(F.collect_list(packed))
    return df.groupBy(*key).agg(
        F.transform(arr, lambda s: F.struct(*[s[c].alias(c) for c in fields])).alias(name)
    )


def two_pass_link(entities: DataFrame, key: str, primary: DataFrame, primary_id: str,
                  secondary: DataFrame, secondary_id: str) -> DataFrame:
    """JN6: resolve each entity through a primary id, then through a
    secondary id for rows unresolved or resolved without an article.

    ``entities``: (key, primary_id, secondary_id).
    ``primary``/``secondary``: (id, article) with article null = item without
    article; ids unique (de-duplicate with ``last_wins`` first).
    Output: (key, found_primary, article, match_method) where match_method is
    'primary', 'secondary' or null.
    """
    p = primary.select(F.col(primary_id).alias("_pid"), F.col("article").alias("_pa"), F.lit(True).alias("_pf"))
    s = secondary.select(F.col(secondary_id).alias("_sid"), F.col("article").alias("_sa"), F.lit(True).alias("_sf"))
    j = (
        entities.join(p, entities[primary_id] == p["_pid"], "left")
        .join(s, entities[secondary_id] == s["_sid"], "left")
    )
    p_found = F.coalesce(F.col("_pf"), F.lit(False))
    s_found = F.coalesce(F.col("_sf"), F.lit(False))
    p_ok = F.col("_pa").isNotNull()
    need_second = ~p_found | ~p_ok
    use_second = need_second & s_found & (F.col("_sa").isNotNull() | ~p_found)
    return j.select(
        F.col(key),
        (p_found | s_found).alias("found"),
        F.when(use_second, F.col("_sa")).otherwise(F.col("_pa")).alias("article"),
        F.when(use_second, F.lit("secondary")).when(p_found, F.lit("primary")).alias("match_method"),
    )


def unmatched_reason(linked: DataFrame) -> Column:
    """JN7: 'no_item' when nothing was found, 'no_article' when an item has no
    article, null when linked."""
    return (
        F.when(~F.col("found"), F.lit("no_item"))
        .when(F.col("article").isNull(), F.lit("no_article"))
    )


def joined_list(items: Column, name_field: str = "name", detail_field: str | None = None,
                sep: str = "; ") -> Column:
    """AG4: ``Name (Detail)`` or bare ``Name`` entries of an ordered
    array<struct> joined with ``sep`` (the legacy string form; keep the
    array for anything downstream)."""
    def fmt(x: Column) -> Column:
        if detail_field is None:
            return x[name_field]
        return F.when(x[detail_field].isNotNull() & (x[detail_field] != F.lit("")),
                      F.concat(x[name_field], F.lit(" ("), x[detail_field], F.lit(")"))).otherwise(x[name_field])

    return F.array_join(F.transform(items, fmt), sep)
