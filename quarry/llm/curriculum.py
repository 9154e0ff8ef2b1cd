"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule: knots (t, weight) over the training time 0
to 1, linear in between. Its integral is the source's share of the words to
mix; a source gives at most a fixed number of repeats of its own words, and
what it cannot give is shared again by weight among the others. A source's
demand at time t is its target times the part of its schedule's integral that
lies before t. Its documents stand in a seeded random order, repeated from the
start when the target exceeds the source, so the words before a document copy
are a running total; the time at which the source's demand reaches the middle
of the copy is the copy's training position, found by inverting the demand.
Range-sorting all copies by position gives the training order.

Everything is DataFrame expressions. Running totals never gather a source in
one task (see ``spread.running_totals``), and the table of sources is
broadcast only after its rows have been counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spread import lookup, running_totals, stage

WORD = r"[^\x20\x09-\x0D]+"


def _source(source: str) -> list[Column]:
    """A null source is one of its own, after all others."""
    return [F.col(source).isNull().alias("_null"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source")]


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """One written row per document: _row (unique), key, source, number of
    words, and the place in the seeded random order."""
    words = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    return stage(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), *_source(source), words.alias("size"), order.alias("_order")), "sizes")


def sources_of(measured: DataFrame) -> DataFrame:
    """(_null, _source, source_size), one written row per source."""
    return stage(measured.groupBy("_null", "_source").agg(F.sum("size").alias("source_size")), "sources")


def cycle(sources: DataFrame, schedules: Sequence[Sequence[tuple[float, float]]]) -> DataFrame:
    """Give the sources, by code point and null last, the schedules in turn."""
    placed = running_totals(sources.withColumn("_one", F.lit(1).cast("long")), ["_null", "_source"], "_one", name="_place").drop("_one")
    several = F.array(*(F.array(*(F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in s)) for s in schedules))
    return placed.withColumn("knots", several[(F.col("_place") % len(schedules)).cast("int")]).drop("_place")


def integrated(scheduled: DataFrame) -> DataFrame:
    """Add ``pieces``, the schedule's segments with the integral before each,
    and ``weight``, the whole integral."""
    piece = """transform(sequence(1, size(knots) - 1), i -> named_struct('t', knots[i - 1].t, 'span', knots[i].t - knots[i - 1].t,
        'w', knots[i - 1].w, 'rise', knots[i].w - knots[i - 1].w, 'area', (knots[i].t - knots[i - 1].t) * (knots[i].w + knots[i - 1].w) / 2))"""
    summed = """transform(_pieces, (p, i) -> named_struct('t', p.t, 'span', p.span, 'w', p.w, 'rise', p.rise, 'area', p.area,
        'before', aggregate(slice(_pieces, 1, i), 0D, (s, q) -> s + q.area)))"""
    return scheduled.withColumn("_pieces", F.expr(piece)).withColumn("pieces", F.expr(summed)).withColumn(
        "weight", F.expr("aggregate(_pieces, 0D, (s, q) -> s + q.area)")).drop("_pieces", "knots")


def targets(weighted: DataFrame, share: float, repeats: float) -> DataFrame:
    """Add ``target``: the sources share ``share`` times all words by weight,
    none above ``repeats`` times its own size, the excess being reshared.

    Sources fill up in the order of size by weight. With all earlier ones full,
    the words left per weight left is the level at which a source would stand;
    the first source whose limit is not below its level ends the filling.
    """
    rows = stage(weighted.withColumn("_limit", F.lit(float(repeats)) * F.col("source_size")).withColumn(
        "_fills", F.when(F.col("weight") > 0, F.col("_limit") / F.col("weight")).otherwise(F.lit(float("inf")))), "weights")
    order = ["_fills", "_null", "_source"]
    rows = running_totals(running_totals(rows, order, "_limit", name="_full"), order, "weight", name="_used")
    rows = stage(rows, "filling")
    words, weight = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = float(share) * (words or 0)
    level = F.try_divide(F.lit(budget) - F.col("_full"), F.lit(float(weight or 0)) - F.col("_used"))
    open_ = rows.where((F.col("weight") > 0) & (F.col("_fills") > level))
    first = open_.agg(F.min(F.struct(*order, level.alias("level")))["level"]).first()[0]
    if first is None:  # every source is full
        target = F.when(F.col("weight") > 0, F.col("_limit")).otherwise(F.lit(0.0))
    else:
        target = F.least(F.col("_limit"), F.lit(first) * F.col("weight"))
    return stage(rows.withColumn("target", target).select("_null", "_source", "source_size", "weight", "pieces", "target"), "targets")


def _time_of(demanded: str) -> Column:
    """The time at which the schedule's integral reaches ``demanded``: the last
    segment that starts below it, and the root of that segment's parabola. The
    form with the root in the denominator also holds for level segments."""
    own = f"element_at(filter(pieces, p -> p.before <= {demanded} and p.area > 0), -1)"
    return F.expr(f"""transform(array({own}), p -> p.t + least(p.span, 2 * ({demanded} - p.before)
        / (p.w + sqrt(greatest(p.w * p.w + 2 * p.rise * ({demanded} - p.before) / p.span, 0D)))))[0]""")


def mix(measured: DataFrame, planned: DataFrame) -> DataFrame:
    """All copies of documents in training order: _row, _key, source columns,
    size, source_size, target, copy, words and position.

    ``measured`` is from ``sizes``, ``planned`` from ``targets``. A source's
    copies fill its target, rounded to whole words; the copy that reaches it
    is cut to the words that are left. A document of which nothing is taken
    has one row without a copy, after all others.
    """
    placed = running_totals(measured, ["_order", "_key", "_row"], "size", ["_null", "_source"], name="_start")
    both = lookup(placed, planned, ["_null", "_source"])
    both = both.withColumn("_take", F.floor(F.col("target") + 0.5).cast("long"))
    copies = """filter(transform(sequence(0L, greatest(cast(ceil(_take / greatest(source_size, 1L)) as bigint) - 1L, 0L)), c -> named_struct(
        'copy', cast(c as int), 'from', c * source_size + _start, 'words', least(size, _take - c * source_size - _start))), x -> x.words > 0)"""
    out = both.withColumn("_copies", F.expr(copies)).select("*", F.explode_outer("_copies").alias("_c"))
    out = out.withColumn("_demanded", (F.col("_c.from") + F.col("_c.words") / 2) / F.col("_take") * F.col("weight"))
    out = out.select("_row", "_key", "_null", "_source", "size", "source_size", "target", "_order", F.col("_c.copy").alias("copy"), F.col("_c.words").alias("words"),
                     F.when(F.col("_c").isNotNull(), _time_of("_demanded")).alias("position"))
    order = [F.col("position").asc_nulls_last(), F.col("_order"), F.col("_row"), F.col("copy")]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).drop("_order")


def plan(docs: DataFrame, schedules: Sequence[Sequence[tuple[float, float]]], share: float = 1.5, repeats: float = 2.0,
         key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """``mix`` of a documents table whose sources take the schedules in turn.

    Sizes count runs of characters other than space and U+0009-U+000D; a null
    or empty text has none and is never taken. Null sources are one source,
    the last; null keys share one place in the random order and are told apart
    by row. Repeated rows are documents of their own. Without words all
    targets are 0; an empty table gives no rows. The same table and seed give
    the same words of the same documents.
    """
    measured = sizes(docs, key, text, source, seed)
    return mix(measured, targets(integrated(cycle(sources_of(measured), schedules)), share, repeats))
