"""Collection profiling: summaries, coverage, audits, distributions, term
frequencies.

Every profile is one or two aggregate jobs. Counts that feed a ratio are
computed by partial aggregation; top-n lists use ``orderBy().limit()``
(distributed top-k) or ``row_number() <= n`` (WindowGroupLimit); nothing
is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numeric_summary(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """AG7: n / mean / median / min / max, nulls ignored."""
    c = F.col(col)
    return df.agg(
        F.count(c).alias("n"),
        F.round(F.avg(c), digits).alias("mean"),
        F.round(F.median(c), digits).alias("median"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def coverage_profile(df: DataFrame, cols: Sequence[str], zero_is_value: Iterable[str] = (),
                     digits: int = 2) -> DataFrame:
    """AG18: per field, rows where it is present and the percentage.
    Present = not null, not blank, not an empty array, not 0 (except the
    ``zero_is_value`` columns, where 0 is a genuine value). One pass."""
    zero_ok = set(zero_is_value)
    types = dict(df.dtypes)
    preds: dict[str, Column] = {}
    for c in cols:
        x = F.col(c)
        t = types[c]
        p = x.isNotNull()
        if t == "string":
            p = p & (F.trim(x) != F.lit(""))
        elif t.startswith("array"):
            p = p & (F.size(x) > F.lit(0))
        elif c not in zero_ok and t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal"):
            if c not in zero_ok:
                p = p & (x != F.lit(0))
        preds[c] = p
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(p).alias(c) for c, p in preds.items()]
    wide = df.agg(*aggs)
    stack = "stack({n}, {pairs}) AS (field, present)".format(
        n=len(cols), pairs=", ".join(f"'{c}', `{c}`" for c in cols)
    )
    return wide.selectExpr("_rows", stack).select(
        "field", "present", F.round(F.col("present") * 100.0 / F.col("_rows"), digits).alias("pct")
    )


def audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """AG19: labelled predicate counts in one pass; a row may hit several."""
    wide = df.agg(*[F.count_if(p).alias(f"r{i}") for i, p in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, n)")


def low_cardinality(df: DataFrame, cols: Sequence[str], max_distinct: int = 3,
                    approx: bool = False) -> DataFrame:
    """AG20: columns with at most ``max_distinct`` distinct non-null values."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(*[fn(F.col(c)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (field, n_distinct)").filter(
        F.col("n_distinct") <= max_distinct
    )


def equal_bins(df: DataFrame, col: str, bins: int = 40, cap: float | None = None) -> DataFrame:
    """AG11: ``bins`` equal-width bins spanning the data min..max of values
    <= cap (last bin closed); values above ``cap`` are counted in bin 0.
    (bin, n). Two passes: the range, then one pass that bins every value
    (overflow included)."""
    x = F.col(col)
    body = df.filter(x.isNotNull())
    kept = body.filter(x <= F.lit(cap)) if cap is not None else body
    rng = kept.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx")).withColumn("_k", F.lit(1))
    width = (F.col("_mx") - F.col("_mn")).cast("double")
    b = F.least(F.floor((x - F.col("_mn")) / width * F.lit(bins)) + F.lit(1), F.lit(bins)).cast("int")
    b = F.when(width > 0, b).otherwise(F.lit(1))
    if cap is not None:
        b = F.when(x > F.lit(cap), F.lit(0)).otherwise(b)
    binned = body.withColumn("_k", F.lit(1)).join(F.broadcast(rng), "_k").select(b.alias("bin"))
    out = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    if cap is not None:
        # bin 0 is reported even when nothing overflows
        zero = df.sparkSession.createDataFrame([(0, 0)], "bin int, n bigint")
        out = out.unionByName(zero).groupBy("bin").agg(F.sum("n").alias("n"))
    return out


def value_share(df: DataFrame, col: str, top: int = 5, others: str = "(others)",
                digits: int = 4) -> DataFrame:
    """AG13: the ``top`` most frequent values (count desc, value asc), one
    remainder row, and each row's share of all non-null rows."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    head = counts.orderBy(F.col("n").desc(), F.col("value").asc()).limit(top)
    total = counts.agg(F.sum("n").alias("_total"), F.count(F.lit(1)).alias("_values"))
    head_sum = head.agg(F.sum("n").alias("_head"))
    rest = total.join(F.broadcast(head_sum), how="inner").filter(F.col("_values") > top).select(
        F.lit(others).alias("value"), (F.col("_total") - F.col("_head")).alias("n")
    )
    rows = head.unionByName(rest)
    return rows.join(F.broadcast(total.select("_total")), how="inner").select(
        "value", "n", F.round(F.col("n") / F.col("_total"), digits).alias("share")
    )


def term_frequency(df: DataFrame, terms: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by..., term, n): occurrences of each term (AG23/AG24)."""
    return df.select(*by, F.explode(terms).alias("term")).groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n"))


def top_n_per(df: DataFrame, part: Sequence[str], n: int, order: Sequence[Column],
              rank_col: str = "rank") -> DataFrame:
    """Top ``n`` rows per partition with a total order (WindowGroupLimit)."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= F.lit(n))


def against_reference(counts: DataFrame, reference: DataFrame, label: str) -> DataFrame:
    """JN13: (label, n, reference, diff): counts next to those of a reference
    table; labels that the reference lacks count 0 there, labels that only it
    has are left out."""
    known = F.coalesce(F.col("reference"), F.lit(0))
    return counts.join(reference, label, "left").select(label, "n", known.alias("reference"), (F.col("n") - known).alias("diff"))
