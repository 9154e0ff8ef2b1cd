"""Registered profiling queries (collection characterisation)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import text as T
from ..operators import prepare as P
from ..operators import profile as PR
from ..sources.tables import Tables
from . import sqlgen as S
from .prepare import _LINK_SQL, _linked
from .registry import register

# The profile's "today" is a parameter (never the wall clock).
TODAY = dt.date(2000, 1, 1)


@register(
    "numeric_summary",
    "SELECT count(c_acctbal) AS n, round(avg(c_acctbal), 4) AS mean, round(median(c_acctbal), 4) AS median, "
    "min(c_acctbal) AS min, max(c_acctbal) AS max FROM customer",
)
def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG7."""
    return PR.numeric_summary(Tables(spark, sf_dir).customer, "c_acctbal")


@register(
    "word_count_summary",
    f"SELECT count(n) AS n, round(avg(n), 4) AS mean, round(median(n), 4) AS median, min(n) AS min, max(n) AS max "
    f"FROM (SELECT CAST({S.word_count(S.strip_markup('text'))} AS BIGINT) AS n FROM documents)",
)
def word_count_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG8: length (words) summary of cleaned texts."""
    d = Tables(spark, sf_dir).documents.select(T.word_count(T.strip_markup("text")).cast("long").alias("n"))
    return PR.numeric_summary(d, "n")


_PART_COLS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@register(
    "field_coverage",
    "WITH w AS (SELECT count(*) AS rows_, "
    "count(*) FILTER (WHERE p_name IS NOT NULL AND trim(p_name) <> '') AS p_name, "
    "count(*) FILTER (WHERE p_brand IS NOT NULL AND trim(p_brand) <> '') AS p_brand, "
    "count(*) FILTER (WHERE p_type IS NOT NULL AND trim(p_type) <> '') AS p_type, "
    "count(*) FILTER (WHERE p_size IS NOT NULL AND p_size <> 0) AS p_size, "
    "count(*) FILTER (WHERE p_retailprice IS NOT NULL) AS p_retailprice FROM part) "
    "SELECT field, present, round(present * 100.0 / rows_, 2) AS pct FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS present, rows_ FROM w" for c in _PART_COLS)
    + ")",
)
def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG18: present = not null / blank / empty / 0, except fields where 0
    is a genuine value (here the price)."""
    return PR.coverage_profile(Tables(spark, sf_dir).part, _PART_COLS, zero_is_value=["p_retailprice"])


def _order_rules(today: dt.date) -> dict:
    return {
        "non_positive_total": F.col("o_totalprice") <= 0,
        "missing_date": F.col("o_orderdate").isNull(),
        "future_date": F.col("o_orderdate") > F.lit(dt.datetime(today.year, today.month, today.day)),
        "pending_status": F.col("o_orderstatus") == "P",
        "blank_priority": F.col("o_orderpriority").isNull() | (F.trim("o_orderpriority") == ""),
        "urgent_priority": F.col("o_orderpriority").startswith("1-"),
        "high_total": F.col("o_totalprice") > 300000,
    }


@register(
    "integrity_audit",
    "SELECT rule, n FROM (SELECT "
    "count(*) FILTER (WHERE o_totalprice <= 0) AS non_positive_total, "
    "count(*) FILTER (WHERE o_orderdate IS NULL) AS missing_date, "
    "count(*) FILTER (WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00') AS future_date, "
    "count(*) FILTER (WHERE o_orderstatus = 'P') AS pending_status, "
    "count(*) FILTER (WHERE o_orderpriority IS NULL OR trim(o_orderpriority) = '') AS blank_priority, "
    "count(*) FILTER (WHERE starts_with(o_orderpriority, '1-')) AS urgent_priority, "
    "count(*) FILTER (WHERE o_totalprice > 300000) AS high_total FROM orders) "
    "UNPIVOT (n FOR rule IN (non_positive_total, missing_date, future_date, pending_status, blank_priority, urgent_priority, high_total))",
)
def integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG19: labelled rule counts in one pass (today is a parameter)."""
    return PR.audit(Tables(spark, sf_dir).orders, _order_rules(TODAY))


_LOWCARD = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@register(
    "low_cardinality",
    "SELECT field, n_distinct FROM (SELECT count(DISTINCT o_orderstatus) AS o_orderstatus, "
    "count(DISTINCT o_orderpriority) AS o_orderpriority, count(DISTINCT o_custkey) AS o_custkey FROM orders) "
    "UNPIVOT (n_distinct FOR field IN (o_orderstatus, o_orderpriority, o_custkey)) WHERE n_distinct <= 3",
)
def low_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG20."""
    return PR.low_cardinality(Tables(spark, sf_dir).orders, _LOWCARD, 3)


@register(
    "corr_and_fit",
    "WITH m AS (SELECT l_orderkey, avg(l_quantity) AS x FROM lineitem GROUP BY l_orderkey), "
    "j AS (SELECT x, o_totalprice AS y FROM m JOIN orders ON o_orderkey = l_orderkey) "
    "SELECT count(*) AS n, round(corr(x, y), 6) AS pearson_r, round(regr_slope(y, x), 6) AS slope, "
    "round(regr_intercept(y, x), 6) AS intercept, round(min(x), 6) AS x_min, round(max(x), 6) AS x_max FROM j",
)
def corr_and_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG9 + AG10: per-parent mean of a child measure vs a parent measure:
    Pearson r and the least-squares line."""
    t = Tables(spark, sf_dir)
    m = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.avg("l_quantity").alias("x"))
    j = m.join(t.orders.select("o_orderkey", F.col("o_totalprice").alias("y")), "o_orderkey")
    return j.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.corr("x", "y"), 6).alias("pearson_r"),
        F.round(F.regr_slope("y", "x"), 6).alias("slope"), F.round(F.regr_intercept("y", "x"), 6).alias("intercept"),
        F.round(F.min("x"), 6).alias("x_min"), F.round(F.max("x"), 6).alias("x_max"),
    )


@register(
    "histogram_bins",
    f"WITH w AS (SELECT CAST({S.word_count('text')} AS BIGINT) AS x FROM documents), "
    "k AS (SELECT x FROM w WHERE x <= 1500), r AS (SELECT min(x) AS mn, max(x) AS mx FROM k) "
    "SELECT bin, count(*) AS n FROM (SELECT CAST(CASE WHEN mx > mn THEN least(floor((x - mn) / CAST(mx - mn AS DOUBLE) * 40) + 1, 40) ELSE 1 END AS INTEGER) AS bin "
    "FROM k, r) GROUP BY bin UNION ALL SELECT 0 AS bin, count(*) AS n FROM w WHERE x > 1500",
)
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG11: 40 equal bins over the data range of values <= 1500, overflow
    count in bin 0."""
    d = Tables(spark, sf_dir).documents.select(T.word_count("text").cast("long").alias("x"))
    return PR.equal_bins(d, "x", 40, 1500)


@register(
    "label_counts",
    "SELECT label, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS label FROM part) "
    "WHERE label <> '' GROUP BY label",
)
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG12: multi-label field split, exploded, counted."""
    p = Tables(spark, sf_dir).part
    return (
        p.select(F.explode(F.split("p_name", " ")).alias("label")).filter(F.col("label") != "")
        .groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    )


@register(
    "value_share_others",
    "WITH c AS (SELECT source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source), "
    "t AS (SELECT sum(n) AS total, count(*) AS k FROM c), "
    "h AS (SELECT * FROM c ORDER BY n DESC, value LIMIT 5), "
    "r AS (SELECT * FROM h UNION ALL SELECT '(others)', total - (SELECT sum(n) FROM h) FROM t WHERE k > 5) "
    "SELECT value, CAST(n AS BIGINT) AS n, round(n / (SELECT total FROM t), 4) AS share FROM r",
)
def value_share_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG13: top-5 values, remainder and shares."""
    return PR.value_share(Tables(spark, sf_dir).documents, "source", 5)


def _decade_label(year, today: dt.date):
    return (
        F.when(year.isNull(), F.lit("invalid date"))
        .when(year > F.lit(today.year), F.lit("future date"))
        .otherwise(F.concat((F.floor(year / 10) * 10).cast("int").cast("string"), F.lit("s")))
    )


@register(
    "decade_distribution",
    "SELECT label, count(*) AS n FROM (SELECT CASE WHEN y IS NULL THEN 'invalid date' WHEN y > 2000 THEN 'future date' "
    "ELSE CAST(CAST(floor(y / 10) * 10 AS INTEGER) AS VARCHAR) || 's' END AS label FROM (SELECT year(o_orderdate) AS y FROM orders)) GROUP BY label",
)
def decade_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG14: decade buckets; years after today's year are 'future date'."""
    o = Tables(spark, sf_dir).orders
    return o.select(_decade_label(F.year("o_orderdate"), TODAY).alias("label")).groupBy("label").agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "coverage_by_decade",
    _LINK_SQL
    + ", pr AS (SELECT CASE WHEN y < 1950 THEN 'Before 1950' ELSE CAST(CAST(floor(y / 10) * 10 AS INTEGER) AS VARCHAR) || 's' END AS period, "
    "l.found AND l.article IS NOT NULL AS ok FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders) o JOIN linked l USING (o_orderkey) WHERE y IS NOT NULL) "
    "SELECT period, count(*) FILTER (WHERE ok) AS linked, count(*) AS total, round(count(*) FILTER (WHERE ok) / count(*), 4) AS rate FROM pr GROUP BY period",
)
def coverage_by_decade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG16: linked share per period ('Before 1950' + decades)."""
    t = Tables(spark, sf_dir)
    y = F.year("o_orderdate")
    o = t.orders.select("o_orderkey", y.alias("y")).filter(F.col("y").isNotNull())
    l = _linked(t).select("o_orderkey", (F.col("found") & F.col("article").isNotNull()).alias("ok"))
    period = F.when(F.col("y") < 1950, F.lit("Before 1950")).otherwise(
        F.concat((F.floor(F.col("y") / 10) * 10).cast("int").cast("string"), F.lit("s"))
    )
    g = o.join(l, "o_orderkey").groupBy(period.alias("period")).agg(
        F.count_if("ok").alias("linked"), F.count(F.lit(1)).alias("total")
    )
    return g.withColumn("rate", F.round(F.col("linked") / F.col("total"), 4))


_LABEL_COV_SQL = (
    "WITH used AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'), "
    "lab AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS label FROM part), "
    "cov AS (SELECT label, count(*) FILTER (WHERE u.l_partkey IS NOT NULL) AS linked, count(*) AS total FROM lab "
    "LEFT JOIN used u ON u.l_partkey = lab.p_partkey WHERE label <> '' GROUP BY label HAVING count(*) >= 100), "
    "rated AS (SELECT label, linked, total, round(linked / total, 4) AS rate FROM cov) "
)


def _label_coverage(t: Tables) -> DataFrame:
    used = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("p_partkey")).distinct()
    flagged = t.part.select("p_partkey", "p_name").join(
        used.withColumn("_u", F.lit(True)), "p_partkey", "left"
    )
    lab = flagged.select(F.explode(F.split("p_name", " ")).alias("label"), F.col("_u").isNotNull().alias("ok")).filter(
        F.col("label") != ""
    )
    g = lab.groupBy("label").agg(F.count_if("ok").alias("linked"), F.count(F.lit(1)).alias("total")).filter(
        F.col("total") >= 100
    )
    return g.withColumn("rate", F.round(F.col("linked") / F.col("total"), 4))


@register("coverage_by_label_having", _LABEL_COV_SQL + "SELECT * FROM rated")
def coverage_by_label_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG17 + JN8: membership flag per entity, coverage per label, HAVING
    total >= 100."""
    return _label_coverage(Tables(spark, sf_dir))


@register(
    "extremes_2x2",
    _LABEL_COV_SQL
    + "SELECT label, rate, 'bottom' AS side FROM (SELECT *, row_number() OVER (ORDER BY rate, label) AS r FROM rated) WHERE r <= 2 "
    "UNION ALL SELECT label, rate, 'top' FROM (SELECT *, row_number() OVER (ORDER BY rate DESC, label) AS r FROM rated) WHERE r <= 2",
)
def extremes_2x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR7: bottom-2 and top-2 of a ranked rate list."""
    cov = _label_coverage(Tables(spark, sf_dir))
    low = cov.orderBy(F.col("rate").asc(), F.col("label").asc()).limit(2).select("label", "rate", F.lit("bottom").alias("side"))
    high = cov.orderBy(F.col("rate").desc(), F.col("label").asc()).limit(2).select("label", "rate", F.lit("top").alias("side"))
    return low.unionByName(high)


@register(
    "conditional_shares",
    "SELECT count(*) AS n, round(avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 4) AS share_returned, "
    "round(avg(CASE WHEN l_quantity > 25 THEN l_discount END), 4) AS mean_discount_large, "
    "round(count(*) FILTER (WHERE l_discount = 0) / count(*), 4) AS share_zero_discount, "
    "round(avg(CASE WHEN l_returnflag IS NOT DISTINCT FROM l_linestatus THEN 1 ELSE 0 END), 4) AS share_equal_flags FROM lineitem",
)
def conditional_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG21 + AG22: equality share (null-safe), conditional mean, zero share."""
    li = Tables(spark, sf_dir).lineitem
    return li.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg((F.col("l_returnflag") == "R").cast("int")), 4).alias("share_returned"),
        F.round(F.avg(F.when(F.col("l_quantity") > 25, F.col("l_discount"))), 4).alias("mean_discount_large"),
        F.round(F.count_if(F.col("l_discount") == 0) / F.count(F.lit(1)), 4).alias("share_zero_discount"),
        F.round(F.avg(F.col("l_returnflag").eqNullSafe(F.col("l_linestatus")).cast("int")), 4).alias("share_equal_flags"),
    )


def _profile_terms_sql(src: str) -> str:
    stop = S.stop_list(config.ANALYZER_STOPWORDS)
    return (
        f"list_filter(regexp_extract_all(lower({src}), {S.q(config.PROFILE_WORD_PATTERN)}), "
        f"lambda t: NOT list_contains({stop}, t) AND length(t) >= 3)"
    )


def _profile_terms(col: str):
    return T.profile_words(col, config.ANALYZER_STOPWORDS, 3)


@register(
    "top_terms",
    f"SELECT term, n, CAST(rank AS INTEGER) AS rank FROM (SELECT term, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, term) AS rank "
    f"FROM (SELECT unnest({_profile_terms_sql('text')}) AS term FROM documents) GROUP BY term) WHERE rank <= 20",
)
def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG23: corpus term frequency (FN16 words, stopword list is a
    parameter), top 20 with ties by term."""
    d = Tables(spark, sf_dir).documents
    tf = PR.term_frequency(d, _profile_terms("text"))
    top = tf.orderBy(F.col("n").desc(), F.col("term").asc()).limit(20)
    # 20 rows: the rank is assigned inside one tiny partition.
    from pyspark.sql import Window

    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("term").asc())))


@register(
    "top_terms_by_label",
    f"SELECT label, term, n, CAST(rank AS INTEGER) AS rank FROM (SELECT label, term, count(*) AS n, "
    f"row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, term) AS rank "
    f"FROM (SELECT lang AS label, unnest({_profile_terms_sql('text')}) AS term FROM documents) GROUP BY label, term) WHERE rank <= 10",
)
def top_terms_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG24: term frequency per label, top 10 per label."""
    d = Tables(spark, sf_dir).documents.select(F.col("lang").alias("label"), "text")
    tf = PR.term_frequency(d, _profile_terms("text"), ["label"])
    return PR.top_n_per(tf, ["label"], 10, [F.col("n").desc(), F.col("term").asc()])


@register(
    "label_volume_top5",
    f"WITH vol AS (SELECT source AS label, count(*) AS docs FROM documents GROUP BY source), "
    f"lt AS (SELECT label, row_number() OVER (ORDER BY docs DESC, label) AS label_rank FROM vol), "
    f"tf AS (SELECT label, term, count(*) AS n FROM (SELECT source AS label, unnest({_profile_terms_sql('text')}) AS term FROM documents) GROUP BY label, term), "
    f"rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, term) AS term_rank FROM tf) "
    f"SELECT label, CAST(label_rank AS INTEGER) AS label_rank, term, n, CAST(term_rank AS INTEGER) AS term_rank "
    f"FROM rk JOIN lt USING (label) WHERE label_rank <= 5 AND term_rank <= 10",
)
def label_volume_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG25: labels ranked by volume, top 5, each with its top-10 terms.
    Only the five chosen labels are tokenized (semi-join before the
    explode)."""
    from pyspark.sql import Window

    d = Tables(spark, sf_dir).documents.select(F.col("source").alias("label"), "text")
    vol = d.groupBy("label").agg(F.count(F.lit(1)).alias("docs"))
    top = vol.orderBy(F.col("docs").desc(), F.col("label").asc()).limit(5)
    top = top.withColumn("label_rank", F.row_number().over(Window.orderBy(F.col("docs").desc(), F.col("label").asc())))
    chosen = F.broadcast(top.select("label", "label_rank"))
    tf = PR.term_frequency(d.join(chosen.select("label"), "label", "left_semi"), _profile_terms("text"), ["label"])
    ranked = PR.top_n_per(tf, ["label"], 10, [F.col("n").desc(), F.col("term").asc()], "term_rank")
    return ranked.join(chosen, "label").select("label", "label_rank", "term", "n", "term_rank")


@register(
    "vocab_size",
    f"SELECT count(DISTINCT t) AS n_terms FROM (SELECT unnest(regexp_extract_all(lower(text), {S.q(config.TOKEN_PATTERN)})) AS t "
    f"FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations))",
)
def vocab_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG35: distinct case-folded word forms over two text tables."""
    t = Tables(spark, sf_dir)
    texts = t.documents.select("text").unionByName(t.conversations.select("text"))
    toks = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(config.TOKEN_PATTERN), 0)).alias("t"))
    return toks.agg(F.count_distinct("t").alias("n_terms"))
