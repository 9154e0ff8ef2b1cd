"""Registered preparation queries: cleaning, de-duplication, ordered lists,
nested parent/child blocks, identifier linking, safe casts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import prepare as P
from ..sources.tables import Tables, materialize
from . import sqlgen as S
from .registry import register


def _clean_docs(t: Tables) -> DataFrame:
    d = materialize(t.documents.select("doc_id", "text"), clean=T.strip_markup("text")).drop("text")
    return d.select("doc_id", "clean", T.word_count("clean").cast("long").alias("n_words"))


@register(
    "clean_text_markup",
    f"SELECT doc_id, md5(clean) AS clean_md5, CAST({S.word_count('clean')} AS BIGINT) AS n_words, "
    f"CAST(length(clean) AS BIGINT) AS clean_chars FROM (SELECT doc_id, {S.strip_markup('text')} AS clean FROM documents)",
)
def clean_text_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN1-FN3: markup stripped, words counted; the cleaned text is compared
    through its md5."""
    d = _clean_docs(Tables(spark, sf_dir))
    return d.select("doc_id", F.md5("clean").alias("clean_md5"), "n_words",
                    F.length("clean").cast("long").alias("clean_chars"))


@register(
    "clean_dedupe_first",
    f"SELECT min(doc_id) AS doc_id, CAST(min(n_words) AS BIGINT) AS n_words FROM ("
    f"SELECT doc_id, clean, {S.word_count('clean')} AS n_words FROM (SELECT doc_id, {S.strip_markup('text')} AS clean FROM documents)) "
    f"WHERE n_words >= 20 GROUP BY sha256(clean)",
)
def clean_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF3 + WR2: texts of >= 20 words after cleaning; exact duplicates of the
    cleaned text keep the first document (lowest id). The duplicate key is
    the SHA-256 digest, so the shuffle carries 32 bytes instead of the text."""
    d = _clean_docs(Tables(spark, sf_dir)).filter(F.col("n_words") >= 20)
    d = d.withColumn("digest", F.sha2("clean", 256))
    return P.first_wins(d, "digest", "doc_id", keep=["n_words"]).select("doc_id", "n_words")


@register(
    "first_order_per_customer",
    "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM ("
    "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn "
    "FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1",
)
def first_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR1: first-wins per key after the row filter (a filtered-out first row
    never suppresses a later valid one)."""
    o = Tables(spark, sf_dir).orders.filter(F.col("o_orderstatus") != "P")
    return P.first_wins(o, "o_custkey", ["o_orderdate", "o_orderkey"], keep=["o_totalprice"])


@register(
    "dedupe_last_wins",
    "SELECT user_id, ts, event_id, event_type, value FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def dedupe_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR3: last row wins per key."""
    e = Tables(spark, sf_dir).events
    return P.last_wins(e, "user_id", ["ts", "event_id"], keep=["event_type", "value"])


@register(
    "semi_filter_children",
    "SELECT o_orderkey, o_custkey FROM orders o WHERE EXISTS "
    "(SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)",
)
def semi_filter_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1: child rows whose parent survived the parent filter (left semi)."""
    t = Tables(spark, sf_dir)
    kept = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(kept, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@register(
    "anti_unmatched",
    "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)",
)
def anti_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN4: parents without any child row (left anti)."""
    t = Tables(spark, sf_dir)
    return t.customer.select("c_custkey").join(
        t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti"
    )


def _linked(t: Tables) -> DataFrame:
    """Orders resolved through their customer (article = name when the
    balance is positive), falling back to the supplier with the same key."""
    primary = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("article"))
    secondary = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("article"))
    ents = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_custkey").alias("s_suppkey"))
    return P.two_pass_link(ents, "o_orderkey", primary, "c_custkey", secondary, "s_suppkey")


_LINK_SQL = (
    "WITH p AS (SELECT c_custkey AS pid, CASE WHEN c_acctbal > 0 THEN c_name END AS pa FROM customer), "
    "s AS (SELECT s_suppkey AS sid, CASE WHEN s_acctbal > 0 THEN s_name END AS sa FROM supplier), "
    "j AS (SELECT o_orderkey, p.pid IS NOT NULL AS pf, pa, s.sid IS NOT NULL AS sf, sa FROM orders "
    "LEFT JOIN p ON o_custkey = p.pid LEFT JOIN s ON o_custkey = s.sid), "
    "k AS (SELECT *, (NOT pf OR pa IS NULL) AND sf AND (sa IS NOT NULL OR NOT pf) AS use2 FROM j), "
    "linked AS (SELECT o_orderkey, pf OR sf AS found, CASE WHEN use2 THEN sa ELSE pa END AS article, "
    "CASE WHEN use2 THEN 'secondary' WHEN pf THEN 'primary' END AS match_method FROM k) "
)


@register("two_pass_link", _LINK_SQL + "SELECT * FROM linked")
def two_pass_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN6: primary id lookup, secondary lookup for unresolved rows or rows
    resolved without an article; the fallback wins when it has an article or
    the primary found nothing."""
    return _linked(Tables(spark, sf_dir))


@register(
    "unmatched_kinds",
    _LINK_SQL + "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN NOT found THEN 'no_item' "
    "WHEN article IS NULL THEN 'no_article' END AS reason FROM linked) WHERE reason IS NOT NULL GROUP BY reason",
)
def unmatched_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN7 + UN4: unmatched rows classified as no item / item without
    article."""
    linked = _linked(Tables(spark, sf_dir))
    return (
        linked.select(P.unmatched_reason(linked).alias("reason"))
        .filter(F.col("reason").isNotNull())
        .groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    )


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register(
    "ordered_list_positions",
    "SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY "
    + ", ".join(_LINE_ORDER) + ") - 1 AS INTEGER) AS pos, l_linenumber, l_partkey, l_suppkey FROM lineitem",
)
def ordered_list_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR4 / AG1 / AG3 long form: each child's position in its parent's
    ordered list, computed without a per-parent task."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", *_LINE_ORDER)
    return P.positional_index(li, "l_orderkey", _LINE_ORDER).select(
        "l_orderkey", "pos", "l_linenumber", "l_partkey", "l_suppkey"
    )


@register(
    "distinct_first_list",
    "WITH f AS (SELECT * FROM (SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, row_number() OVER "
    "(PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1) "
    "SELECT l_orderkey, l_returnflag, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, "
    "l_suppkey, l_returnflag) - 1 AS INTEGER) AS pos FROM f",
)
def distinct_first_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG2: distinct values per parent in first-occurrence order."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey")
    return P.first_occurrence_distinct(
        li, "l_orderkey", "l_returnflag", ["l_linenumber", "l_partkey", "l_suppkey"]
    ).select("l_orderkey", "l_returnflag", "pos")


@register(
    "nested_blocks",
    "SELECT 'order-' || CAST(o_orderkey AS VARCHAR) AS id, 'parent' AS doc_type, CAST(NULL AS VARCHAR) AS parent_id, "
    "CAST(NULL AS INTEGER) AS child_index FROM orders UNION ALL "
    "SELECT 'order-' || CAST(l_orderkey AS VARCHAR) || '-item-' || CAST(pos AS VARCHAR), 'child', "
    "'order-' || CAST(l_orderkey AS VARCHAR), pos FROM (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY "
    + ", ".join(_LINE_ORDER) + ") - 1 AS INTEGER) AS pos FROM lineitem)",
)
def nested_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ND4 + UN5 + FN23: parent rows and child rows (with parent id and
    index) in one heterogeneous table."""
    t = Tables(spark, sf_dir)
    parents = t.orders.select(
        T.composite_key("order", "o_orderkey").alias("id"), F.lit("parent").alias("doc_type"),
        F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("int").alias("child_index"),
    )
    kids = P.positional_index(t.lineitem.select("l_orderkey", *_LINE_ORDER), "l_orderkey", _LINE_ORDER)
    children = kids.select(
        T.composite_key("order", "l_orderkey", "item", "pos").alias("id"), F.lit("child").alias("doc_type"),
        T.composite_key("order", "l_orderkey").alias("parent_id"), F.col("pos").alias("child_index"),
    )
    return parents.unionByName(children)


@register(
    "nested_child_counts",
    "WITH c AS (SELECT o.o_orderkey, count(l.l_orderkey) AS n FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey) "
    "SELECT count(*) AS parents, count(*) FILTER (WHERE n = 0) AS parents_without_children, "
    "CAST(sum(n) AS BIGINT) AS children, round(avg(n), 4) AS mean_children, round(median(n), 4) AS median_children, "
    "max(n) AS max_children FROM c",
)
def nested_child_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG5/AG26/AG28: children per parent incl. parents with none; counts
    come from a partial aggregate of the children, then one left join."""
    t = Tables(spark, sf_dir)
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    c = t.orders.select("o_orderkey").join(per, "o_orderkey", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return c.agg(
        F.count(F.lit(1)).alias("parents"),
        F.count_if(F.col("n") == 0).alias("parents_without_children"),
        F.sum("n").cast("long").alias("children"),
        F.round(F.avg("n"), 4).alias("mean_children"),
        F.round(F.median("n"), 4).alias("median_children"),
        F.max("n").alias("max_children"),
    )


@register(
    "placeholder_nulls",
    f"SELECT event_id, {S.safe_long('k', True)} AS k_int, {S.safe_double('k')} AS k_double, "
    f"CASE WHEN value > 0 THEN value END AS value_pos, regexp_full_match(trim(k), '[0-9]+') AS k_is_id "
    f"FROM (SELECT event_id, value, regexp_extract(props, '\"k\":\\s*([^,}}]*)', 1) AS k FROM events)",
)
def placeholder_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN4-FN6 + PF4: safe numeric parsing of a JSON payload field, 0 and
    non-positive placeholders to null, numeric-id check."""
    e = Tables(spark, sf_dir).events
    k = F.regexp_extract("props", r'"k":\s*([^,}]*)', 1)
    return e.select("event_id", "value", k.alias("k")).select(
        "event_id",
        T.safe_long("k", zero_to_null=True).alias("k_int"),
        T.safe_double("k").alias("k_double"),
        F.when(F.col("value") > 0, F.col("value")).alias("value_pos"),
        F.trim("k").rlike("^[0-9]+$").alias("k_is_id"),
    )


@register(
    "children_with_zero_groups",
    "WITH c AS (SELECT c.c_custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey) "
    "SELECT count(*) AS parents, round(avg(n), 4) AS mean_n, round(median(n), 4) AS median_n, min(n) AS min_n, max(n) AS max_n, "
    "count(*) FILTER (WHERE n = 0) AS zero_groups, CAST(sum(n) AS BIGINT) AS total FROM c",
)
def children_with_zero_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG6: count per group including zero groups, summarised."""
    t = Tables(spark, sf_dir)
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    c = t.customer.select("c_custkey").join(per, "c_custkey", "left").select(F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return c.agg(
        F.count(F.lit(1)).alias("parents"), F.round(F.avg("n"), 4).alias("mean_n"),
        F.round(F.median("n"), 4).alias("median_n"), F.min("n").alias("min_n"), F.max("n").alias("max_n"),
        F.count_if(F.col("n") == 0).alias("zero_groups"), F.sum("n").cast("long").alias("total"),
    )


@register(
    "sample_topn_related",
    "WITH s AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 75) "
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM s)",
)
def sample_topn_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR5 + JN2: a 75-parent sample (top by a measure, stable tie-break) and
    all child rows of the sampled parents. The sample size is the feature;
    the broadcast side is bounded by it."""
    t = Tables(spark, sf_dir)
    sample = t.orders.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(75)
    keys = F.broadcast(sample.select(F.col("o_orderkey").alias("l_orderkey")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(keys, "l_orderkey", "left_semi")
