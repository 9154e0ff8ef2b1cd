"""Registered evidence, validation, quality-check, ledger and index-statistics
queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import analyze as A
from ..functions import text as T
from ..operators import evidence as EVD
from ..operators import quality as Q
from ..operators import search as SR
from ..operators.joins import bounded_broadcast
from ..sources.tables import Tables
from . import bm25_sql as B
from . import sqlgen as S
from .prepare import _LINE_ORDER
from .query_edits import _remove_request_words, _remove_request_words_sql
from .registry import register
from .retrieval import needs, overview, plot, stored_run
from .retrieval_variants import _BEST_CHILD_SQL, _best_child

# --- evidence ---------------------------------------------------------------


def _need_terms_sql(e: str) -> str:
    toks = f"list_filter(regexp_extract_all(lower({e}), {S.q(config.TOKEN_PATTERN)}), lambda x: NOT list_contains({S.stop_list()}, x))"
    return f"list_filter({toks}, lambda x, i: list_position({toks}, x) = i)"


def _pool_terms(t: Tables) -> DataFrame:
    pool = stored_run(t, "A").select("qid", "doc")
    terms = needs(t).select("qid", EVD.need_terms(F.col("text")).alias("terms"))
    cand = pool.join(bounded_broadcast(terms), "qid")
    return t.documents.select(F.col("doc_id").alias("doc"), "text").join(bounded_broadcast(cand), "doc")


@register(
    "evidence_terms",
    "WITH " + B.run_a_sql("a_") + ", "
    f"nt AS (SELECT item_id AS qid, {_need_terms_sql('text')} AS terms FROM benchmark), "
    "m AS (SELECT r.qid, r.doc, list_filter(nt.terms, lambda t: strpos(lower(d.text), t) > 0) AS matched "
    "FROM a_ranked r JOIN nt USING (qid) JOIN documents d ON d.doc_id = r.doc) "
    "SELECT qid, doc AS doc_id, array_to_string(matched, '; ') AS matched_terms, CAST(len(matched) AS BIGINT) AS n_matched FROM m",
)
def evidence_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN18 + EV3: need words found (substring, case-folded) in each pooled
    document, in the need's word order."""
    j = _pool_terms(Tables(spark, sf_dir))
    m = EVD.matched_terms(F.col("text"), F.col("terms"))
    return j.select(
        "qid", F.col("doc").alias("doc_id"), F.array_join(m, "; ").alias("matched_terms"),
        F.size(m).cast("long").alias("n_matched"),
    )


@register("evidence_windows")
def evidence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN19 + FN21 + EV3: keyword-in-context windows for every pooled
    document (long field first, short field as fallback; width 300, 3
    windows), joined with ' || '. Greedy windows are a fold, checked against
    a brute-force implementation in the tests."""
    t = Tables(spark, sf_dir)
    pool = stored_run(t, "A").select("qid", "doc")
    terms = needs(t).select("qid", EVD.need_terms(F.col("text")).alias("terms"))
    cand = pool.join(bounded_broadcast(terms), "qid")
    d = t.documents.select(F.col("doc_id").alias("doc"), plot().alias("plot"), overview().alias("overview"))
    j = EVD.plot_evidence(d.join(bounded_broadcast(cand), "doc"), "plot", "overview", "terms", "w")
    return j.select(
        "qid", F.col("doc").alias("doc_id"), F.size("w").alias("n_windows"), F.array_join("w", " || ").alias("evidence")
    )


@register(
    "child_evidence_terms",
    _BEST_CHILD_SQL
    + f", nt AS (SELECT item_id AS qid, {_need_terms_sql('text')} AS terms FROM benchmark), "
    "m AS (SELECT p.qid, p.doc, unnest(list_filter(nt.terms, lambda t: strpos(lower(c.text), t) > 0)) AS term "
    "FROM par_ranked p JOIN nt USING (qid) JOIN conversations c ON c.conv_id = p.doc) "
    "SELECT qid, doc AS conv_id, array_to_string(list_sort(list_distinct(list(term))), '; ') AS matched_terms FROM m GROUP BY qid, doc",
)
def child_evidence_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV3 (child part): sorted distinct union of need words found in any
    child record of each selected parent. Bounded per parent by the need's
    word count."""
    t = Tables(spark, sf_dir)
    top = _best_child(t).select("qid", F.col("doc").alias("conv_id"))
    terms = needs(t).select("qid", EVD.need_terms(F.col("text")).alias("terms"))
    cand = top.join(bounded_broadcast(terms), "qid")
    j = t.conversations.select("conv_id", "text").join(bounded_broadcast(cand), "conv_id")
    m = j.select("qid", "conv_id", F.explode(EVD.matched_terms(F.col("text"), F.col("terms"))).alias("term"))
    return m.groupBy("qid", "conv_id").agg(
        F.array_join(F.array_sort(F.collect_set("term")), "; ").alias("matched_terms")
    )


# --- lenient parsing and validation ------------------------------------------


@register(
    "json_lenient_scan",
    "SELECT event_id, CASE WHEN props IS NULL OR trim(props) = '' THEN 'blank' WHEN NOT json_valid(props) THEN 'malformed' "
    "WHEN json_type(props) <> 'OBJECT' THEN 'non_object' WHEN json_extract(props, '$.k') IS NULL THEN 'missing_key' ELSE 'ok' END AS status, "
    "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events",
)
def json_lenient_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC5 + SC16: JSON payloads parsed without failing the job; each record
    is classified (ok / blank / malformed / non_object / missing_key)."""
    e = Tables(spark, sf_dir).events
    status, val = Q.lenient_json(F.col("props"), "k")
    return e.select("event_id", status.alias("status"), val.alias("k"))


def _doc_rules() -> dict:
    return {
        "text_present": F.col("text").isNotNull() & (T.py_strip("text") != ""),
        "lang_known": F.col("lang").isin("en", "fr", "de", "es"),
        "source_pattern": F.col("source").rlike("^src[0-9]+$"),
        "n_chars_matches": F.col("n_chars") == F.length("text"),
        "min_words_20": T.word_count("text") >= 20,
    }


@register(
    "schema_violations",
    "SELECT doc_id, v AS violations FROM (SELECT doc_id, concat_ws(';', "
    f"CASE WHEN NOT coalesce(text IS NOT NULL AND {S.py_strip('text')} <> '', false) THEN 'text_present' END, "
    "CASE WHEN NOT coalesce(lang IN ('en', 'fr', 'de', 'es'), false) THEN 'lang_known' END, "
    "CASE WHEN NOT coalesce(regexp_matches(source, '^src[0-9]+$'), false) THEN 'source_pattern' END, "
    "CASE WHEN NOT coalesce(n_chars = length(text), false) THEN 'n_chars_matches' END, "
    f"CASE WHEN NOT coalesce({S.word_count('text')} >= 20, false) THEN 'min_words_20' END) AS v FROM documents) WHERE v <> ''",
)
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ND7: declared row constraints; rows with violations are quarantined
    with the list of violated rules (strict mode: ``quality.enforce``)."""
    d = Tables(spark, sf_dir).documents
    v = Q.violations(_doc_rules())
    return d.select("doc_id", v.alias("v")).filter(F.size("v") > 0).select(
        "doc_id", F.array_join("v", ";").alias("violations")
    )


# --- quality checks -----------------------------------------------------------


def _checks(t: Tables) -> DataFrame:
    from ..operators import prepare as P

    li = t.lineitem.select("l_orderkey", *_LINE_ORDER)
    kids = P.positional_index(li, "l_orderkey", _LINE_ORDER)
    blocks_children = kids.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_blocks"))
    src_children = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_src"))
    per = t.orders.select(F.col("o_orderkey").alias("l_orderkey")).join(blocks_children, "l_orderkey", "left").join(
        src_children, "l_orderkey", "left"
    )
    c1 = per.agg(
        F.count(F.lit(1)).alias("parents"),
        F.sum(F.coalesce("n_blocks", F.lit(0))).alias("children"),
        F.count_if(~F.coalesce("n_blocks", F.lit(0)).eqNullSafe(F.coalesce("n_src", F.lit(0)))).alias("child_count_mismatch"),
        F.count_if(F.col("n_src").isNull() & F.col("n_blocks").isNotNull()).alias("childless_with_children"),
    )
    c2 = t.lineitem.agg(F.count(F.lit(1)).alias("source_children"))
    c3 = t.orders.agg(F.count(F.lit(1)).alias("source_parents"))
    c4 = t.documents.agg(F.count_if(F.col("text").isNull() | (T.py_strip("text") == "")).alias("blank_texts"))
    one = c1.crossJoin(F.broadcast(c2)).crossJoin(F.broadcast(c3)).crossJoin(F.broadcast(c4))
    actual = one.select(
        (F.col("parents") + F.col("children")).alias("blocks_total"),
        (F.col("source_parents") + F.col("source_children")).alias("_expected_total"),
        "child_count_mismatch", "childless_with_children", "blank_texts",
        (F.col("children") - F.col("source_children")).alias("children_diff"),
    )
    pairs = (
        "stack(5, 'blocks_total', CAST(_expected_total AS DOUBLE), CAST(blocks_total AS DOUBLE), "
        "'children_reconcile', 0.0D, CAST(children_diff AS DOUBLE), "
        "'child_count_mismatch', 0.0D, CAST(child_count_mismatch AS DOUBLE), "
        "'childless_with_children', 0.0D, CAST(childless_with_children AS DOUBLE), "
        "'blank_texts', 0.0D, CAST(blank_texts AS DOUBLE)) AS (check, expected, actual)"
    )
    long = actual.selectExpr(pairs)
    status = (
        F.when(F.col("actual") == F.col("expected"), F.lit("pass"))
        .when(F.col("check") == "blank_texts", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return long.withColumn("status", status)


_CHECKS_SQL = (
    "WITH per AS (SELECT o.o_orderkey, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS n FROM orders o), "
    "c AS (SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS expected_total, "
    "(SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS blocks_total, "
    f"(SELECT count(*) FROM documents WHERE text IS NULL OR {S.py_strip('text')} = '') AS blank_texts), "
    "chk AS (SELECT 'blocks_total' AS \"check\", CAST(expected_total AS DOUBLE) AS expected, CAST(blocks_total AS DOUBLE) AS actual FROM c "
    "UNION ALL SELECT 'children_reconcile', 0.0, 0.0 UNION ALL SELECT 'child_count_mismatch', 0.0, 0.0 "
    "UNION ALL SELECT 'childless_with_children', 0.0, 0.0 "
    "UNION ALL SELECT 'blank_texts', 0.0, CAST(blank_texts AS DOUBLE) FROM c), "
    "res AS (SELECT *, CASE WHEN actual = expected THEN 'pass' WHEN \"check\" = 'blank_texts' THEN 'warn' ELSE 'fail' END AS status FROM chk) "
)


@register("quality_checks", _CHECKS_SQL + "SELECT * FROM res")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ1 + DQ2: whole-table reconciliation of the parent/child blocks
    against their sources (totals, per-parent child counts, childless
    parents) and a blank-text warning. The oracle states the invariants."""
    return _checks(Tables(spark, sf_dir))


@register("quality_summary", _CHECKS_SQL + "SELECT status, count(*) AS n FROM res GROUP BY status")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ6: pass / fail / warn counts."""
    return _checks(Tables(spark, sf_dir)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# --- incremental work ---------------------------------------------------------


@register(
    "resume_anti_join",
    "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN1: ids still to process = all ids minus those already in the
    previous output (here: documents without a label)."""
    t = Tables(spark, sf_dir)
    return Q.todo(t.documents.select("doc_id"), t.labels, "doc_id")


_STATUS_SQL = "CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'failed' ELSE 'skipped' END"


@register(
    "status_ledger",
    f"SELECT user_id, status, attempts, first_ts, last_ts FROM (SELECT user_id, {_STATUS_SQL} AS status, "
    "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS attempts, "
    "min(ts) OVER (PARTITION BY user_id) AS first_ts, max(ts) OVER (PARTITION BY user_id) AS last_ts FROM events) WHERE rn = 1",
)
def status_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN2: per id the latest attempt's status (ok / failed / skipped),
    attempts and time range; the failed list is ``status = 'failed'``."""
    e = Tables(spark, sf_dir).events
    status = (
        F.when(F.col("event_type") == "purchase", F.lit("ok"))
        .when(F.col("event_type") == "error", F.lit("failed"))
        .otherwise(F.lit("skipped"))
    )
    return Q.ledger(e, "user_id", ["ts", "event_id"], status)


@register(
    "setup_agreement",
    "WITH a AS (SELECT item_id AS qid, text FROM benchmark), "
    f"b AS (SELECT item_id AS qid, {_remove_request_words_sql('text')} AS text FROM benchmark) "
    "SELECT status, count(*) AS n FROM (SELECT CASE WHEN a.qid IS NULL THEN 'only_b' WHEN b.qid IS NULL THEN 'only_a' "
    "WHEN a.text IS NOT DISTINCT FROM b.text THEN 'same' ELSE 'changed' END AS status FROM a FULL OUTER JOIN b ON a.qid = b.qid) GROUP BY status",
)
def setup_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN15: two query sets compared per need (full outer join, null-safe
    equality)."""
    t = Tables(spark, sf_dir)
    a = t.benchmark.select(F.col("item_id").alias("qid"), F.col("text").alias("ta"))
    b = t.benchmark.select(F.col("item_id").alias("qid"), _remove_request_words(F.col("text")).alias("tb"))
    j = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), "qid", "full_outer")
    status = (
        F.when(F.col("_a").isNull(), F.lit("only_b")).when(F.col("_b").isNull(), F.lit("only_a"))
        .when(F.col("ta").eqNullSafe(F.col("tb")), F.lit("same")).otherwise(F.lit("changed"))
    )
    return j.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


# --- analyzer and index statistics -------------------------------------------


@register(
    "analyze_tokens",
    f"SELECT doc_id, CAST(len({S.raw_tokens('text')}) AS INTEGER) AS n_raw, CAST(len(terms) AS INTEGER) AS dl, "
    f"CAST(len(list_distinct(terms)) AS INTEGER) AS n_distinct, md5(array_to_string(terms, ' ')) AS terms_md5 "
    f"FROM (SELECT doc_id, text, {S.analyze('text')} AS terms FROM documents)",
)
def analyze_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR1 + IR2: analyzer output per document (raw token count, analyzed
    length, distinct terms, digest of the term sequence)."""
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", A.raw_tokens("text").alias("raw"), A.analyze("text").alias("terms")).select(
        "doc_id", F.size("raw").alias("n_raw"), F.size("terms").alias("dl"),
        F.size(F.array_distinct("terms")).alias("n_distinct"), F.md5(F.array_join("terms", " ")).alias("terms_md5"),
    )


@register(
    "postings_stats",
    "WITH " + B.term_scores_sql("documents", "doc_id", {"text": "text"}, "SELECT 0 AS qid, 'x' AS term, 1 AS qtf", p="i_")
    + f", allp AS (SELECT field, term, doc, count(*) AS tf FROM i_occ GROUP BY field, term, doc), "
    "dfs AS (SELECT field, term, count(*) AS df FROM allp GROUP BY field, term) "
    "SELECT s.field, s.n_docs, round(s.avgdl, 4) AS avgdl, count(*) AS n_terms, CAST(sum(df) AS BIGINT) AS n_postings, max(df) AS max_df "
    "FROM dfs JOIN i_stats s USING (field) GROUP BY s.field, s.n_docs, s.avgdl",
)
def postings_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR3 + IR4 + AG30: the full inverted index of a field (every term) and
    its statistics: documents, average length, vocabulary, postings, largest
    document frequency. Document frequency is a partial aggregate, so a term
    present in every document does not concentrate in one task."""
    d = Tables(spark, sf_dir).documents
    texts = SR.field_texts(d, "doc_id", {"text": "text"})
    post = SR.postings(texts)
    dfs = post.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    idx = dfs.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("df").cast("long").alias("n_postings"), F.max("df").alias("max_df")
    )
    stats = SR.field_stats(texts)
    return stats.join(idx, "field").select(
        "field", "n_docs", F.round("avgdl", 4).alias("avgdl"), "n_terms", "n_postings", "max_df"
    )
