"""Registered queries: needs with their own source and filters, run checks,
display fields, judgment provenance, gate, rubric and reference counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import text as T
from ..operators import evaluate as EV
from ..operators import judging as J
from ..operators import needs as N
from ..sources.store import stage
from ..sources.tables import Tables
from . import bm25_sql as B
from . import sqlgen as S
from .evaluation import _POOL_SQL, PER_QUERY_SQL, _labelled, _pool, _runs
from .registry import register
from .retrieval import overview, plot, stored_run

# Needs from the benchmark: every third asks for child records; by id they
# have no filter, a phrase of their first two words in one line or the
# language en, no document with that phrase, or a size and a language.
_FIRST_TWO = "split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2)"


def defined(t: Tables) -> DataFrame:
    pair = F.concat_ws(" ", F.split_part("text", F.lit(" "), F.lit(1)), F.split_part("text", F.lit(" "), F.lit(2)))
    no = F.lit(None).cast("double")
    one = lambda op, field, values, low=no, high=no, negate=False: F.struct(F.lit(op).alias("op"), F.lit(field).alias("field"), values.cast("array<string>").alias("values"), low.alias("low"), high.alias("high"), F.lit(negate).alias("negate"))
    kind = F.col("item_id") % 4
    filters = (F.when(kind == 1, F.array(one("phrase", "lines", F.array(pair, F.lit("the of")))))
               .when(kind == 2, F.array(one("term", "lines", F.array(pair), negate=True), one("exact", "lang", F.array(F.lit("en"), F.lit("fr")))))
               .when(kind == 3, F.array(one("range", "n_chars", F.array(), F.lit(200.0), F.lit(5000.0)), one("exact", "lang", F.array(F.lit("EN"), F.lit("de"))))))
    return t.benchmark.select(F.col("item_id").alias("qid"), F.col("text").alias("need"), F.when(F.col("item_id") % 3 == 0, N.REVIEWS).otherwise(N.STORY).alias("source"),
                              F.coalesce(filters, F.array().cast(N.FILTER_TYPE)).alias("filters"))


def _run(t: Tables, setup: str) -> DataFrame:
    needs = defined(t)
    ok = N.allowed(t.documents, "doc_id", needs, {"lines": F.split("text", "\n")}, {"lang": F.array("lang")}, {"n_chars": F.col("n_chars")})
    # Read by the story and the child needs, so the filters run once.
    return N.search(needs, t.documents, "doc_id", plot(), t.conversations, "conv_id", "turn", "text", stage(ok, "allowed"), overview() if setup == "B" else None)


def _positioned(e: str) -> str:
    return f"' ' || array_to_string(list_transform({S.raw_tokens(e)}, lambda x: CASE WHEN list_contains({S.stop_list()}, x) THEN '*' ELSE {S.stem('x')} END), ' ') || ' '"


_WANTED = f"regexp_replace(regexp_replace({_positioned(_FIRST_TWO)}, '^( [*])+ ', ' '), '([*] )+$', '')"
_NEEDS = f"needs AS (SELECT item_id AS qid, text, item_id % 3 = 0 AS kids, item_id % 4 AS kind, {_WANTED} AS phrase FROM benchmark)"
_OK = f"""lines AS (SELECT doc_id, lang, n_chars, list_transform(string_split(text, chr(10)), lambda l: {_positioned('l')}) AS ls FROM documents),
ok AS (SELECT qid, doc_id AS doc FROM lines, needs WHERE kind = 0 OR (kind = 1 AND trim(phrase) <> '' AND len(list_filter(ls, lambda l: contains(l, phrase))) > 0)
  OR (kind = 2 AND (trim(phrase) = '' OR coalesce(len(list_filter(ls, lambda l: contains(l, phrase))), 0) = 0) AND lang IN ('en', 'fr')) OR (kind = 3 AND n_chars BETWEEN 200 AND 5000 AND lang IN ('EN', 'de')))"""
_STORY = B.term_scores_sql("documents", "doc_id", {"story": B.PLOT_SQL}, B.query_terms_sql("SELECT qid, text FROM needs WHERE NOT kids"), p="s_") + ", " + B.scored_sql(1, "s_")
_KIDS = B.term_scores_sql("conversations", "conv_id || '/' || turn", {"text": "text"}, B.query_terms_sql("SELECT qid, text FROM needs WHERE kids"), p="k_") + ", " + B.scored_sql(1, "k_")
_FIRST = f"""WITH {_NEEDS}, {_OK}, {_STORY}, {_KIDS}, par AS (SELECT qid, CAST(split_part(doc, '/', 1) AS BIGINT) AS doc, max(score) AS score FROM k_scored GROUP BY ALL),
st AS (SELECT qid, doc, score FROM s_scored JOIN ok USING (qid, doc)), kd AS (SELECT qid, doc, score FROM par JOIN ok USING (qid, doc)),
{B.ranked_sql('st', p='a_')}, {B.ranked_sql('kd', p='c_')}"""
_SECOND = B.run_b_sql("b_", "a_", "SELECT qid, text FROM needs WHERE NOT kids")


def _shown(t: Tables, run: DataFrame) -> DataFrame:
    fields = {"lang": F.col("lang"), "overview": overview()}
    out = N.presented(run, t.documents, "doc_id", fields, "overview")
    return out.select("qid", F.col("doc").alias("doc_id"), F.col("rank").cast("int").alias("rank"), F.round("score", 4).alias("score"), "lang", "overview")


def _shown_sql(first: str) -> str:
    return (f" SELECT qid, doc AS doc_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, d.lang, substr({B.OVERVIEW_SQL}, 1, 150) AS overview "
            f"FROM (SELECT qid, doc, rank, score FROM {first} UNION ALL SELECT qid, doc, rank, score FROM c_ranked) r LEFT JOIN documents d ON d.doc_id = r.doc")


@register("needs_setup_a", _FIRST + _shown_sql("a_ranked"))
def needs_setup_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR19 + PF8 + PF10-PF13: each need over its own source with its own
    filters, with display columns."""
    t = Tables(spark, sf_dir)
    return _shown(t, _run(t, "A"))


@register("needs_setup_b", _FIRST + ", " + _SECOND + _shown_sql("b_ranked"))
def needs_setup_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR19: the same needs and filters, story needs reranked by the overview."""
    t = Tables(spark, sf_dir)
    return _shown(t, _run(t, "B"))


@register("run_integrity", "WITH " + B.run_a_sql("a_") + " SELECT qid, count(*) AS results, 0::BIGINT AS missing_id, count(doc) - count(DISTINCT doc) AS repeated, "
          "0::BIGINT AS wrong_key, CAST(max(rank) - count(DISTINCT rank) AS BIGINT) AS gaps, 'pass' AS status FROM a_ranked GROUP BY qid")
def run_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IR17: ids present, unique and well formed, ranks without gaps."""
    run = stored_run(Tables(spark, sf_dir), "A")
    return N.check_run(run.withColumn("id", T.composite_key("movie", "doc")))


@register("boolean_filter", f"SELECT doc_id FROM (SELECT doc_id, {S.analyze('text')} AS w FROM documents) WHERE list_contains(w, 'que') OR list_contains(w, 'und')")
def boolean_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF17: unranked boolean restriction on analyzed words."""
    return N.boolean_match(Tables(spark, sf_dir).documents, "doc_id", "text", [], ["que", "und"])


# --- judgments ----------------------------------------------------------------

_JUDGE = "CASE doc_id % 5 WHEN 0 THEN 'seed-1' WHEN 1 THEN ' Preliminary' WHEN 2 THEN ' ' WHEN 3 THEN 'ann' END"


@register("judgment_provenance", f"SELECT quality AS rel, count(*) AS judged, count(*) FILTER (WHERE doc_id % 5 <> 3) AS provisional, count(*) FILTER (WHERE doc_id % 5 = 3) AS manual "
          "FROM labels WHERE quality IS NOT NULL GROUP BY quality")
def judgment_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG36: judgments by grade with and without a named judge."""
    sheet = Tables(spark, sf_dir).labels.select(F.col("quality").alias("rel"), F.expr(_JUDGE).alias("judge")).where("rel is not null")
    return J.provenance(sheet, ["rel"])


def _sheet(t: Tables) -> DataFrame:
    """Judgments of the pool: grades by label, every judge named but those of
    ids divisible by 5."""
    judge = F.when(F.col("doc") % 5 == 0, "seed").otherwise("ann")
    return _pool(t).select("qid", "doc").join(EV.grades_from_labels(t.labels), "doc").select("qid", "doc", "rel", judge.alias("judge"))


_GATE_SQL = (", gates AS (SELECT qid, count(*) AS pooled, count(*) FILTER (WHERE rel IS NULL) AS unjudged, count(*) FILTER (WHERE rel IS NOT NULL AND doc % 5 = 0) AS provisional "
             "FROM pooled LEFT JOIN qrels USING (doc) GROUP BY qid) ")


@register("metrics_gate", _POOL_SQL + _GATE_SQL + "SELECT *, CASE WHEN unjudged > 0 OR provisional > 0 THEN 'pending' ELSE 'final' END AS status FROM gates")
def metrics_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV16: final metrics are refused while a need has unjudged or
    provisional documents in its pool."""
    t = Tables(spark, sf_dir)
    return J.gate(_pool(t), _sheet(t))


@register("metrics_gated", PER_QUERY_SQL + ", pooled AS (SELECT DISTINCT qid, doc FROM runs WHERE qid % 2 = 0), labelled AS (SELECT p.qid, p.doc FROM pooled p JOIN labels l ON l.doc_id = p.doc), "
          "final AS (SELECT qid FROM labelled GROUP BY qid HAVING count(*) FILTER (WHERE doc % 7 = 0) = 0) SELECT pq.* FROM pq JOIN final USING (qid)")
def metrics_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV16: metrics of the needs whose gate is final, over the judged part of
    the pools of needs with an even id; ids divisible by 7 are provisional."""
    t = Tables(spark, sf_dir)
    a, b = _runs(t)
    needs = t.benchmark.select(F.col("item_id").alias("qid"))
    qrels = EV.grades_from_labels(t.labels)
    sheet = _pool(t).where("qid % 2 = 0").select("qid", "doc").join(qrels, "doc").select("qid", "doc", "rel", F.when(F.col("doc") % 7 == 0, "preliminary").otherwise("ann").alias("judge"))
    return J.gated(EV.per_query(_labelled(a, b), qrels, needs, ["A", "B"]), J.gate(sheet, sheet))


@register("rubric_grades", _POOL_SQL + "SELECT qid, doc AS doc_id, CAST(rel AS INTEGER) AS rel, CASE WHEN rel IS NOT NULL THEN 'preliminary' END AS judge, "
          "CASE WHEN rel IS NOT NULL THEN 'grade ' || rel END AS notes FROM pooled LEFT JOIN qrels USING (doc)")
def rubric_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV19: preliminary grades of the pool from a rubric table."""
    t = Tables(spark, sf_dir)
    p = _pool(t)
    grades = EV.grades_from_labels(t.labels).withColumn("notes", F.concat(F.lit("grade "), F.col("rel").cast("string")))
    rubric = p.select("qid", "doc").join(grades, "doc")
    return J.apply_rubric(p, rubric, strict=False).withColumnRenamed("doc", "doc_id")


@register("evaluator_order", "WITH " + B.run_a_sql("a_") + " SELECT qid, doc AS doc_id, CAST(rank AS INTEGER) AS rank, CAST(row_number() OVER (PARTITION BY qid ORDER BY CAST(round(score, 1) AS FLOAT) DESC, "
          "CAST(doc AS VARCHAR) DESC) AS INTEGER) AS trec_rank FROM a_ranked")
def evaluator_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR9: the evaluator's order of setup A's run, its scores written with
    one decimal so that ties occur."""
    run = stored_run(Tables(spark, sf_dir), "A").withColumn("score", F.round("score", 1))
    out = J.evaluator_order(run, config.RUN_DEPTH)
    return out.select("qid", F.col("doc").alias("doc_id"), F.col("rank").cast("int").alias("rank"), F.col("trec_rank").cast("int").alias("trec_rank"))


# --- reference counts, display-only fields, titles --------------------------------


@register("reference_counts", "WITH own AS (SELECT r_name AS label, count(o_orderkey) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey "
          "WHERE o_orderstatus <> 'P' GROUP BY r_name), ref AS (SELECT r_name AS label, count(*) AS reference FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey "
          "WHERE c_acctbal > 0 GROUP BY r_name HAVING r_name <> 'ASIA') "
          "SELECT label, n, coalesce(reference, 0) AS reference, n - coalesce(reference, 0) AS diff FROM own LEFT JOIN ref USING (label)")
def reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN13: counts per label next to those of a reference table, a label
    that the reference lacks counting 0."""
    from ..operators.profile import against_reference

    t = Tables(spark, sf_dir)
    place = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", F.col("r_name").alias("label"))
    at = t.customer.select("c_custkey", "c_nationkey", "c_acctbal").join(F.broadcast(place), F.col("n_nationkey") == F.col("c_nationkey"))
    own = t.orders.where("o_orderstatus <> 'P'").select("o_custkey").join(at.select("c_custkey", "label"), F.col("c_custkey") == F.col("o_custkey"))
    ref = at.where("c_acctbal > 0 and label <> 'ASIA'").groupBy("label").agg(F.count(F.lit(1)).alias("reference"))
    return against_reference(own.groupBy("label").agg(F.count(F.lit(1)).alias("n")), ref, "label")


@register("display_only_fields", "WITH j AS (SELECT count(*) FILTER (WHERE p_type = 'ECONOMY') AS e, count(*) FILTER (WHERE p_type = 'economy') AS l, count(*) FILTER (WHERE p_type = 'ECONOMYS') AS p FROM part) "
          "SELECT unnest(['exact value found', 'case-sensitive', 'no stemming']) AS check, unnest([CASE WHEN e > 0 THEN 'pass' ELSE 'warn' END, CASE WHEN e = 0 OR l = 0 THEN 'pass' ELSE 'fail' END, "
          "CASE WHEN p = 0 THEN 'pass' ELSE 'fail' END]) AS status, unnest([e, l, p]) AS found FROM j")
def display_only_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ5 + PF14: a display-only field answers exact lookups only."""
    from ..operators.quality import display_only

    return display_only(Tables(spark, sf_dir).part, "p_type", "ECONOMY")


@register("title_fallback", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'Page ' || page_id WHEN page_id % 3 = 1 AND nullif(regexp_extract(url, '([^/]*)$', 1), '') IS NOT NULL "
          "THEN replace(regexp_extract(url, '([^/]*)$', 1), '_', ' ') END AS title, "
          "CASE WHEN page_id % 3 = 0 THEN 'link' WHEN page_id % 3 = 1 AND nullif(regexp_extract(url, '([^/]*)$', 1), '') IS NOT NULL THEN 'url' ELSE 'unmatched' END AS origin FROM pages")
def title_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN15: the link's title, else one from its address, else unmatched."""
    given = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("Page "), F.col("page_id").cast("string"))).otherwise(" ")
    address = F.when(F.col("page_id") % 3 == 1, F.col("url"))
    title, origin = T.title_or_url(given, address)
    return Tables(spark, sf_dir).pages.select("page_id", title.alias("title"), origin.alias("origin"))
