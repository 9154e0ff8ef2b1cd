"""Registered queries that build the collection end to end.

Sources from the driver tables, as strings: documents and parts are the
movies (release date and votes from the order with the same key), order lines
the credits, customers and then suppliers the links (a supplier with the same
key comes later and wins), the text after a document's first line is its plot,
and conversations are the reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import collection as C
from ..sources.store import stage
from ..sources.tables import Tables
from . import sqlgen as S
from .registry import register
from .retrieval import plot as plot_text

_ID = "CASE WHEN doc_id % 50 = 7 THEN 'm' || CAST(doc_id AS STRING) ELSE CAST(doc_id AS STRING) END"

_MOVIES = f"""
SELECT {_ID} AS movie_id, d.doc_id AS seq, coalesce(p.p_name, '') AS title, d.source AS original_title,
  coalesce(substr(CAST(o.o_orderdate AS STRING), 1, CASE WHEN o.o_orderstatus = 'P' THEN 7 ELSE 10 END), '') AS release_date,
  CAST(p.p_size % 20 AS STRING) AS runtime, d.lang AS original_language, o.o_orderstatus AS status, p.p_brand AS overview, ' ' AS tagline,
  concat(coalesce(p.p_type, ''), ', ,', d.lang) AS genres, CAST(o.o_custkey % 12 AS STRING) AS vote_average,
  CAST(o.o_custkey % 5 AS STRING) AS vote_count, 'n/a' AS popularity, CAST(p.p_retailprice AS STRING) AS budget, '0' AS revenue
FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id LEFT JOIN orders o ON o.o_orderkey = d.doc_id"""

_LINKS = """
SELECT CAST(c_custkey AS STRING) AS movie_id, c_custkey * 2 AS seq, CASE WHEN c_acctbal > 0 THEN c_name ELSE ' ' END AS wikipedia_title,
  concat('https://example.org/wiki/', c_name) AS wikipedia_url, concat('Q', CAST(c_custkey AS STRING)) AS wikidata_id, '' AS imdb_id, 'primary' AS match_method FROM customer
UNION ALL SELECT CAST(s_suppkey AS STRING), s_suppkey * 2 + 1, s_name, concat('https://example.org/wiki/', s_name), '', concat('tt', CAST(s_suppkey AS STRING)), 'secondary' FROM supplier"""

_REVIEWS = """
SELECT CAST(conv_id AS STRING) AS movie_id, turn AS seq, role AS author, CASE WHEN turn % 3 = 0 THEN '' ELSE CAST(turn AS STRING) END AS author_rating, text AS content,
  CASE WHEN turn % 4 = 3 THEN 'unknown' ELSE concat('2024-01-1', CAST(turn % 10 AS STRING), ' 10:00') END AS created_at FROM conversations"""


def sources(t: Tables) -> dict[str, DataFrame]:
    """The five sources as string tables."""
    spark = t.spark
    for name in ("documents", "part", "orders", "customer", "supplier", "conversations"):
        getattr(t, name).createOrReplaceTempView(name)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    mine = lines.join(t.documents.select(F.col("doc_id").alias("l_orderkey")), "l_orderkey", "left_semi")
    who = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    at = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    per = mine.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(at, F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" (S"), F.col("l_suppkey").cast("string"), F.lit(")")).alias("x"), who.alias("w"), "l_returnflag", "l_linestatus"))).alias("e"))
    joined = lambda c: F.array_join(c, "; ")
    credits = per.select(
        F.col("l_orderkey").cast("string").alias("movie_id"), F.lit(0).alias("seq"), joined(F.array_distinct(F.transform(F.filter("e", lambda s: s["l_linestatus"] == "O"), lambda s: s["w"]))).alias("director"),
        joined(F.transform("e", lambda s: s["x"])).alias("cast"), joined(F.array_distinct(F.transform("e", lambda s: s["w"]))).alias("crew_names"),
        joined(F.transform("e", lambda s: F.concat(s["w"], F.lit(" ("), s["l_returnflag"], F.lit("))")))).alias("crew_roles"))
    movies = spark.sql(_MOVIES)
    text = plot_text("text")
    plots = t.documents.select(F.expr(_ID).alias("movie_id"), F.col("doc_id").alias("seq"), F.when(text.isNull(), "no_plot").otherwise("ok").alias("status"), text.alias("plot"))
    return {"movies": movies, "credits": credits, "links": spark.sql(_LINKS), "plots": plots, "reviews": spark.sql(_REVIEWS)}


def built(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame, DataFrame]:
    """(sources, decisions, parents, children); decisions and children are
    read by several outputs and written once."""
    own = sources(Tables(spark, sf_dir))
    decisions = stage(C.plot_decisions(own["movies"], own["plots"]), "decisions")
    kids = stage(C.children(own["reviews"], decisions.where("drop_reason is null")), "children")
    return own, decisions, C.parents(own["movies"], own["credits"], own["links"], decisions, kids), kids


def _q(sql: str) -> str:
    return sql.replace("STRING", "VARCHAR")


_PLOT = "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END"
_SQL = f"""
WITH m AS ({_q(_MOVIES)}), l0 AS ({_q(_LINKS)}), r0 AS ({_q(_REVIEWS)}),
li AS (SELECT l_orderkey, l_suppkey, l_partkey, l_returnflag, l_linestatus, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i FROM lineitem),
firsts AS (SELECT l_orderkey, l_suppkey, min(i) AS i, min(i) FILTER (WHERE l_linestatus = 'O') AS o FROM li GROUP BY l_orderkey, l_suppkey),
crew AS (SELECT l_orderkey, coalesce(list('S' || l_suppkey ORDER BY o) FILTER (WHERE o IS NOT NULL), []) AS director, list('S' || l_suppkey ORDER BY i) AS crew_names FROM firsts GROUP BY l_orderkey),
acts AS (SELECT l_orderkey, list('P' || l_partkey ORDER BY i) AS names, list('S' || l_suppkey ORDER BY i) AS chars, list(l_returnflag ORDER BY i) AS jobs FROM li GROUP BY l_orderkey),
l AS (SELECT * FROM l0 QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY seq DESC) = 1),
p AS (SELECT {_q(_ID)} AS movie_id, nullif({S.strip_footnotes(_PLOT)}, '') AS plot FROM documents),
dec AS (SELECT movie_id, plot, CASE WHEN NOT regexp_full_match(movie_id, '[0-9]+') THEN 'non_numeric_id' WHEN plot IS NULL THEN 'no_plot'
  WHEN {S.word_count('plot')} < 50 THEN 'short_plot' END AS drop_reason FROM p),
kids AS (SELECT r.movie_id, CAST(row_number() OVER (PARTITION BY r.movie_id ORDER BY seq) - 1 AS INTEGER) AS idx, author, TRY_CAST(nullif(author_rating, '') AS DOUBLE) AS rating,
  {S.py_strip("replace(coalesce(content, ''), chr(13) || chr(10), chr(10))")} AS text, CASE WHEN created_at = 'unknown' THEN created_at ELSE substr(created_at, 1, 10) END AS created_at
  FROM r0 r JOIN dec d ON d.movie_id = r.movie_id AND d.drop_reason IS NULL),
kid AS (SELECT *, CAST({S.word_count('text')} AS INTEGER) AS n_words FROM kids),
nk AS (SELECT movie_id, CAST(count(*) AS INTEGER) AS n FROM kid GROUP BY movie_id),
doc AS (SELECT m.movie_id AS source_id, CAST(m.movie_id AS BIGINT) AS movie_id, title, {S.blank_to_null('original_title')} AS original_title, original_language, status, {S.blank_to_null('overview')} AS overview,
  CASE WHEN length(release_date) = 10 THEN release_date END AS release_date, CASE WHEN length(release_date) = 10 THEN CAST(substr(release_date, 1, 4) AS INTEGER) END AS year,
  nullif(CAST(runtime AS INTEGER), 0) AS runtime, list_filter([split_part(genres, ',', 1), original_language], lambda g: g <> '') AS genres,
  CAST(coalesce(vote_count, '0') AS BIGINT) AS vote_count, CASE WHEN vote_count <> '0' THEN CAST(vote_average AS DOUBLE) END AS vote_average, CAST(trunc(CAST(budget AS DOUBLE)) AS BIGINT) AS budget,
  coalesce(crew.director, []) AS director, coalesce(crew.crew_names, []) AS crew_names, coalesce(names, []) AS names, coalesce(chars, []) AS chars, coalesce(jobs, []) AS jobs,
  {S.blank_to_null('wikipedia_title')} AS w_title, wikipedia_url AS w_url, nullif(wikidata_id, '') AS w_data, nullif(imdb_id, '') AS w_imdb, match_method AS w_how, d.plot, coalesce(nk.n, 0) AS num_reviews
  FROM m JOIN dec d ON d.movie_id = m.movie_id AND d.drop_reason IS NULL LEFT JOIN crew ON CAST(crew.l_orderkey AS VARCHAR) = m.movie_id
  LEFT JOIN acts ON CAST(acts.l_orderkey AS VARCHAR) = m.movie_id LEFT JOIN l ON l.movie_id = m.movie_id LEFT JOIN nk ON nk.movie_id = m.movie_id) """


@register("collection_parents", _SQL + """
SELECT movie_id, title, original_title, original_language, status, overview, release_date, year, runtime, array_to_string(genres, '|') AS genres, vote_count, vote_average, budget,
  array_to_string(director, '|') AS director, array_to_string(crew_names, '|') AS crew_names, array_to_string(names, '|') AS cast_names, array_to_string(chars, '|') AS cast_characters,
  CAST(len(names) AS INTEGER) AS n_cast, array_to_string(jobs, '|') AS jobs, CASE WHEN w_title IS NOT NULL THEN w_title END AS link_title, CASE WHEN w_title IS NOT NULL THEN w_how END AS link_method,
  md5(plot) AS plot_md5, num_reviews FROM doc""")
def collection_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN5 + ND1 + PF4 + PF5: five sources joined into typed parent rows."""
    own = built(spark, sf_dir)[2]
    bar = lambda c: F.array_join(c, "|")
    return own.select(
        "movie_id", "title", "original_title", "original_language", "status", "overview", "release_date", "year", "runtime", bar("genres").alias("genres"), "vote_count", "vote_average", "budget",
        bar("director").alias("director"), bar("crew_names").alias("crew_names"), bar(F.col("cast.name")).alias("cast_names"), bar(F.col("cast.character")).alias("cast_characters"),
        F.size("cast").alias("n_cast"), bar(F.col("crew_roles.job")).alias("jobs"), F.col("wikipedia.title").alias("link_title"), F.col("wikipedia.match_method").alias("link_method"),
        F.md5(F.col("plot").cast("binary")).alias("plot_md5"), "num_reviews")


@register("collection_children", _SQL + "SELECT movie_id, idx, author, rating, md5(text) AS text_md5, created_at, n_words FROM kid")
def collection_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG5 + FN13: reviews of the accepted movies with their index."""
    kids = built(spark, sf_dir)[3]
    return kids.select("movie_id", "idx", "author", "rating", F.md5(F.col("text").cast("binary")).alias("text_md5"), "created_at", "n_words")


@register("collection_manifest", _SQL + """
SELECT 'filter' AS section, unnest(['reject_non_numeric_movie_id', 'require_plot', 'strip_footnote_markers', 'min_plot_words']) AS name, unnest([1, 1, 1, 50])::BIGINT AS value
UNION ALL SELECT 'source', 'movies', count(*) FROM documents UNION ALL SELECT 'source', 'credits', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'source', 'links', count(*) FROM l0 UNION ALL SELECT 'source', 'plots', count(*) FROM documents UNION ALL SELECT 'source', 'reviews', count(*) FROM conversations
UNION ALL SELECT 'output', 'documents', count(*) FROM dec WHERE drop_reason IS NULL UNION ALL SELECT 'output', 'dropped_non_numeric_id', count(*) FROM dec WHERE drop_reason = 'non_numeric_id'
UNION ALL SELECT 'output', 'dropped_no_plot', count(*) FROM dec WHERE drop_reason = 'no_plot' UNION ALL SELECT 'output', 'dropped_short_plot', count(*) FROM dec WHERE drop_reason = 'short_plot'
UNION ALL SELECT 'output', 'children', count(*) FROM kid""")
def collection_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC15 + PF5: filters, source rows, output and ordered drop reasons."""
    own, decisions, _, kids = built(spark, sf_dir)
    return C.manifest(own, decisions, kids)


@register("collection_search_rows", _SQL + """
SELECT 'movie-' || movie_id AS id, 'movie' AS doc_type, NULL AS parent_id, title, array_to_string(names, '|') AS cast_name, array_to_string(chars, '|') AS cast_character,
  array_to_string(range(len(names)), '|') AS cast_order, array_to_string(jobs, '|') AS crew_job, CASE WHEN w_title IS NOT NULL THEN w_url END AS link_url, num_reviews,
  NULL AS review_author, NULL::DOUBLE AS review_rating, NULL AS review_created_at, NULL AS review_md5 FROM doc
UNION ALL SELECT 'movie-' || movie_id || '-review-' || idx, 'review', 'movie-' || movie_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, author, rating,
  CASE WHEN created_at <> 'unknown' THEN created_at || 'T00:00:00Z' END, md5(text) FROM kid""")
def collection_search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ND2-ND4 + UN5 + FN11 + FN23: flattened parents and their children with
    values in one heterogeneous table."""
    _, _, own, kids = built(spark, sf_dir)
    rows = C.search_rows(own, kids)
    bar = lambda c: F.array_join(F.col(f"`{c}`").cast("array<string>"), "|")
    return rows.select(
        "id", "doc_type", "parent_id", "title", bar("cast.name").alias("cast_name"), bar("cast.character").alias("cast_character"), bar("cast.order").alias("cast_order"),
        bar("crew_roles.job").alias("crew_job"), F.col("`wikipedia.url`").alias("link_url"), "num_reviews", "review_author", "review_rating", "review_created_at",
        F.md5(F.col("review_text").cast("binary")).alias("review_md5"))


@register("collection_violations", _SQL + """
, v AS (SELECT unnest(list_filter([CASE WHEN length(title) < 1 THEN 'title' END, CASE WHEN vote_average > 10 THEN 'vote_average' END], lambda x: x IS NOT NULL)) AS rule FROM doc)
SELECT rule, count(*) AS n FROM v GROUP BY rule""")
def collection_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ND7 + SC11: documents that break each constraint of the schema."""
    rows = C.validated(built(spark, sf_dir)[2])
    return rows.select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@register("collection_counters", _SQL + """
, a AS (SELECT count(*)::DOUBLE AS documents, count(*) FILTER (WHERE len(director) > 1)::DOUBLE AS several_directors, count(*) FILTER (WHERE len(director) = 0)::DOUBLE AS no_director,
  count(*) FILTER (WHERE len(names) = 0)::DOUBLE AS no_cast, count(*) FILTER (WHERE len(crew_names) = 0)::DOUBLE AS no_crew, count(*) FILTER (WHERE num_reviews > 0)::DOUBLE AS with_review,
  count(w_title)::DOUBLE AS linked, count(*) FILTER (WHERE w_title IS NOT NULL AND w_data IS NOT NULL)::DOUBLE AS linked_wikidata, count(*) FILTER (WHERE w_title IS NOT NULL AND w_imdb IS NOT NULL)::DOUBLE AS linked_imdb FROM doc),
b AS (SELECT count(DISTINCT movie_id) FILTER (WHERE rating IS NOT NULL)::DOUBLE AS with_rating, count(*)::DOUBLE AS reviews, count(rating)::DOUBLE AS reviews_rated, round(avg(rating), 4) AS mean_rating,
  sum(n_words)::DOUBLE AS review_words, max(n_words)::DOUBLE AS longest_review FROM kid)
SELECT name, value FROM (UNPIVOT (SELECT * FROM a, b) ON COLUMNS(*) INTO NAME name VALUE value)""")
def collection_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG26 + AG27: counters of the collection and its flattened reviews."""
    _, _, own, kids = built(spark, sf_dir)
    return C.counters(own, kids)
