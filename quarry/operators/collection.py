"""Building a parent/child collection from five string tables.

The sources are movies, credits, links, plots and reviews as read from CSV:
every column a string, keyed by ``movie_id``, with a sequence column that
tells which of several rows of a key came last. The collection is kept as two
tables, parents (one typed row per accepted movie, with its credit lists) and
children (one row per review with its index), because a movie may hold any
share of all reviews; ``nested`` gives the document form where the groups are
known to be small.

Each source is reduced to one row per key by a max over a struct (combined
map-side), rows that are dropped are decided before the wide joins, and the
joins are left joins on the key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import prepare as P
from . import quality as Q

MIN_PLOT_WORDS = 50
YEARS = (1800, 2100)
NOT_NUMERIC, NO_PLOT, SHORT_PLOT = "non_numeric_id", "no_plot", "short_plot"

MOVIE_TEXT = ("original_title", "original_language", "status", "overview", "tagline")
LINK_FIELDS = ("title", "url", "wikidata_id", "imdb_id", "match_method")


def _latest(df: DataFrame, seq: str) -> DataFrame:
    return P.last_wins(df, "movie_id", seq).drop(seq)


def plot_decisions(movies: DataFrame, plots: DataFrame, min_words: int = MIN_PLOT_WORDS, seq: str = "seq") -> DataFrame:
    """One row per movie id: (movie_id, plot, drop_reason).

    The reasons are tried in order, so a movie has at most one: its id is not
    a number, it has no extracted plot text, its plot has fewer than
    ``min_words`` words. A null reason accepts the movie.
    """
    texts = _latest(plots, seq).select("movie_id", F.when(T.py_strip("status") == "ok", T.blank_to_null(T.strip_footnotes("plot"))).alias("plot"))
    numeric = T.py_strip("movie_id").rlike("^[0-9]+$")
    reason = (F.when(F.col("movie_id").isNull() | ~numeric, NOT_NUMERIC).when(F.col("plot").isNull(), NO_PLOT)
              .when(T.word_count("plot") < min_words, SHORT_PLOT))
    return movies.select("movie_id").distinct().join(texts, "movie_id", "left").select("movie_id", "plot", reason.alias("drop_reason"))


def children(reviews: DataFrame, accepted: DataFrame, seq: str = "seq") -> DataFrame:
    """Reviews of the accepted movies in source order: (movie_id, idx, author,
    rating, text, created_at, n_words). Dates keep their day, other values of
    that column stay as they are."""
    own = reviews.join(accepted.select("movie_id"), "movie_id", "left_semi")
    placed = P.positional_index(own, "movie_id", seq, "idx")
    text = T.py_strip(T.crlf_to_lf(F.coalesce("content", F.lit(""))))
    return placed.select("movie_id", F.col("idx").cast("int").alias("idx"), T.blank_to_null("author").alias("author"), T.safe_double("author_rating").alias("rating"), text.alias("text"),
                         F.coalesce(T.date_prefix(T.py_strip("created_at")), T.blank_to_null("created_at")).alias("created_at"), T.word_count(text).cast("int").alias("n_words"))


def _credits(name: str, detail: str, all_trailing: bool, with_order: bool) -> Column:
    """array<struct<name, detail[, order]>> of a "Name (Detail); ..." column."""
    parsed = T.parse_name_paren(F.coalesce(F.col(name), F.lit("")), all_trailing)
    return F.transform(parsed, lambda x: F.struct(x["name"].alias("name"), x["detail"].alias(detail), *([x["order"].alias("order")] if with_order else [])))


def parents(movies: DataFrame, credits: DataFrame, links: DataFrame, decisions: DataFrame, kids: DataFrame, seq: str = "seq") -> DataFrame:
    """Typed rows of the accepted movies (the target schema without reviews).

    0 is missing for runtime, budget and revenue; a rating without votes is
    missing; a release date that is not YYYY-MM-DD is missing, its row stays;
    a link counts only with title and url. Movies without credits, links or
    reviews have empty lists, a null struct and 0.
    """
    accepted = decisions.where("drop_reason is null").select("movie_id", "plot")
    m = _latest(movies, seq).join(accepted, "movie_id")
    c = _latest(credits, seq).select("movie_id", *(F.col(x).alias(f"_{x}") for x in ("director", "cast", "crew_names", "crew_roles")))
    w = _latest(links, seq)
    linked = F.struct(*(T.blank_to_null(F.col(f"wikipedia_{x}" if x in ("title", "url") else x)).alias(x) for x in LINK_FIELDS))
    w = w.select("movie_id", linked.alias("_link"))
    n = kids.groupBy("movie_id").agg(F.count(F.lit(1)).cast("int").alias("_reviews"))
    j = m.join(c, "movie_id", "left").join(w, "movie_id", "left").join(n, "movie_id", "left")
    dated = T.py_strip("release_date")
    dated = F.when(dated.rlike(r"^\d{4}-\d{2}-\d{2}$"), dated)
    year = F.substring(dated, 1, 4).try_cast("int")
    votes = F.coalesce(T.safe_long("vote_count"), F.lit(0))
    lists = {x: T.split_list(F.coalesce(F.col(f"_{x}"), F.lit(""))) for x in ("director", "crew_names")}
    return j.select(
        F.col("movie_id").alias("source_id"), T.py_strip("movie_id").try_cast("long").alias("movie_id"), T.py_strip("title").alias("title"),
        *(T.blank_to_null(x).alias(x) for x in MOVIE_TEXT), dated.alias("release_date"), F.when(year.between(*YEARS), year).alias("year"),
        T.safe_long("runtime", True).cast("int").alias("runtime"), T.split_list("genres", ",").alias("genres"),
        F.when(votes != 0, T.safe_double("vote_average")).alias("vote_average"), votes.alias("vote_count"), T.safe_double("popularity").alias("popularity"),
        T.safe_long("budget", True).alias("budget"), T.safe_long("revenue", True).alias("revenue"), lists["director"].alias("director"),
        _credits("_cast", "character", False, True).alias("cast"), lists["crew_names"].alias("crew_names"), _credits("_crew_roles", "job", True, False).alias("crew_roles"),
        F.when(F.col("_link.title").isNotNull() & F.col("_link.url").isNotNull(), F.col("_link")).alias("wikipedia"), "plot",
        F.coalesce("_reviews", F.lit(0)).alias("num_reviews"))


def rules() -> Mapping[str, Column]:
    """Constraints of a parent row; each is true when the row is valid."""
    at_least = lambda c, low: F.col(c).isNull() | (F.col(c) >= low)
    return {
        "movie_id": F.col("movie_id").isNotNull(),
        "title": F.length("title") >= 1,
        "release_date": F.col("release_date").isNull() | F.col("release_date").rlike(r"^\d{4}-\d{2}-\d{2}$"),
        "year": F.col("year").isNull() | F.col("year").between(*YEARS),
        "runtime": at_least("runtime", 1), "budget": at_least("budget", 1), "revenue": at_least("revenue", 1),
        "vote_average": F.col("vote_average").isNull() | F.col("vote_average").between(0, 10),
        "vote_count": F.col("vote_count") >= 0,
        "lists": F.col("genres").isNotNull() & F.col("director").isNotNull() & F.col("cast").isNotNull() & F.col("crew_names").isNotNull(),
        "cast": F.forall("cast", lambda x: x["name"].isNotNull() & (x["order"] >= 0)),
        "crew_roles": F.forall("crew_roles", lambda x: x["name"].isNotNull() & x["job"].isNotNull()),
        "num_reviews": F.col("num_reviews") >= 0,
    }


def validated(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``violations``, the names of broken constraints. With ``strict``
    the job fails on the first row that has any, as a build must."""
    out = rows.withColumn("violations", Q.violations(rules()))
    if not strict:
        return out
    what = F.concat(F.lit("invalid document "), F.col("source_id"), F.lit(": "), F.array_join("violations", ", "))
    return out.withColumn("violations", F.when(F.size("violations") > 0, F.raise_error(what).cast("array<string>")).otherwise(F.col("violations")))


def manifest(sources: Mapping[str, DataFrame], decisions: DataFrame, kids: DataFrame, min_words: int = MIN_PLOT_WORDS) -> DataFrame:
    """The build record as (section, name, value) rows: filters, rows of each
    source, output and drop counts."""
    spark = decisions.sparkSession
    filters = {"reject_non_numeric_movie_id": 1, "require_plot": 1, "strip_footnote_markers": 1, "min_plot_words": min_words}
    out = spark.createDataFrame([("filter", k, v) for k, v in filters.items()], "section string, name string, value long")
    for name, df in sources.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("source").alias("section"), F.lit(name).alias("name"), "value"))
    counted = decisions.agg(F.count_if(F.col("drop_reason").isNull()).alias("documents"), *(F.count_if(F.col("drop_reason") == r).alias(f"dropped_{r}") for r in (NOT_NUMERIC, NO_PLOT, SHORT_PLOT)))
    counted = counted.unpivot([], counted.columns, "name", "value")
    counted = counted.unionByName(kids.agg(F.count(F.lit(1)).alias("value")).select(F.lit("children").alias("name"), "value"))
    return out.unionByName(counted.select(F.lit("output").alias("section"), "name", "value"))


def search_rows(rows: DataFrame, kids: DataFrame) -> DataFrame:
    """Parents and children as rows of one table for indexing: the credit
    structs become parallel lists without nulls, the link struct dotted
    columns, review dates timestamps at midnight UTC; fields of the other kind
    of row are null."""
    pick = lambda c, f: F.filter(F.transform(c, lambda x: x[f]), lambda v: v.isNotNull() & (v.cast("string") != ""))
    flat = rows.select(
        T.composite_key("movie", "movie_id").alias("id"), F.lit("movie").alias("doc_type"), F.lit(None).cast("string").alias("parent_id"),
        *(c for c in rows.columns if c not in ("source_id", "cast", "crew_roles", "wikipedia", "violations")),
        *(pick("cast", f).alias(f"cast.{f}") for f in ("name", "character", "order")), *(pick("crew_roles", f).alias(f"crew_roles.{f}") for f in ("name", "job")),
        *(F.col(f"wikipedia.{f}").alias(f"wikipedia.{f}") for f in LINK_FIELDS))
    own = kids.join(rows.select(F.col("source_id").alias("_sid"), F.col("movie_id").alias("_mid")), F.col("_sid") == kids["movie_id"])
    day = T.date_prefix("created_at")
    own = own.select(
        F.concat(T.composite_key("movie", "_mid"), F.lit("-review-"), F.col("idx").cast("string")).alias("id"), F.lit("review").alias("doc_type"), T.composite_key("movie", "_mid").alias("parent_id"),
        F.col("text").alias("review_text"), F.col("author").alias("review_author"), F.col("rating").alias("review_rating"), F.concat(day, F.lit("T00:00:00Z")).alias("review_created_at"))
    return flat.unionByName(own, allowMissingColumns=True)


def nested(rows: DataFrame, kids: DataFrame, most: int = 100_000) -> DataFrame:
    """Whole documents with their reviews as an array in order. The job fails
    for a movie with more than ``most`` reviews, whose array would not fit a
    row; such collections are read as parents and children."""
    large = F.raise_error(F.concat(F.lit("too many reviews to nest: "), F.col("source_id")))
    checked = rows.withColumn("num_reviews", F.when(F.col("num_reviews") > most, large.cast("int")).otherwise(F.col("num_reviews")))
    small = kids.join(rows.where(F.col("num_reviews") <= most).select(F.col("source_id").alias("movie_id")), "movie_id", "left_semi")
    lists = P.nested_list(small, "movie_id", "idx", ["author", "rating", "text", "created_at"], "reviews").withColumnRenamed("movie_id", "_sid")
    empty = F.array().cast("array<struct<author:string,rating:double,text:string,created_at:string>>")
    return checked.join(lists, F.col("_sid") == F.col("source_id"), "left").withColumn("reviews", F.coalesce("reviews", empty)).drop("_sid", "source_id")


def counters(rows: DataFrame, kids: DataFrame) -> DataFrame:
    """Collection counters in one pass over each table, as (name, value)."""
    rated = kids.groupBy("movie_id").agg(F.count("rating").alias("n")).agg(F.count_if(F.col("n") > 0).cast("double").alias("with_rating"))
    pool = kids.agg(F.count(F.lit(1)).cast("double").alias("reviews"), F.count("rating").cast("double").alias("reviews_rated"), F.round(F.avg("rating"), 4).alias("mean_rating"),
                    F.sum(F.col("n_words").cast("long")).cast("double").alias("review_words"), F.max("n_words").cast("double").alias("longest_review"))
    where = {
        "documents": F.lit(True), "several_directors": F.size("director") > 1, "no_director": F.size("director") == 0, "no_cast": F.size("cast") == 0, "no_crew": F.size("crew_names") == 0,
        "with_review": F.col("num_reviews") > 0, "linked": F.col("wikipedia").isNotNull(), "linked_wikidata": F.col("wikipedia.wikidata_id").isNotNull(), "linked_imdb": F.col("wikipedia.imdb_id").isNotNull(),
    }
    own = rows.agg(*(F.count_if(c).cast("double").alias(n) for n, c in where.items()))
    first, *more = (one.unpivot([], one.columns, "name", "value") for one in (own, rated, pool))
    for other in more:
        first = first.unionByName(other)
    return first
