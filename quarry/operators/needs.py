"""Information needs that each choose their source and their filters.

A need is a row (qid, need, source, filters). Its source says whether child
records (the best one speaks for its parent) or a field of the parent is
ranked. Its filters restrict results and never statistics; each is a struct
of FILTER_TYPE:

    term     an analyzed word stands in one of the field's values
    phrase   one of ``values`` stands, as adjacent analyzed words, inside a
             single value of the field
    exact    the field's value is one of ``values``, case-sensitive
    range    a number between ``low`` and ``high``, both included

``values`` are alternatives, ``negate`` turns a filter round, and all filters
of a need must hold. A missing value fails a filter and passes a negated one.

Filters are evaluated once per document against the needs, of which a counted
and bounded number is held by every task; only (document, needs it passes)
takes part in the join with the scores. More needs are taken in blocks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import analyze as A
from . import search as SR

FILTER_TYPE = "array<struct<op:string,field:string,values:array<string>,low:double,high:double,negate:boolean>>"
REVIEWS, STORY = "reviews", "story"
NEEDS_BLOCK = 1_000
DISPLAY_CHARS = 150


def read_needs(spark: SparkSession, path: str) -> DataFrame:
    """Need definitions, one JSON object in each Q*.json of a folder; the id is
    the file's name. Fails when there is none, when a file's own qid differs
    from its name, and when a source is unknown."""
    rows = spark.read.schema(f"qid string, need string, source string, filters {FILTER_TYPE}").json(path, multiLine=True, pathGlobFilter="Q*.json")
    name = F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1)
    bad = F.when(~F.col("qid").eqNullSafe(name), F.concat(F.lit("id does not match file "), name))
    bad = bad.when(~F.coalesce(F.col("source").isin(REVIEWS, STORY), F.lit(False)), F.concat(F.lit("unknown source in "), name))
    out = rows.select(F.when(bad.isNotNull(), F.raise_error(bad).cast("string")).otherwise(name).alias("qid"), "need", "source", F.coalesce("filters", F.array().cast(FILTER_TYPE)).alias("filters"))
    if out.isEmpty():
        raise ValueError(f"no need definitions in {path}")
    return out


def disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """(qid, field) of the needs on which two setups do not agree; a need that
    only one has disagrees on all fields."""
    fields = ("need", "source", "filters")
    x = a.select("qid", *(F.col(c).cast("string").alias(f"a_{c}") for c in fields), F.lit(True).alias("in_a"))
    y = b.select("qid", *(F.col(c).cast("string").alias(f"b_{c}") for c in fields), F.lit(True).alias("in_b"))
    one_side = F.col("in_a").isNull() | F.col("in_b").isNull()
    differ = F.array(*(F.when(one_side | ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in fields))
    return x.join(y, "qid", "full_outer").select("qid", F.explode(F.filter(differ, lambda c: c.isNotNull())).alias("field"))


def positioned(text: Column) -> Column:
    """The analyzed words of a value between single spaces, a stopword leaving
    a ``*`` in its place, so adjacent words stay adjacent and others do not
    become so."""
    stop = A.stopword_array()
    words = F.transform(A.raw_tokens(text), lambda t: F.when(F.array_contains(stop, t), F.lit("*")).otherwise(A.stem(t)))
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _wanted(value: Column) -> Column:
    """A phrase in the same form, without stopwords at its ends; blank without
    any other word."""
    return F.regexp_replace(positioned(value), r"^( \*)+(?= )|(\* )+$", "")


def prepared(filters: Column) -> Column:
    """Filters with their phrases analyzed, once per need; one without a word
    that counts is left out and matches nothing."""
    wanted = lambda f: F.filter(F.transform(F.coalesce(f["values"], F.array().cast("array<string>")), _wanted), lambda p: F.length(F.trim(p)) > 0)
    return F.transform(filters, lambda f: F.struct(*(f[c].alias(c) for c in ("op", "field", "values", "low", "high", "negate")), wanted(f).alias("phrases")))


def passes(filters: Column, texts: Mapping[str, Column], exact: Mapping[str, Column], numbers: Mapping[str, Column]) -> Column:
    """Whether a row passes a need's filters (as ``prepared`` gives them).
    ``texts`` are arrays of
    ``positioned`` values, ``exact`` arrays of plain values, ``numbers``
    numeric columns. An unknown field or operator is an error."""
    def chosen(field: Column, columns: Mapping[str, Column], kind: str) -> Column:
        first = F.raise_error(F.concat(F.lit("no such field: "), field)).cast(kind)
        for name, column in columns.items():
            first = F.when(field == name, column.cast(kind)).otherwise(first)
        return first

    def holds(f: Column) -> Column:
        words = lambda: F.exists(chosen(f["field"], texts, "array<string>"), lambda v: F.exists(f["phrases"], lambda p: F.contains(v, p)))
        number = chosen(f["field"], numbers, "double")
        own = (F.when(f["op"].isin("term", "phrase"), words()).when(f["op"] == "exact", F.arrays_overlap(chosen(f["field"], exact, "array<string>"), f["values"]))
               .when(f["op"] == "range", (number >= f["low"]) & (number <= f["high"])).otherwise(F.raise_error(F.concat(F.lit("no such filter: "), f["op"])).cast("boolean")))
        return F.coalesce(own, F.lit(False)) != F.coalesce(f["negate"], F.lit(False))

    return F.forall(filters, holds)


def allowed(docs: DataFrame, key: str, needs: DataFrame, texts: Mapping[str, Column], exact: Mapping[str, Column], numbers: Mapping[str, Column]) -> DataFrame:
    """(doc, qids): the needs with filters whose filters each document passes,
    one row per document and block of needs; rows that pass none are left out."""
    rows = docs.select(F.col(key).alias("doc"), *(F.transform(c, positioned).alias(f"_t_{n}") for n, c in texts.items()),
                       *(c.alias(f"_e_{n}") for n, c in exact.items()), *(c.cast("double").alias(f"_n_{n}") for n, c in numbers.items()))
    filtered = needs.where(F.size("filters") > 0).select("qid", prepared(F.col("filters")).alias("filters"))
    total, out = filtered.count(), None
    blocks = max(1, -(-total // NEEDS_BLOCK))
    for i in range(blocks):
        block = filtered.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i)
        held = block.agg(F.collect_list(F.struct("qid", "filters")).alias("_needs")).withColumn("_k", F.lit(1))
        columns = [{n: F.col(f"{p}{n}") for n in kind} for p, kind in (("_t_", texts), ("_e_", exact), ("_n_", numbers))]
        own = rows.withColumn("_k", F.lit(1)).join(F.broadcast(held), "_k")
        qids = F.transform(F.filter("_needs", lambda n: passes(n["filters"], *columns)), lambda n: n["qid"])
        # Behind a generator, else the filters run once to choose rows and once more for the result.
        own = own.select(F.inline(F.array(F.struct("doc", qids.alias("qids"))))).where(F.size("qids") > 0)
        out = own if out is None else out.unionByName(own)
    return out


def restricted(scored: DataFrame, needs: DataFrame, allowed_docs: DataFrame) -> DataFrame:
    """Scored rows that pass their need's filters; scores do not change. The
    needs a document passes travel as one row, so the scored rows are made
    once and, dealt by document, stay where they are."""
    marked = scored.join(F.broadcast(needs.select("qid", (F.size("filters") > 0).alias("_filtered"))), "qid")
    held = allowed_docs.where(F.col("doc").isNotNull()).groupBy("doc").agg(F.flatten(F.collect_list("qids")).alias("_held"))
    # A document that stands in several rows gives each of them.
    times = F.when(~F.col("_filtered"), F.lit(1)).otherwise(F.coalesce(F.size(F.filter("_held", lambda q: q == F.col("qid"))), F.lit(0)))
    rows = marked.join(held, "doc", "left").withColumn("_times", times).where(F.col("_times") > 0)
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).select(*scored.columns)


def search(needs: DataFrame, docs: DataFrame, key: str, story: Column | str, kids: DataFrame, parent: str, child: str, child_text: str,
           allowed_docs: DataFrame, second: Column | str | None = None, k: int = config.RUN_DEPTH) -> DataFrame:
    """(qid, doc, rank, score): every need over its own source with its own
    filters. ``second`` is the field whose score reranks the best ``k`` of the
    story needs (setup B); without it the first ranking stands (setup A)."""
    asked = needs.select("qid", F.col("need").alias("text"), "source")
    of_story = SR.bm25(docs, key, {"story": story}, asked.where(F.col("source") == STORY)).select("qid", "doc", "score")
    of_kids = SR.best_child(kids, parent, child, child_text, asked.where(F.col("source") == REVIEWS)).select("qid", "doc", "score")
    known = of_kids.join(docs.select(F.col(key).alias("doc")), "doc", "left_semi").select("qid", "doc", "score")
    top_story = SR.top_k(restricted(of_story, needs, allowed_docs), k)
    if second is not None:
        top_story = SR.rerank(top_story, docs, key, second, asked.where(F.col("source") == STORY), depth=k, k=k)
    top_kids = SR.top_k(restricted(known, needs, allowed_docs), k)
    return top_story.select("qid", "doc", "rank", "score").unionByName(top_kids.select("qid", "doc", "rank", "score"))


def presented(run: DataFrame, docs: DataFrame, key: str, fields: Mapping[str, Column], excerpt: str | None = None) -> DataFrame:
    """A run with display columns of its documents; ``excerpt`` names one that
    is cut to its first DISPLAY_CHARS characters. Results without a document
    keep null columns."""
    show = {n: F.substring(c, 1, DISPLAY_CHARS) if n == excerpt else c for n, c in fields.items()}
    return run.join(docs.select(F.col(key).alias("doc"), *(c.alias(n) for n, c in show.items())), "doc", "left")


def check_run(run: DataFrame, strict: bool = False) -> DataFrame:
    """(qid, results, missing_id, repeated, wrong_key, gaps, status): results
    without an id, ids returned more than once, ids that are not ``movie-<doc>``
    where the run has an ``id`` column, and ranks that are not 1 to n. With
    ``strict`` a failing need fails the job."""
    wrong = F.count_if(~F.col("id").eqNullSafe(F.concat(F.lit("movie-"), F.col("doc").cast("string")))) if "id" in run.columns else F.lit(0).cast("long")
    per = run.groupBy("qid").agg(
        F.count(F.lit(1)).alias("results"), F.count_if(F.col("doc").isNull()).alias("missing_id"), (F.count("doc") - F.count_distinct("doc")).alias("repeated"), wrong.alias("wrong_key"),
        (F.greatest(F.max("rank"), F.count(F.lit(1))) - F.count_distinct(F.when(F.col("rank") >= 1, F.col("rank")))).cast("long").alias("gaps"))
    fine = (F.col("missing_id") == 0) & (F.col("repeated") == 0) & (F.col("wrong_key") == 0) & (F.col("gaps") == 0)
    failed = F.raise_error(F.concat(F.lit("unstable run for "), F.col("qid").cast("string"))).cast("string") if strict else F.lit("fail")
    return per.withColumn("status", F.when(fine, F.lit("pass")).otherwise(failed))


def boolean_match(docs: DataFrame, key: str, text: Column | str, every: list[str], any_of: list[str]) -> DataFrame:
    """Unranked restriction: documents whose analyzed words hold all of
    ``every`` and, if given, one of ``any_of``."""
    words = A.analyze(text)
    norm = lambda ws: F.flatten(F.array(*(A.analyze(F.lit(w)) for w in ws)))
    hit = F.lit(True)
    if every:
        hit = hit & (F.size(F.array_except(norm(every), words)) == 0)
    if any_of:
        hit = hit & F.arrays_overlap(words, norm(any_of))
    return docs.where(hit).select(key)
