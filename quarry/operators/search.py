"""Ranked retrieval as Spark jobs: postings, field statistics, BM25, top-k.

Ranking definition (Robertson & Zaragoza 2009; the "Lucene (accurate)"
variant of Kamphuis et al. 2020 with exact document lengths):

    idf(t)  = ln(1 + (N - df + 0.5) / (df + 0.5))
    score   = sum_t qtf(t) * idf(t) * tf / (tf + k1 * (1 - b + b * dl / avgdl))

N, df and avgdl are per field over documents that have the field (text not
null); dl is the number of analyzed terms. Statistics are always corpus-wide:
filters restrict candidates after scoring, never the statistics.

Multi-field search: a term's score is the maximum over fields of
``weight * field_score`` (disjunction-max, tie 0), summed over terms.

Plan shape (one query batch = one job):
  documents --(regex tokenize, count inside the row)--> (field, term, doc, dl, tf)
     --broadcast semi-join to the batch's distinct query terms (size checked)-->
     dealt by document                                      [shuffle: matching postings only]
     -> df per (field, term) (aggregate, broadcast back: bounded by query terms)
     -> per-(qid, doc) sum -> WindowGroupLimit top-k per qid.
The rows of (need, document, term) are many times the postings. All
postings of a document lie in one task, so they are made and summed there
and never shuffled; the number of tasks follows from their exact count, sum
of df x needs of the term, so a task's share does not grow with the input.
Hot terms never skew a task: postings are dealt by document, and document
frequency is a partial aggregate.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import analyze as A
from ..functions import counting
from ..functions.scoring import Groups, id_counts, in_lists, matcher, scorer
from ..sources.store import stage
from ..sources.tables import materialize
from .joins import bounded_broadcast, row_count_at_most


def query_terms(queries: DataFrame, qid: str = "qid", text: str = "text",
                stopwords: Iterable[str] | None = None) -> DataFrame:
    """(qid, term, qtf): analyzed query terms with their count in the query."""
    return (
        queries.select(F.col(qid).alias("qid"), F.explode(A.analyze(text, stopwords)).alias("term"))
        .groupBy("qid", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def field_texts(docs: DataFrame, key: str, fields: Mapping[str, Column | str],
                keep: Column | None = None) -> DataFrame:
    """Stack the searchable fields of a document table: (doc, field, text,
    _keep). One scan of ``docs`` regardless of the number of fields.
    ``keep`` is a document filter carried along (not applied) so statistics
    stay corpus-wide."""
    structs = [
        F.struct(F.lit(name).alias("field"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("text"))
        for name, c in fields.items()
    ]
    return (
        docs.select(F.col(key).alias("doc"), F.coalesce(keep, F.lit(False)).alias("_keep") if keep is not None
                    else F.lit(True).alias("_keep"), F.explode(F.array(*structs)).alias("f"))
        .select("doc", F.col("f.field").alias("field"), F.col("f.text").alias("text"), "_keep")
        .filter(F.col("text").isNotNull())
    )


Analyzer = Callable[[Column], Column]


def _terms_of(text: Column, stopwords: Iterable[str] | None, analyzer: Analyzer | None) -> Column:
    return analyzer(text) if analyzer is not None else A.analyze(text, stopwords)


def field_stats(texts: DataFrame, stopwords: Iterable[str] | None = None,
                analyzer: Analyzer | None = None) -> DataFrame:
    """(field, n_docs, avgdl) over documents that have the field."""
    dl = F.size(analyzer(F.col("text"))) if analyzer is not None else A.analyzed_length("text", stopwords)
    return texts.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.avg(dl.cast("double")).alias("avgdl"),
    )


def term_rows(texts: DataFrame, stopwords: Iterable[str] | None = None,
              analyzer: Analyzer | None = None) -> DataFrame:
    """(field, term, doc, dl, _keep, tf): the counted terms of every text and
    one null-term length row, without a shuffle and in document order. Texts
    are cut and counted many at a time over their characters
    (``functions.counting``); those of other than common Latin characters are
    cut here, and those of an analyzer without ``of_tokens`` analyzed here.
    Texts that share a key give a row each; readers add them up (``_merged``)."""
    given, of_tokens = _to_count(texts, stopwords, analyzer)
    out = "field string, term string, doc {}, dl int, _keep boolean, tf long".format(texts.schema["doc"].dataType.simpleString())
    return given.mapInArrow(counting.counter(of_tokens), out)


def _to_count(texts: DataFrame, stopwords: Iterable[str] | None, analyzer: Analyzer | None) -> tuple[DataFrame, counting.Analyzer]:
    """What ``counting.counter`` reads, and what it finds in a text's tokens."""
    of_tokens = counting.stems(stopwords) if analyzer is None else getattr(analyzer, "of_tokens", None)
    if of_tokens is not None:
        simple, cut = (F.octet_length("text") == F.char_length("text")) | F.col("text").rlike(counting.SIMPLE), A.raw_tokens("text")
    else:
        simple, cut, of_tokens = F.lit(False), analyzer(F.col("text")), counting.as_is
    seen = materialize(texts.select("field", "doc", "_keep", "text"), simple=simple)
    return materialize(seen, text=F.when(F.col("simple"), F.col("text")), tokens=F.when(~F.col("simple"), cut)).drop("simple"), of_tokens


def _merged(rows: DataFrame) -> DataFrame:
    """Postings of texts with the same key and length added up. On rows dealt
    by document this needs no shuffle."""
    return rows.groupBy(*[c for c in rows.columns if c != "tf"]).agg(F.sum("tf").alias("tf"))


def _by_doc(rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` dealt by document so that about TASK_ROWS of the ``n_rows``
    made from them fall on a task, on at least one task per core. The count
    is stated, as otherwise Spark merges partitions by their size before the
    rows multiply."""
    least = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(least, -(-int(n_rows) // config.TASK_ROWS)), "doc")


def doc_positions(texts: DataFrame, stopwords: Iterable[str] | None = None) -> DataFrame:
    """(doc, field, pos, term): positions counted before stopword removal."""
    return (
        texts.select("doc", "field", "_keep", F.posexplode(A.raw_tokens("text")).alias("pos", "tok"))
        .filter(~A.is_stopword(F.col("tok"), stopwords))
        .select("doc", "field", "_keep", "pos", A.stem(F.col("tok")).alias("term"))
    )


def postings(texts: DataFrame, terms: DataFrame | None = None,
             stopwords: Iterable[str] | None = None, analyzer: Analyzer | None = None) -> DataFrame:
    """(field, term, doc, dl, _keep, tf). With ``terms`` (a ``term`` column,
    bounded size) only those terms are kept. Postings are counted inside the
    row; only where a key repeats are they shuffled and added up."""
    repeated = not texts.groupBy("field", "doc").count().where("count > 1").isEmpty()
    occ = term_rows(texts, stopwords, analyzer).where(F.col("term").isNotNull())
    if terms is not None:
        occ = occ.join(terms.select("term").distinct(), "term", "left_semi")
    return _merged(occ) if repeated else occ


def _bm25_expr(tf: Column, dl: Column, df: Column, n: Column, avgdl: Column,
               k1: float, b: float) -> Column:
    idf = F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / avgdl)
    return idf * tf / (tf + norm)


def query_rows(texts: DataFrame, terms: DataFrame, small: bool,
               stopwords: Iterable[str] | None = None,
               analyzer: Analyzer | None = None) -> DataFrame:
    """``term_rows`` of the query terms and all length rows, from one
    tokenization pass, written once to the shared checkpoint folder:
    statistics, document frequencies and scores read it instead of
    re-tokenizing the corpus, and a lost executor does not send the job back
    to the scan."""
    flags = terms.select("term").distinct().withColumn("_q", F.lit(True))
    flagged = term_rows(texts, stopwords, analyzer).join(F.broadcast(flags) if small else flags, "term", "left")
    kept = flagged.filter(F.col("term").isNull() | F.col("_q"))
    return stage(kept.select("field", "term", "doc", "dl", "_keep", "tf"), "postings")


def build_index(docs: DataFrame, key: str, fields: Mapping[str, Column | str],
                stopwords: Iterable[str] | None = None, analyzer: Analyzer | None = None) -> DataFrame:
    """IR3: the full inverted index of the fields: (field, term, doc, dl, tf)
    for every analyzed term, plus one null-term length row per (doc, field)
    carrying dl, so field statistics come from the same table. Built once
    and stored (``sources.store.derived``); rankings then read it instead of
    tokenizing the corpus. Nothing is shuffled, and rows stand in document
    order, so the stored doc and dl columns are runs of equal values."""
    return term_rows(field_texts(docs, key, fields), stopwords, analyzer).drop("_keep")


def build_lists(docs: DataFrame, key: str, fields: Mapping[str, Column | str],
                stopwords: Iterable[str] | None = None, analyzer: Analyzer | None = None) -> DataFrame:
    """The same index with a text's postings in one row: (field, doc, dl,
    terms, tfs). Its readers see to a text's terms at once."""
    given, of_tokens = _to_count(field_texts(docs, key, fields), stopwords, analyzer)
    out = "field string, doc {}, dl int, terms array<string>, tfs array<int>".format(given.schema["doc"].dataType.simpleString())
    return given.mapInArrow(counting.counter(of_tokens, lists=True), out)


def _listed(index: DataFrame | None) -> bool:
    return index is not None and "terms" in index.columns


def _as_rows(index: DataFrame) -> DataFrame:
    """``build_index`` rows of an index of either form."""
    if not _listed(index):
        return index
    none = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).alias("tf")))
    held = F.concat(none, F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf")))
    return index.select("field", "doc", "dl", F.inline(held).alias("term", "tf")).select("field", "term", "doc", "dl", F.col("tf").cast("long").alias("tf"))


def _matched(index: DataFrame, places: Mapping[tuple[str, str], int]) -> DataFrame:
    """(field, doc, dl, ids, tfs) of all texts of a listed index, with the
    asked (field, term) only, written once."""
    asked: dict[str, tuple[list[str], list[int]]] = {}
    for (field, term), i in places.items():
        terms, ids = asked.setdefault(field, ([], []))
        terms.append(term)
        ids.append(i)
    out = "field string, doc {}, dl int, ids array<int>, tfs array<int>".format(index.schema["doc"].dataType.simpleString())
    return stage(index.mapInArrow(matcher(asked), out), "matched")


def _ranked_lists(index: DataFrame, of: Mapping[str, Mapping[str, Sequence[str]]], weights: Mapping[str, float],
                  needs: DataFrame, name: str, min_match: int = 1, k1: float = config.BM25_K1, b: float = config.BM25_B,
                  among: DataFrame | None = None, best: int | None = None) -> DataFrame | None:
    """(qid, doc, score, matched) from a listed index: a word (``name``) of a
    need is worth the most that a field gives it, its weight times the sum of
    the word's terms in ``of``. None where a document has two texts in a
    field, which the rows of an index say how to add up."""
    words = {w: i for i, w in enumerate(dict.fromkeys(w for x in of.values() for w in x))}
    places: dict[tuple[str, str], int] = {}
    for f, x in of.items():
        for terms in x.values():
            for t in terms:
                places.setdefault((f, t), len(places))
    texts = _matched(index, places)
    if not texts.groupBy("field", "doc").count().where("count > 1").isEmpty():
        return None
    stats = {r.field: r for r in texts.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.col("dl").cast("double")).alias("avgdl")).collect()}
    df, n_docs, avgdl = np.zeros(len(places)), np.zeros(len(places)), np.ones(len(places))
    for r in texts.mapInArrow(id_counts, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        df[r.id] = r.n
    for (f, _), i in places.items():
        if f in stats:
            n_docs[i], avgdl[i] = stats[f].n_docs, stats[f].avgdl or 1.0
    idf = np.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))
    if among is not None:
        texts = texts.join(bounded_broadcast(among.select("doc").distinct()), "doc", "left_semi")
    qids, wants = _needs_of(needs, name, words)
    groups = [(Groups([[places[f, t] for t in of[f].get(w, ())] for w in words]), float(weights.get(f, 1.0))) for f in of]
    score = scorer(qids, wants, len(places), groups, min_match, best, in_lists(idf, avgdl, k1, b))
    rows = _by_doc(texts.select("doc", "dl", "ids", "tfs"), max(df.sum(), len(qids) * n_docs.max(initial=0))).sortWithinPartitions("doc")
    kinds = needs.schema["qid"].dataType.simpleString(), texts.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(score, "qid {}, doc {}, score double, matched long".format(*kinds))


def _statistics(rows: DataFrame, qterms: DataFrame, small: bool, write: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """(postings of the query terms, df per (field, term), field statistics,
    whether postings still have to be merged) of ``term_rows`` rows.
    ``qterms`` may name a ``field`` per term, and an ``id`` that its postings
    then carry. Texts that share key and length count as one document, which
    only then costs a shuffle. With ``write`` the postings and length rows are
    written once, so that a whole index is not searched by each reader."""
    on = ["field", "term"] if "field" in qterms.columns else ["term"]
    if "_keep" not in rows.columns:
        rows = rows.withColumn("_keep", F.lit(True))
    held = ["id"] if "id" in qterms.columns else []
    columns = ["field", "term", "doc", "dl", "_keep", "tf", *held]
    terms = qterms.select(*on, *held).distinct()
    if not held:
        terms = terms.withColumn("id", F.lit(0))
    terms = F.broadcast(terms) if small else terms
    if write:
        rows = rows.join(terms, on, "left").where(F.col("term").isNull() | F.col("id").isNotNull())
        rows = stage(rows.select(*columns), "matched")
        post = rows.where(F.col("term").isNotNull())
    else:
        post = rows.where(F.col("term").isNotNull()).join(terms, on).select(*columns)
    lengths = rows.filter(F.col("term").isNull()).groupBy("field", "doc", "dl", "_keep").agg(F.count(F.lit(1)).alias("n"))
    stats = stage(lengths.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg(F.col("dl").cast("double")).alias("avgdl"), F.max("n").alias("_most")), "stats")
    repeated = (stats.agg(F.max("_most")).first()[0] or 1) > 1
    dfs = stage((_merged(post) if repeated else post).groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")), "dfs")
    return post, dfs, stats.drop("_most"), repeated


def index_postings(index: DataFrame, qterms: DataFrame, small: bool) -> tuple[DataFrame, DataFrame]:
    """(postings of the query terms, field statistics) read from an index."""
    if _listed(index) and qterms.count() <= config.HELD_TERMS:
        terms = [r.term for r in qterms.select("term").distinct().collect()]
        places = {(r.field, t): i for i, (r, t) in enumerate((r, t) for r in index.select("field").distinct().collect() for t in terms)}
        named = _table(qterms, id=pa.array(places.values(), pa.int32()), term=pa.array([t for _, t in places], pa.string()))
        texts = _matched(index, places)
        none = F.array(F.struct(F.lit(None).cast("int").alias("id"), F.lit(1).alias("tf")))
        rows = texts.select("field", "doc", "dl", F.inline(F.concat(none, F.arrays_zip(F.col("ids").alias("id"), F.col("tfs").alias("tf")))).alias("id", "tf"))
        index = rows.join(F.broadcast(named), "id", "left").select("field", "term", "doc", "dl", F.col("tf").cast("long").alias("tf"))
    post, _, stats, repeated = _statistics(_as_rows(index), qterms, small)
    return _merged(post) if repeated else post, stats


def bm25_term_scores(docs: DataFrame, key: str, fields: Mapping[str, Column | str],
                     qterms: DataFrame, weights: Mapping[str, float] | None = None,
                     k1: float = config.BM25_K1, b: float = config.BM25_B,
                     stopwords: Iterable[str] | None = None,
                     candidates: DataFrame | None = None,
                     keep: Column | None = None,
                     analyzer: Analyzer | None = None,
                     index: DataFrame | None = None) -> DataFrame:
    """(qid, doc, term, s): per-term score, max over weighted fields.
    With ``index`` (from ``build_index`` over the same fields and analyzer)
    the postings come from the stored index instead of the documents.
    ``candidates`` (qid, doc) restricts the scored documents after the
    statistics are taken, so filters never change idf or avgdl. The rows are
    dealt by document, so sums per document need no shuffle."""
    small = row_count_at_most(qterms, config.BROADCAST_MAX_ROWS)
    worth = _term_worth(docs, key, fields, qterms, qterms, small, weights, k1, b, stopwords, candidates, keep, analyzer, index)
    scored = _asked(worth, qterms, small, ["term"])
    if candidates is not None:
        scored = scored.join(bounded_broadcast(candidates.select("qid", "doc")), ["qid", "doc"])
    return scored.select("qid", "doc", "term", "s")


def _term_worth(docs: DataFrame, key: str, fields: Mapping[str, Column | str], terms: DataFrame, qterms: DataFrame, small: bool,
                weights: Mapping[str, float] | None, k1: float, b: float, stopwords: Iterable[str] | None,
                candidates: DataFrame | None = None, keep: Column | None = None,
                analyzer: Analyzer | None = None, index: DataFrame | None = None, among: DataFrame | None = None) -> DataFrame:
    """(doc, term, _worth), and ``id`` if ``terms`` has one: what the postings
    of ``terms`` add to a score, in the best field, dealt by document."""
    stored = index is not None and keep is None
    rows = _as_rows(index) if stored else query_rows(field_texts(docs, key, fields, keep), terms, small, stopwords, analyzer)
    post, dfs, stats, repeated = _statistics(rows, terms, small, write=stored)
    if keep is not None:
        post = post.filter(F.col("_keep"))
    weights = dict(weights or {})
    wcol = F.lit(1.0)
    for name, w in weights.items():
        wcol = F.when(F.col("field") == name, F.lit(float(w))).otherwise(wcol)
    if among is not None:
        post = post.join(bounded_broadcast(among.select("doc").distinct()), "doc", "left_semi")
    made = _rows_made(dfs, qterms, ["term"]) if candidates is None else None
    if candidates is not None:
        post = post.join(bounded_broadcast(candidates.select("doc").distinct()), "doc", "left_semi")
    worth = _dealt_worth(post, dfs, stats, small, wcol, k1, b, repeated, made)
    if len(fields) > 1:  # qtf is the same for all fields, so the best field is found before the needs
        worth = worth.groupBy("doc", *[c for c in ("term", "id") if c in worth.columns]).agg(F.max("_worth").alias("_worth"))
    return worth


def _table(of: DataFrame, **columns: pa.Array) -> DataFrame:
    """A small table of the driver, made without Python workers."""
    return of.sparkSession.createDataFrame(pa.table(columns))


def _held(rows: DataFrame) -> bool:
    """Whether the query terms, each as often as it is asked for, are few
    enough to be held as arrays by every task."""
    return (rows.agg(F.sum("qtf")).first()[0] or 0) <= config.HELD_TERMS


def _needs_of(rows: DataFrame, name: str, places: Mapping[str, int]) -> tuple[pa.Array, Groups]:
    """(qids, the places of each need's words or terms, as often as it holds them)."""
    got = rows.groupBy("qid").agg(F.collect_list(F.struct(F.col(name).alias("x"), "qtf")).alias("of")).toArrow().combine_chunks()
    return got.column("qid").combine_chunks(), Groups([[places[y["x"]] for y in x for _ in range(y["qtf"])] for x in got.column("of").to_pylist()])


def _scored(worth: DataFrame, like: DataFrame, score: Callable) -> DataFrame:
    """(qid, doc, score, matched) of postings (doc, id, _worth) dealt by
    document: scored block by block, with a document's rows together."""
    rows = worth.select("doc", "id", F.col("_worth").alias("worth")).sortWithinPartitions("doc")
    kinds = like.schema["qid"].dataType.simpleString(), worth.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(score, "qid {}, doc {}, score double, matched long".format(*kinds))


def _rows_made(dfs: DataFrame, qterms: DataFrame, on: Sequence[str]) -> int:
    """Rows of (need, document, term) that postings and query terms give."""
    return dfs.join(qterms.groupBy(*on).agg(F.count(F.lit(1)).alias("n")), list(on)).agg(F.sum(F.col("df") * F.col("n"))).first()[0] or 0


def _worth(post: DataFrame, dfs: DataFrame, stats: DataFrame, small: bool, weight: Column,
           k1: float = config.BM25_K1, b: float = config.BM25_B) -> DataFrame:
    """(field, term, doc, _worth): what a posting adds to a score, whatever the
    need, made once per posting."""
    return (
        post.join(F.broadcast(dfs) if small else dfs, ["field", "term"])
        .join(F.broadcast(stats), "field")  # one row per field
        .select("field", "term", "doc", *[c for c in post.columns if c == "id"], (weight * _bm25_expr(
            F.col("tf"), F.col("dl"), F.col("df"), F.col("n_docs"), F.col("avgdl"), k1, b)).alias("_worth"))
    )


def _dealt_worth(post: DataFrame, dfs: DataFrame, stats: DataFrame, small: bool, weight: Column, k1: float, b: float,
                 repeated: bool, made: int | None) -> DataFrame:
    """``_worth`` of postings, dealt by document for ``made`` rows. Where no
    key repeats, only what a posting is worth is shuffled."""
    if repeated:
        return _worth(_merged(post if made is None else _by_doc(post, made)), dfs, stats, small, weight, k1, b)
    worth = _worth(post, dfs, stats, small, weight, k1, b)
    worth = worth.drop("field") if "id" in worth.columns else worth
    return worth if made is None else _by_doc(worth, made)


def _asked(worth: DataFrame, qterms: DataFrame, small: bool, on: Sequence[str]) -> DataFrame:
    """Every posting with the query terms it answers and ``s``, its score."""
    scored = worth.join(F.broadcast(qterms) if small else qterms, list(on))
    return scored.withColumn("s", F.col("qtf") * F.col("_worth"))


def bm25(docs: DataFrame, key: str, fields: Mapping[str, Column | str] | str,
         queries: DataFrame, qid: str = "qid", text: str = "text",
         weights: Mapping[str, float] | None = None, min_match: int = 1,
         k1: float = config.BM25_K1, b: float = config.BM25_B,
         stopwords: Iterable[str] | None = None, keep: Column | None = None,
         candidates: DataFrame | None = None, index: DataFrame | None = None,
         among: DataFrame | None = None, best: int | None = None) -> DataFrame:
    """(qid, doc, score, matched): every document matching >= ``min_match``
    distinct query terms, scored. ``keep`` (a predicate over ``docs``),
    ``candidates`` (qid, doc) and ``among`` (doc) filter results, never
    statistics (IR11). With ``best``, for a ranking that follows at once, rows
    may be left out that are not among so many of a need (``top_k``)."""
    if isinstance(fields, str):
        fields = {fields: fields}
    qterms = query_terms(queries, qid, text, stopwords)
    held = candidates is None and _held(qterms)
    out = None
    if held and keep is None and _listed(index):
        terms = [r.term for r in qterms.select("term").distinct().collect()]
        out = _ranked_lists(index, {f: {t: [t] for t in terms} for f in fields}, dict(weights or {}), qterms, "term", min_match, k1, b, among, best)
    if out is not None:
        return out
    if held:
        places = {r.term: i for i, r in enumerate(qterms.select("term").distinct().collect())}
        terms = _table(qterms, term=pa.array(places, pa.string()), id=pa.array(places.values(), pa.int32()))
        qids, needs = _needs_of(qterms, "term", places)
        worth = _term_worth(docs, key, fields, terms, terms, True, weights, k1, b, stopwords, None, keep, index=index, among=among)
        out = _scored(worth, qterms, scorer(qids, needs, len(places), min_match=min_match, best=best))
    else:
        ts = bm25_term_scores(docs, key, fields, qterms, weights, k1, b, stopwords, candidates, keep, index=index)
        if among is not None:
            ts = ts.join(bounded_broadcast(among.select("doc").distinct()), "doc", "left_semi")
        out = ts.groupBy("qid", "doc").agg(F.sum("s").alias("score"), F.count(F.lit(1)).alias("matched"))
    return out.filter(F.col("matched") >= F.lit(min_match))


def top_k(scored: DataFrame, k: int = config.RUN_DEPTH, part: str | list[str] = "qid",
          score: str = "score", doc: str = "doc", precision: int = 6) -> DataFrame:
    """Keep the best ``k`` rows per partition with a total order
    (score rounded to ``precision`` decimals desc, doc asc) and a 1-based
    ``rank``. ``row_number() <= k`` is planned as WindowGroupLimit, so each
    map task forwards at most k rows per partition key."""
    part = [part] if isinstance(part, str) else list(part)
    w = Window.partitionBy(*part).orderBy(F.round(F.col(score), precision).desc(), F.col(doc).asc())
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(k))


def rerank(top: DataFrame, docs: DataFrame, key: str, field: Column | str, queries: DataFrame,
           qid: str = "qid", text: str = "text", weight: float = 1.0, depth: int = config.RUN_DEPTH,
           k: int = config.RUN_DEPTH, stopwords: Iterable[str] | None = None) -> DataFrame:
    """WR14 / IR12: the first ``depth`` rows of a ranking get
    ``score + weight * second_score`` (second score 0 when the second query
    does not match), the others keep their score; then re-ranked. Only the
    ``depth`` candidates per need are scored by the second query. The first
    ranking (at most a run's depth per need) is written once, as it is read
    for the candidates and for the result."""
    top = stage(top.select("qid", "doc", "rank", "score"), "ranking")
    cand = top.filter(F.col("rank") <= depth).select("qid", "doc")
    qterms = query_terms(queries, qid, text, stopwords)
    ts = bm25_term_scores(docs, key, {"second": field}, qterms, stopwords=stopwords, candidates=cand)
    s2 = ts.groupBy("qid", "doc").agg(F.sum("s").alias("_s2"))
    new = top.join(s2, ["qid", "doc"], "left").select(
        "qid", "doc",
        F.when(F.col("rank") <= depth, F.col("score") + F.lit(weight) * F.coalesce("_s2", F.lit(0.0)))
        .otherwise(F.col("score")).alias("score"),
    )
    return top_k(new, k)


def num_found(scored: DataFrame) -> DataFrame:
    """(qid, num_found): matching documents per query before the limit."""
    return scored.groupBy("qid").agg(F.count(F.lit(1)).alias("num_found"))


# --- positions, phrases ----------------------------------------------------

def query_positions(queries: DataFrame, qid: str = "qid", text: str = "text",
                    stopwords: Iterable[str] | None = None) -> DataFrame:
    """(qid, pos, term) of the analyzed query; positions before stopword
    removal."""
    return (
        queries.select(F.col(qid).alias("qid"), F.posexplode(A.raw_tokens(text)).alias("pos", "tok"))
        .filter(~A.is_stopword(F.col("tok"), stopwords))
        .select("qid", "pos", A.stem(F.col("tok")).alias("term"))
    )


def query_bigrams(queries: DataFrame, qid: str = "qid", text: str = "text",
                  stopwords: Iterable[str] | None = None) -> DataFrame:
    """(qid, idx, t1, t2, gap): consecutive analyzed query terms; ``gap`` is
    their position difference (> 1 when a stopword sat between them).
    The window runs inside one query (bounded by its length)."""
    qp = query_positions(queries, qid, text, stopwords)
    w = Window.partitionBy("qid").orderBy("pos")
    nxt = qp.withColumn("t2", F.lead("term").over(w)).withColumn("p2", F.lead("pos").over(w)).withColumn(
        "idx", F.row_number().over(w) - 1
    )
    return nxt.filter(F.col("t2").isNotNull()).select(
        "qid", "idx", F.col("term").alias("t1"), "t2", (F.col("p2") - F.col("pos")).alias("gap")
    )


def doc_terms(texts: DataFrame, stopwords: Iterable[str] | None = None) -> DataFrame:
    """(field, doc, terms): the analyzed words of a text in place, null where a
    stopword stands, so a term's position is its place in the array."""
    given, of_tokens = _to_count(texts, stopwords, None)
    return given.mapInArrow(counting.placer(of_tokens), "field string, doc {}, terms array<string>".format(texts.schema["doc"].dataType.simpleString()))


def build_position_index(docs: DataFrame, key: str, fields: Mapping[str, Column | str],
                         stopwords: Iterable[str] | None = None) -> DataFrame:
    """Positional index (field, doc, terms), see ``doc_terms``; built once and
    stored like ``build_index``."""
    return doc_terms(field_texts(docs, key, fields), stopwords)


def phrase_occurrences(texts: DataFrame | None, phrases: DataFrame, slop: int = 0,
                       stopwords: Iterable[str] | None = None,
                       positions: DataFrame | None = None) -> DataFrame:
    """(qid, idx, doc, field, dist) one row per occurrence of a two-term
    phrase (t1 then t2 at distance gap .. gap + slop).

    A text's words stand in one row (``doc_terms``), so each looks there at
    those that follow it at the phrases' distances, and the pairs of
    neighbours are looked up among the phrases: only real neighbours meet,
    whatever the number of phrases that begin with a term, and no position is
    shuffled. Texts that share key and field count as one; only their
    positions are dealt by document, where a window gives each its followers."""
    small = row_count_at_most(phrases, config.BROADCAST_MAX_ROWS)
    ph = F.broadcast(phrases) if small else phrases
    keys = (texts if positions is None else positions).where(F.col("doc").isNotNull()).groupBy("doc", "field").count()
    keys = stage(keys.where("count > 1").select("doc", "field"), "repeated")
    src = (positions if positions is not None else doc_terms(texts, stopwords)).where(F.col("doc").isNotNull())
    if keys.isEmpty():
        pairs = _near_in_row(src, phrases, small, slop)
    else:
        keys = bounded_broadcast(keys)
        pairs = _near_in_row(src.join(keys, ["doc", "field"], "left_anti"), phrases, small, slop).unionByName(
            _near_by_doc(src.join(keys, ["doc", "field"], "left_semi"), phrases, small, slop))
    return pairs.join(ph, ["t1", "t2"]).where(F.col("dist").between(F.col("gap"), F.col("gap") + F.lit(slop))).select(
        "qid", "idx", "doc", "field", "dist"
    )


def _near_in_row(src: DataFrame, phrases: DataFrame, small: bool, slop: int) -> DataFrame:
    """(doc, field, t1, t2, dist) of the words of a row that begin a phrase and
    the words at the distances of such phrases."""
    dists = F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("gap"), F.col("gap") + F.lit(int(slop)))))).alias("dists")
    at = src.select("doc", "field", "terms", F.posexplode("terms").alias("p1", "t1")).where(F.col("t1").isNotNull())
    at = at.join(F.broadcast(phrases.groupBy("t1").agg(dists)), "t1") if small else at.crossJoin(F.broadcast(phrases.agg(dists)))
    near = at.select("doc", "field", "t1", "p1", "terms", F.explode("dists").alias("dist"))
    near = near.select("doc", "field", "t1", F.get("terms", F.col("p1") + F.col("dist")).alias("t2"), "dist")
    return near.where(F.col("t2").isNotNull())


def _near_by_doc(src: DataFrame, phrases: DataFrame, small: bool, slop: int) -> DataFrame:
    """The same across all texts of a key: positions of the phrases' terms are
    dealt by document, and a window collects those that follow."""
    terms = phrases.select(F.col("t1").alias("term")).unionByName(phrases.select(F.col("t2").alias("term"))).distinct()
    pos = src.select("doc", "field", F.posexplode("terms").alias("pos", "term")).where(F.col("term").isNotNull())
    pos = pos.join(F.broadcast(terms) if small else terms, "term", "left_semi")
    pos = pos.select("doc", "field", "pos", "term")
    low, high = phrases.agg(F.min("gap"), F.max("gap")).first()
    ahead = Window.partitionBy("doc", "field").orderBy("pos").rangeBetween(low or 0, (high or 0) + int(slop))
    near = _by_doc(pos, pos.count()).withColumn("next", F.collect_list(F.struct(F.col("pos").alias("p2"), F.col("term").alias("t2"))).over(ahead))
    return near.select("doc", "field", F.col("term").alias("t1"), F.col("pos").alias("p1"), F.inline("next")).select(
        "doc", "field", "t1", "t2", (F.col("p2") - F.col("p1")).alias("dist")
    )


def phrase_scores(docs: DataFrame, key: str, fields: Mapping[str, Column | str], queries: DataFrame,
                  qid: str = "qid", text: str = "text", slop: int = 1,
                  weights: Mapping[str, float] | None = None,
                  k1: float = config.BM25_K1, b: float = config.BM25_B,
                  stopwords: Iterable[str] | None = None, index: DataFrame | None = None,
                  positions: DataFrame | None = None, among: DataFrame | None = None) -> DataFrame:
    """IR7 word-pair boost: (qid, doc, s) summed over the query's adjacent
    pairs, for all documents or those ``among`` (doc). Per pair and field: sloppy frequency sum(1 / (1 + dist - gap))
    scored by BM25 with idf(t1) + idf(t2); max over weighted fields.
    With ``index`` and ``positions`` (stored indexes of the same fields) no
    document is tokenized."""
    weights = dict(weights or {})
    texts = field_texts(docs, key, fields) if index is None or positions is None else None
    bg = query_bigrams(queries, qid, text, stopwords)
    small = row_count_at_most(bg, config.BROADCAST_MAX_ROWS)
    qterms = bg.select(F.col("t1").alias("term")).unionByName(bg.select(F.col("t2").alias("term"))).distinct()
    if index is not None:
        post, stats = index_postings(index, qterms, small)
    else:
        post, stats = index_postings(query_rows(texts, qterms, small, stopwords), qterms, small)
    stats = F.broadcast(stats)
    dfs = F.broadcast(post.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")))
    if among is not None:
        among = bounded_broadcast(among.select("doc").distinct())
        post = post.join(among, "doc", "left_semi")
        texts = texts.join(among, "doc", "left_semi") if texts is not None else None
        positions = positions.join(among, "doc", "left_semi") if positions is not None else None
    lens = post.select("doc", "field", "dl").distinct()
    occ = phrase_occurrences(texts, bg, slop, stopwords, positions).join(
        F.broadcast(bg.select("qid", "idx", "gap")), ["qid", "idx"]
    )
    freq = occ.groupBy("qid", "idx", "doc", "field").agg(
        F.sum(F.lit(1.0) / (F.lit(1) + F.col("dist") - F.col("gap"))).alias("pf")
    )
    idf = lambda df: F.log(F.lit(1.0) + (F.col("n_docs") - df + F.lit(0.5)) / (df + F.lit(0.5)))
    d1 = dfs.select("field", F.col("term").alias("t1"), F.col("df").alias("df1"))
    d2 = dfs.select("field", F.col("term").alias("t2"), F.col("df").alias("df2"))
    wcol = F.lit(1.0)
    for name, w in weights.items():
        wcol = F.when(F.col("field") == name, F.lit(float(w))).otherwise(wcol)
    j = (
        freq.join(F.broadcast(bg.select("qid", "idx", "t1", "t2")), ["qid", "idx"])
        .join(lens, ["doc", "field"])
        .join(stats, "field")
        .join(d1, ["field", "t1"])
        .join(d2, ["field", "t2"])
    )
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.col("avgdl"))
    s = wcol * (idf(F.col("df1")) + idf(F.col("df2"))) * F.col("pf") / (F.col("pf") + norm)
    per = j.select("qid", "idx", "doc", s.alias("s")).groupBy("qid", "idx", "doc").agg(F.max("s").alias("s"))
    return per.groupBy("qid", "doc").agg(F.sum("s").alias("s"))


def with_boost(scored: DataFrame, boost: DataFrame) -> DataFrame:
    """(qid, doc, score) with the boost (qid, doc, s) of a row added. A
    document's boosts travel as one row, so the join is by document alone
    and the scored rows, dealt by document, stay where they are."""
    held = boost.where(F.col("qid").isNotNull()).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("qid", "s"))).alias("_held"))
    return scored.join(held, "doc", "left").select(
        "qid", "doc", (F.col("score") + F.coalesce(F.try_element_at("_held", F.col("qid")), F.lit(0.0))).alias("score")
    )


def without(scored: DataFrame, excluded: DataFrame) -> DataFrame:
    """Scored rows but those of ``excluded`` (qid, doc), joined by document
    like ``with_boost``."""
    held = excluded.groupBy("doc").agg(F.collect_set("qid").alias("_held"))
    return scored.join(held, "doc", "left").where(~F.coalesce(F.array_contains("_held", F.col("qid")), F.lit(False))).select(*scored.columns)


def best_child(children: DataFrame, parent_key: str, child_key: Sequence[str] | str, text: str,
               queries: DataFrame, qid: str = "qid", qtext: str = "text", min_match: int = 1,
               stopwords: Iterable[str] | None = None) -> DataFrame:
    """IR10 / JN11: score child records (statistics over children), keep the
    best child score per parent: (qid, doc = parent, score)."""
    child_key = [child_key] if isinstance(child_key, str) else list(child_key)
    kids = children.select(
        F.struct(*[F.col(c) for c in [parent_key] + child_key]).alias("_ck"), F.col(text).alias("_t")
    )
    scored = bm25(kids, "_ck", {"child": "_t"}, queries, qid, qtext, min_match=min_match, stopwords=stopwords)
    return scored.groupBy("qid", F.col(f"doc.{parent_key}").alias("doc")).agg(F.max("score").alias("score"))


# --- character n-gram field --------------------------------------------------

def gram_analyzer(n: int = 3, stopwords: Iterable[str] | None = None) -> Analyzer:
    """IR13 analyzer: fold, lower, word tokens, stopwords removed, no stem,
    then the token-internal character n-grams of every token."""
    def run(text: Column) -> Column:
        kept = F.filter(A.raw_tokens(text), lambda t: ~A.is_stopword(t, stopwords))
        return F.flatten(F.transform(kept, lambda t: A.char_ngrams(t, n)))

    run.of_tokens = counting.grams(n, stopwords)
    return run


def query_words(queries: DataFrame, qid: str = "qid", text: str = "text",
                stopwords: Iterable[str] | None = None) -> DataFrame:
    """(qid, word, qtf): analyzed query words before stemming."""
    kept = F.filter(A.raw_tokens(text), lambda t: ~A.is_stopword(t, stopwords))
    return (
        queries.select(F.col(qid).alias("qid"), F.explode(kept).alias("word"))
        .groupBy("qid", "word").agg(F.count(F.lit(1)).alias("qtf"))
    )


def gram_search(docs: DataFrame, key: str, field: Column | str, queries: DataFrame,
                qid: str = "qid", text: str = "text", gram_weight: float = 0.1, n: int = 3,
                stopwords: Iterable[str] | None = None,
                fields: Mapping[str, Column | str] | None = None,
                weights: Mapping[str, float] | None = None,
                indexes: Mapping[str, DataFrame] | None = None,
                among: DataFrame | None = None, best: int | None = None) -> DataFrame:
    """Word-level disjunction-max of stemmed fields and their n-gram copies:
    per query word, the maximum over fields of ``weight x score`` where a
    stemmed field scores stem(word) and an n-gram copy (weight
    ``gram_weight`` x the field's weight) scores the sum of the word's
    n-grams; summed over words. (qid, doc, score).

    A word's score in a document does not depend on the need, so it is made
    once per distinct word and then handed to the needs that hold the word.
    All of it happens where the document's postings were dealt.
    ``among`` and ``best`` are those of ``bm25``.

    ``fields``/``weights`` default to the single ``field`` with weight 1."""
    fields = dict(fields) if fields is not None else {"text": field}
    weights = {f: float((weights or {}).get(f, 1.0)) for f in fields}
    words = query_words(queries, qid, text, stopwords)
    word = words.select("word").distinct()
    grams = word.select("word", F.explode(A.char_ngrams(F.col("word"), n)).alias("term")).groupBy("word", "term").agg(F.count(F.lit(1)).alias("qtf"))
    stems = word.select("word", A.stem(F.col("word")).alias("term"), F.lit(1).cast("long").alias("qtf"))
    asked = None
    for name in fields:
        for f, part in ((name, stems), (name + "_gram", grams)):
            part = part.select(F.lit(f).alias("field"), "word", "term", "qtf")
            asked = part if asked is None else asked.unionByName(part)
    small = row_count_at_most(asked, config.BROADCAST_MAX_ROWS)
    weighted = [(f, w) for name in fields for f, w in ((name, weights[name]), (name + "_gram", gram_weight * weights[name]))]
    indexes = dict(indexes or {})
    held = _held(asked.select("qtf").unionByName(words.select("qtf")))
    if held:
        of: dict[str, dict[str, list[str]]] = {f: {} for f, _ in weighted}
        for r in asked.collect():
            of[r.field].setdefault(r.word, []).extend([r.term] * r.qtf)
    parts = [indexes.get(x) for x in ("stemmed", *(f + "_gram" for f in fields))]
    if held and all(_listed(x) for x in parts):
        index = functools.reduce(DataFrame.unionByName, parts)
        found = _ranked_lists(index, of, dict(weighted), words, "word", among=among, best=best)
        if found is not None:
            return found.select("qid", "doc", "score")
    if "stemmed" not in indexes:
        indexes["stemmed"] = query_rows(field_texts(docs, key, fields), stems, small, stopwords)
    rows = _as_rows(indexes["stemmed"]).select("field", "term", "doc", "dl", "tf")
    for name, col in fields.items():
        gram = indexes.get(name + "_gram")
        if gram is None:
            gram = query_rows(field_texts(docs, key, {name + "_gram": col}), grams, small, stopwords, gram_analyzer(n, stopwords))
        rows = rows.unionByName(_as_rows(gram).select("field", "term", "doc", "dl", "tf"))
    if held:
        at = {w: i for i, w in enumerate(dict.fromkeys(w for x in of.values() for w in x))}
        places = {x: i for i, x in enumerate(dict.fromkeys((f, t) for f, x in of.items() for terms in x.values() for t in terms))}
        asked = _table(words, field=pa.array([f for f, _ in places], pa.string()), term=pa.array([x for _, x in places], pa.string()),
                       id=pa.array(places.values(), pa.int32()))
    post, dfs, stats, repeated = _statistics(rows, asked, small, write=True)
    made = _rows_made(dfs, asked, ["field", "term"])
    pairs = words.select("qid").distinct().count() * (stats.agg(F.max("n_docs")).first()[0] or 0)
    if among is not None:
        post = post.join(bounded_broadcast(among.select("doc").distinct()), "doc", "left_semi")
    worth = _dealt_worth(post, dfs, stats, small, F.lit(1.0), config.BM25_K1, config.BM25_B, repeated, max(made, pairs))
    if held:
        qids, needs = _needs_of(words, "word", at)
        groups = [(Groups([[places[f, t] for t in of[f].get(w, ())] for w in at]), w_) for f, w_ in weighted]
        return _scored(worth, words, scorer(qids, needs, len(places), groups, best=best)).select("qid", "doc", "score")
    scored = _asked(worth, asked, small, ["field", "term"])
    of_field = [F.sum(F.when(F.col("field") == f, F.col("s"))) * F.lit(w) for f, w in weighted]
    per_word = scored.groupBy("doc", "word").agg(F.greatest(*of_field).alias("s"))
    return per_word.join(F.broadcast(words) if small else words, "word").groupBy("qid", "doc").agg(
        F.sum(F.col("qtf") * F.col("s")).alias("score"))
