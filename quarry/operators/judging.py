"""Provenance of judgments, the gate before final metrics, rubric grades and
the evaluator's own order of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# How the judge of a provisional grade begins.
PROVISIONAL = "^(preliminary|seed)"


def provisional(judge: Column) -> Column:
    """A grade counts as provisional without a named judge, or with a judge
    that begins like a generated one."""
    name = F.lower(T.py_strip(F.coalesce(judge, F.lit(""))))
    return (name == "") | name.rlike(PROVISIONAL)


def provenance(sheet: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(judged, provisional, manual) of a sheet (rel, judge), in all or ``by``
    columns. Rows without a grade are not judged."""
    graded = F.length(T.py_strip(F.coalesce(F.col("rel").cast("string"), F.lit("")))) > 0
    loose = graded & provisional(F.col("judge"))
    return sheet.groupBy(*(by or [])).agg(F.count_if(graded).alias("judged"), F.count_if(loose).alias("provisional"), F.count_if(graded & ~provisional(F.col("judge"))).alias("manual"))


def gate(pool: DataFrame, sheet: DataFrame) -> DataFrame:
    """Per need: pooled, unjudged and provisional documents, and the status:
    ``final`` only when both counts are 0. ``sheet`` is (qid, doc, rel, judge)
    with one row per judged pair."""
    graded = sheet.where(F.col("rel").isNotNull()).select("qid", "doc", provisional(F.col("judge")).alias("_loose"))
    counts = pool.select("qid", "doc").join(graded, ["qid", "doc"], "left").groupBy("qid").agg(
        F.count(F.lit(1)).alias("pooled"), F.count_if(F.col("_loose").isNull()).alias("unjudged"), F.count_if("_loose").alias("provisional"))
    open_ = (F.col("unjudged") > 0) | (F.col("provisional") > 0)
    return counts.withColumn("status", F.when(open_, F.lit("pending")).otherwise(F.lit("final")))


def gated(metrics: DataFrame, gates: DataFrame, strict: bool = False) -> DataFrame:
    """Metrics of the needs whose gate is final; the others are withheld. With
    ``strict`` one pending need fails the whole report."""
    status = F.col("status")
    if strict:
        refused = F.raise_error(F.concat(F.lit("judgments of need "), F.col("qid").cast("string"), F.lit(" are pending"))).cast("string")
        status = F.when(status == "final", status).otherwise(refused)
    return metrics.join(gates.select("qid", status.alias("status")), "qid").where(F.col("status") == "final").drop("status")


def apply_rubric(pool: DataFrame, rubric: DataFrame, strict: bool = True, judge: str = "preliminary") -> DataFrame:
    """(qid, doc, rel, judge, notes) of every pooled row from a rubric table
    (qid, doc, rel, notes). A pooled row that the rubric lacks fails the job,
    or without ``strict`` stays without grade and judge; rubric rows outside
    the pool are not used."""
    j = pool.select("qid", "doc").join(rubric.select("qid", "doc", "rel", "notes"), ["qid", "doc"], "left")
    found = F.col("rel").isNotNull()
    rel = F.col("rel")
    if strict:
        rel = F.when(found, rel).otherwise(F.raise_error(F.concat(F.lit("no rubric grade for "), F.col("qid").cast("string"), F.lit("/"), F.col("doc").cast("string"))).cast("int"))
    return j.select("qid", "doc", rel.cast("int").alias("rel"), F.when(found, F.lit(judge)).alias("judge"), "notes")


def evaluator_order(run: DataFrame, depth: int | None = None) -> DataFrame:
    """The order in which the standard evaluator reads a run, whatever ranks
    it states: single-precision scores from high to low, equal ones by id as
    text from high to low; ``depth`` first keeps that many stated ranks. Adds
    ``trec_rank``. One need's results are one window group, which a run's
    depth bounds."""
    cut = run if depth is None else run.where(F.col("rank") <= depth)
    w = Window.partitionBy("qid").orderBy(F.col("score").cast("float").desc(), F.col("doc").cast("string").desc())
    return cut.withColumn("trec_rank", F.row_number().over(w))
