"""Evaluation operators on externally saved runs and judgments.

Point the environment variables at the files to run it:
  QUARRY_GOLDEN_RUN_A, QUARRY_GOLDEN_RUN_B, QUARRY_GOLDEN_RUN_TRIAL  (TREC runs)
  QUARRY_GOLDEN_QRELS                                                 (judgments CSV)
The expected values are the published aggregates of those runs (setup A/B
table, fusion and trial rows, mean PR points). Skipped when unset."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import evaluate as EV
from quarry.operators import search as SR
from quarry.sources import files as FS

RUN_A = os.environ.get("QUARRY_GOLDEN_RUN_A", "")
RUN_B = os.environ.get("QUARRY_GOLDEN_RUN_B", "")
RUN_T = os.environ.get("QUARRY_GOLDEN_RUN_TRIAL", "")
QRELS = os.environ.get("QUARRY_GOLDEN_QRELS", "")

pytestmark = pytest.mark.skipif(
    not all(p and os.path.exists(p) for p in (RUN_A, RUN_B, RUN_T, QRELS)), reason="golden runs not configured"
)


def trec_order(run):
    """trec_eval order: score (float32) desc, then docid (string) desc."""
    w = Window.partitionBy("qid").orderBy(F.col("score").cast("float").desc(), F.col("doc").cast("string").desc())
    return run.withColumn("rank", F.row_number().over(w))


def means(spark, run, run_id):
    qrels = FS.read_qrels(spark, QRELS)
    needs = qrels.select("qid").distinct()
    pq = EV.per_query(run.withColumn("run_id", F.lit(run_id)), qrels, needs, [run_id])
    row = pq.agg(*[F.avg(m).alias(m) for m in EV.METRICS]).first()
    return [round(row[m], 3) for m in EV.METRICS]


def test_setup_a_and_b(spark):
    a = trec_order(FS.read_trec_run(spark, RUN_A))
    b = trec_order(FS.read_trec_run(spark, RUN_B))
    assert means(spark, a, "A") == [0.800, 0.740, 0.465, 0.688, 0.588, 0.900]
    assert means(spark, b, "B") == [0.880, 0.780, 0.497, 0.737, 0.588, 1.000]


def test_fusion_and_trial(spark):
    a = trec_order(FS.read_trec_run(spark, RUN_A))
    t = trec_order(FS.read_trec_run(spark, RUN_T))
    assert means(spark, t, "T") == [0.800, 0.740, 0.456, 0.680, 0.572, 0.900]
    fused = EV.rrf(a.unionByName(t), 60).withColumn("doc", F.col("doc").cast("long"))
    top = SR.top_k(fused, 20).withColumn("doc", F.col("doc").cast("string"))
    assert means(spark, top, "F") == [0.880, 0.740, 0.467, 0.693, 0.561, 0.900]


def test_pr_curve_points(spark):
    a = trec_order(FS.read_trec_run(spark, RUN_A))
    b = trec_order(FS.read_trec_run(spark, RUN_B))
    qrels = FS.read_qrels(spark, QRELS)
    run = a.withColumn("run_id", F.lit("A")).unionByName(b.withColumn("run_id", F.lit("B")))
    pr = EV.pr_curve(run, qrels, digits=8).groupBy("run_id", "recall").agg(F.avg("precision").alias("p"))
    got = {(r.run_id, round(r.recall, 1)): r.p for r in pr.collect()}
    assert abs(got[("A", 0.2)] - 0.84292) < 5e-5
    assert abs(got[("A", 1.0)] - 0.12728) < 5e-5
    assert abs(got[("B", 0.2)] - 0.97778) < 5e-5
    assert abs(got[("B", 1.0)] - 0.10770) < 5e-5


def test_pool_sizes(spark):
    a = FS.read_trec_run(spark, RUN_A)
    b = FS.read_trec_run(spark, RUN_B)
    t = FS.read_trec_run(spark, RUN_T)
    assert EV.pool(a, b).count() == 100
    assert EV.pool(a, t).count() == 130
