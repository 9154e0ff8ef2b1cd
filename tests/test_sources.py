"""File sources: TREC runs and judgments."""

import pytest

from quarry.sources import files as FS


def test_trec_run_and_short_line(spark, tmp_path):
    good = tmp_path / "good.run"
    good.write_text("Q1 Q0 7 1 2.5 A\nQ1 Q0 9 2 1.5 A\n\n")
    rows = FS.read_trec_run(spark, str(good)).orderBy("rank").collect()
    assert [(r.qid, r.doc, r.rank, r.score, r.run_id) for r in rows] == [("Q1", "7", 1, 2.5, "A"), ("Q1", "9", 2, 1.5, "A")]
    bad = tmp_path / "bad.run"
    bad.write_text("Q1 Q0 7 1 2.5\n")
    with pytest.raises(Exception):
        FS.read_trec_run(spark, str(bad)).collect()


def test_qrels_last_wins_and_blank(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text("qid,docid,rel,judge\nQ1,1,0,a\nQ1,2,,b\nQ1,1,2,c\nQ2,5,1,d\n")
    rows = {(r.qid, r.doc): r.rel for r in FS.read_qrels(spark, str(p)).collect()}
    assert rows == {("Q1", "1"): 2, ("Q2", "5"): 1}
    bad = tmp_path / "bad.csv"
    bad.write_text("qid,docid,rel\nQ1,1,3\n")
    with pytest.raises(Exception):
        FS.read_qrels(spark, str(bad)).collect()


def test_json_run_round_trip(spark, tmp_path):
    rows = [("Q1", "7", 1, 2.5), ("Q1", "9", 2, 1.5), ("Q2", "é", 1, 0.25)]
    run = spark.createDataFrame(rows, "qid string, doc string, rank int, score double")
    FS.write_run_json(run, f"{tmp_path}/run")
    assert sorted(tuple(r) for r in FS.read_json_run(spark, f"{tmp_path}/run").collect()) == rows


def test_resolve_run(spark):
    kind = "qid string, doc string, rank int, score double"
    trec = spark.createDataFrame([("Q1", "7", 1, 2.5)], kind)
    other = spark.createDataFrame([("Q1", "7", 1, 2.5), ("Q2", "8", 1, 1.0)], kind)
    assert sorted(r.qid for r in FS.resolve_run(trec, other).collect()) == ["Q1", "Q2"]
    with pytest.raises(Exception):
        FS.resolve_run(trec, other.selectExpr("qid", "doc", "rank + 1 as rank", "score")).collect()
