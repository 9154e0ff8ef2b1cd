import json

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import judging as J
from quarry.operators import needs as N
from quarry.operators.profile import against_reference
from quarry.operators.quality import display_only


def f(op, field, values=(), low=None, high=None, negate=False):
    return {"op": op, "field": field, "values": list(values), "low": None if low is None else float(low), "high": None if high is None else float(high), "negate": negate}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "The Russian mafia rules", ["Robert De Niro", "Al Pacino"], ["Crime", "Science Fiction"], "Released", 2001, 95.0),
        (2, "A Russian and Italian mafia", ["Robert Deniro"], ["Thrillers"], "released", 2010, 120.0),
        (3, "mafia films in the city", ["Niro Robert De", "De Niro"], ["Science", "Fiction"], "Released", 1999, None),
        (4, None, None, [], None, None, None),
    ]
    return spark.createDataFrame(rows, "doc int, plot string, people array<string>, genres array<string>, status string, year int, minutes double")


def passing(spark, docs, filters):
    needs = spark.createDataFrame([("Q", "x", "story", filters)], f"qid string, need string, source string, filters {N.FILTER_TYPE}")
    texts = {"people": F.col("people"), "genres": F.col("genres"), "plot": F.array("plot")}
    got = N.allowed(docs, "doc", needs, texts, {"status": F.array("status"), "people": F.col("people")}, {"year": F.col("year"), "minutes": F.col("minutes")})
    return sorted(r.doc for r in got.collect())


@pytest.mark.parametrize("filters, want", [
    ([f("phrase", "people", ["robert de niro", "Robert Deniro"])], [1, 2]),
    ([f("phrase", "genres", ["science fiction"])], [1]),
    ([f("term", "genres", ["crime", "thriller"])], [1, 2]),
    ([f("phrase", "plot", ["Russian mafia"], negate=True)], [2, 3, 4]),
    ([f("phrase", "plot", ["the Russian"])], [1, 2]),
    ([f("phrase", "plot", ["film city"])], []),
    ([f("term", "plot", ["the"])], []),
    ([f("exact", "status", ["Released"])], [1, 3]),
    ([f("exact", "people", ["Al Pacino", "de niro"])], [1]),
    ([f("range", "year", low=2000, high=2010), f("range", "minutes", low=95, high=119.5)], [1]),
    ([f("range", "minutes", low=0, high=1000, negate=True)], [3, 4]),
])
def test_filters(spark, docs, filters, want):
    assert passing(spark, docs, filters) == want


def test_unknown_fields_and_filters_fail(spark, docs):
    with pytest.raises(Exception, match="no such field"):
        passing(spark, docs, [f("term", "tagline", ["x"])])
    with pytest.raises(Exception, match="no such filter"):
        passing(spark, docs, [f("regex", "plot", ["x"])])


def test_filters_run_once_for_each_document(spark, docs):
    needs = spark.createDataFrame([("Q", "x", "story", [f("phrase", "plot", ["russian mafia"])])], f"qid string, need string, source string, filters {N.FILTER_TYPE}")
    got = N.allowed(docs, "doc", needs, {"plot": F.array("plot")}, {}, {})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("forall(") == 1


def test_scored_rows_are_made_once(spark):
    """Needs without and with filters, documents that stand in several rows
    or have no id."""
    needs = spark.createDataFrame([("free", []), ("bound", [f("term", "plot", ["x"])])], f"qid string, filters {N.FILTER_TYPE}")
    scored = spark.range(1).selectExpr("inline(array(('free', 1L, 0.5D), ('free', null, 0.4D), ('bound', 1L, 0.3D), ('bound', 2L, 0.2D), ('bound', 3L, 0.1D), ('bound', null, 0.1D), ('other', 1L, 0.1D))) as (qid, doc, score)")
    ok = spark.createDataFrame([(1, ["bound"]), (1, ["bound", "more"]), (2, ["more"]), (None, ["bound"])], "doc long, qids array<string>")
    got = N.restricted(scored, needs, ok)
    rows = sorted((r.qid, r.doc or 0, r.score) for r in got.collect())
    assert rows == [("bound", 1, 0.3), ("bound", 1, 0.3), ("free", 0, 0.4), ("free", 1, 0.5)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_each_need_uses_its_source_and_filters(spark, docs, monkeypatch):
    monkeypatch.setattr(N, "NEEDS_BLOCK", 1)
    needs = spark.createDataFrame([
        ("Q1", "mafia", "story", []), ("Q2", "mafia", "story", [f("exact", "status", ["Released"])]), ("Q3", "witty", "reviews", [f("range", "year", low=2000, high=2020)]), ("Q4", "nothing", "story", []),
    ], f"qid string, need string, source string, filters {N.FILTER_TYPE}")
    kids = spark.createDataFrame([(1, 0, "witty witty"), (1, 1, "dull"), (2, 0, "a long and witty review of it"), (3, 0, "witty"), (9, 0, "witty orphan")], "doc int, idx int, text string")
    ok = N.allowed(docs, "doc", needs, {"plot": F.array("plot")}, {"status": F.array("status")}, {"year": F.col("year")})
    run = N.search(needs, docs, "doc", "plot", kids, "doc", "idx", "text", ok)
    got = {}
    for r in sorted(run.collect(), key=lambda r: (r.qid, r.rank)):
        got.setdefault(r.qid, []).append(r.doc)
    assert sorted(got["Q1"]) == [1, 2, 3] and sorted(got["Q2"]) == [1, 3] and got["Q3"] == [1, 2] and "Q4" not in got
    scores = {(r.qid, r.doc): r.score for r in run.collect()}
    assert scores["Q1", 1] == scores["Q2", 1]  # filters restrict results, not statistics
    shown = N.presented(run, docs, "doc", {"status": F.col("status"), "plot": F.col("plot")}, "plot").where("qid = 'Q2' and doc = 1").first()
    assert shown.plot == "The Russian mafia rules" and shown.status == "Released"
    again = N.search(needs, docs, "doc", "plot", kids, "doc", "idx", "text", ok, second=F.array_join("genres", " "))
    assert again.where("qid = 'Q1'").count() == 3


def test_read_needs(spark, tmp_path):
    for name, qid in (("Q2", "Q2"), ("Q1", "Q1"), ("notes", "x")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"qid": qid, "need": "n\n" + qid, "source": "story", "filters": [f("term", "plot", ["x"])]}, indent=1))
    got = {r.qid: r for r in N.read_needs(spark, str(tmp_path)).collect()}
    assert set(got) == {"Q1", "Q2"} and got["Q1"].filters[0]["values"] == ["x"]
    (tmp_path / "Q3.json").write_text(json.dumps({"qid": "Q9", "need": "n", "source": "story"}))
    with pytest.raises(Exception, match="does not match"):
        N.read_needs(spark, str(tmp_path)).collect()
    (tmp_path / "Q3.json").write_text(json.dumps({"qid": "Q3", "need": "n", "source": "web"}))
    with pytest.raises(Exception, match="unknown source"):
        N.read_needs(spark, str(tmp_path)).collect()


def test_setups_agree(spark):
    make = lambda rows: spark.createDataFrame(rows, f"qid string, need string, source string, filters {N.FILTER_TYPE}")
    a = make([("Q1", "x", "story", []), ("Q2", "y", "story", [f("term", "plot", ["x"])]), ("Q3", "z", "story", [])])
    b = make([("Q1", "x", "story", []), ("Q2", "y", "reviews", [f("term", "plot", ["z"])])])
    assert sorted(tuple(r) for r in N.disagreements(a, b).collect()) == [("Q2", "filters"), ("Q2", "source"), ("Q3", "filters"), ("Q3", "need"), ("Q3", "source")]


def test_check_run(spark):
    rows = [("a", 1, 1, "movie-1"), ("a", 2, 2, "movie-2"), ("b", 1, 1, "movie-1"), ("b", 1, 2, "movie-1"), ("c", None, 1, None), ("d", 5, 1, "movie-6"), ("e", 5, 2, "movie-5")]
    run = spark.createDataFrame(rows, "qid string, doc int, rank int, id string")
    got = {r.qid: (r.missing_id, r.repeated, r.wrong_key, r.gaps, r.status) for r in N.check_run(run).collect()}
    assert got["a"] == (0, 0, 0, 0, "pass") and got["b"][1] == 1 and got["c"][0] == 1 and got["d"][2] == 1 and got["e"][3] == 1
    assert {v[4] for k, v in got.items() if k != "a"} == {"fail"}
    with pytest.raises(Exception, match="unstable run"):
        N.check_run(run, strict=True).collect()


def test_boolean_match(spark):
    docs = spark.createDataFrame([(1, "Astronauts stranded on Mars"), (2, "An astronaut"), (3, "They survive"), (4, "astronaut must survive"), (5, None)], "doc int, text string")
    assert sorted(r.doc for r in N.boolean_match(docs, "doc", "text", ["astronaut"], ["stranded", "survive"]).collect()) == [1, 4]
    assert sorted(r.doc for r in N.boolean_match(docs, "doc", "text", ["astronauts"], []).collect()) == [1, 2, 4]


SHEET = [("Q1", 1, 2, "ann"), ("Q1", 2, 0, "Bob"), ("Q2", 1, 1, " Preliminary v2"), ("Q2", 3, 1, "ann"), ("Q3", 4, 0, None)]


@pytest.fixture(scope="module")
def judged(spark):
    sheet = spark.createDataFrame(SHEET, "qid string, doc int, rel int, judge string")
    pool = spark.createDataFrame([("Q1", 1), ("Q1", 2), ("Q2", 1), ("Q3", 4), ("Q4", 9)], "qid string, doc int")
    return pool, sheet


def test_provenance(spark, judged):
    assert tuple(J.provenance(judged[1]).first()) == (5, 2, 3)
    blank = spark.createDataFrame([(" ", "ann"), ("1", "seeded"), ("2", "preseed")], "rel string, judge string")
    assert tuple(J.provenance(blank).first()) == (2, 1, 1)


def test_gate_withholds_and_refuses(spark, judged):
    gates = J.gate(*judged)
    assert {r.qid: (r.pooled, r.unjudged, r.provisional, r.status) for r in gates.collect()} == {"Q1": (2, 0, 0, "final"), "Q2": (1, 0, 1, "pending"), "Q3": (1, 0, 1, "pending"), "Q4": (1, 1, 0, "pending")}
    metrics = spark.createDataFrame([("Q1", 0.5), ("Q2", 0.1)], "qid string, ap double")
    assert [tuple(r) for r in J.gated(metrics, gates).collect()] == [("Q1", 0.5)]
    with pytest.raises(Exception, match="pending"):
        J.gated(metrics, gates, strict=True).collect()


def test_rubric(spark, judged):
    rubric = spark.createDataFrame([("Q1", 1, 2, "good"), ("Q1", 2, 0, "off"), ("Q2", 1, 1, "so"), ("Q3", 4, 0, ""), ("Q7", 7, 2, "outside")], "qid string, doc int, rel int, notes string")
    got = {(r.qid, r.doc): (r.rel, r.judge) for r in J.apply_rubric(judged[0], rubric, strict=False).collect()}
    assert got["Q1", 1] == (2, "preliminary") and got["Q4", 9] == (None, None) and len(got) == 5
    with pytest.raises(Exception, match="no rubric grade for Q4/9"):
        J.apply_rubric(judged[0], rubric).collect()


def test_evaluator_order(spark):
    run = spark.createDataFrame([("Q", "9", 1, 1.0), ("Q", "10", 2, 1.0 + 1e-9), ("Q", "8", 3, 3.0), ("Q", "7", 4, 9.0)], "qid string, doc string, rank int, score double")
    assert [r.doc for r in J.evaluator_order(run).orderBy("trec_rank").collect()] == ["7", "8", "9", "10"]
    assert [r.doc for r in J.evaluator_order(run, 3).orderBy("trec_rank").collect()] == ["8", "9", "10"]


def test_small_checks(spark):
    own = spark.createDataFrame([("a", 5), ("b", 2)], "label string, n long")
    ref = spark.createDataFrame([("a", 7), ("c", 1)], "label string, reference long")
    assert sorted(tuple(r) for r in against_reference(own, ref, "label").collect()) == [("a", 5, 7, -2), ("b", 2, 0, 2)]
    jobs = spark.createDataFrame([("Producer",), ("producers",), (None,)], "job string")
    assert [(r.status, r.found) for r in display_only(jobs, "job", "Producer").collect()] == [("pass", 1), ("pass", 0), ("pass", 0)]
    assert [r.status for r in display_only(jobs, "job", "producer").collect()] == ["warn", "pass", "fail"]
    titles = spark.createDataFrame([(" T ", "http://x/a_b"), (" ", "http://x/a_%C3%A9+b"), (None, "http://x/"), (None, None)], "t string, u string")
    title, origin = T.title_or_url("t", "u")
    assert [tuple(r) for r in titles.select(title, origin).collect()] == [("T", "link"), ("a é+b", "url"), (None, "unmatched"), (None, "unmatched")]
