import csv
import json

import pytest

from quarry.plans import build as BD
from quarry.sources import files as FS

LONG = " ".join(f"word{i}" for i in range(60))


def write(path, columns, rows, bom=False):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as fh:
        out = csv.DictWriter(fh, columns, restval="")
        out.writeheader()
        out.writerows(rows)


@pytest.fixture
def folder(tmp_path):
    movie = {"title": 'A "quoted", title', "release_date": "1999-01-02", "runtime": "90.0", "genres": "Drama,Crime", "vote_average": "6", "vote_count": "4"}
    columns = [*reversed(BD.COLUMNS["movies"]), "extra"]
    write(tmp_path / "movies.csv", columns, [{**movie, "movie_id": "2", "title": "old"}, {**movie, "movie_id": "2", "extra": "x"}, {**movie, "movie_id": "3", "title": "three"},
                                                  {**movie, "movie_id": "m4"}, {**movie, "movie_id": "5"}, {**movie, "movie_id": "6"}])
    write(tmp_path / "links.csv", BD.COLUMNS["links"], [{"movie_id": "2", "wikipedia_title": "É", "wikipedia_url": "http://e"}], bom=True)
    write(tmp_path / "plots.csv", BD.COLUMNS["plots"], [{"movie_id": "2", "status": "ok", "plot": f"{LONG}\n\nsecond, \"line\"[3]"}, {"movie_id": "3", "status": "ok", "plot": LONG},
                                                                   {"movie_id": "5", "status": "ok", "plot": "short"}, {"movie_id": "m4", "status": "ok", "plot": LONG}])
    write(tmp_path / "said.csv", BD.COLUMNS["reviews"], [{"movie_id": "2", "content": "one\r\ntwo", "created_at": "2020-01-02T03"}, {"movie_id": "2", "author": "B", "author_rating": "7"}, {"movie_id": "5", "content": "gone"}])
    return tmp_path


def lines(path):
    return [json.loads(line) for part in sorted(path.glob("part-*")) for line in part.read_text(encoding="utf-8").splitlines()]


def test_build_from_files(spark, folder):
    paths = BD.build(spark, str(folder), f"{folder}/out", names={"reviews": "said.csv"})
    docs = {d["movie_id"]: d for d in lines(folder / "out/collection")}
    assert set(paths) == {"collection", "search_rows", "manifest"} and set(docs) == {2, 3}
    two = docs[2]
    assert two["title"] == 'A "quoted", title' and two["runtime"] == 90 and two["genres"] == ["Drama", "Crime"] and two["tagline"] is None
    assert two["plot"] == f'{LONG}\n\nsecond, "line"' and two["wikipedia"]["title"] == "É" and two["wikipedia"]["wikidata_id"] is None
    assert [(r["text"], r["rating"], r["author"], r["created_at"]) for r in two["reviews"]] == [("one\ntwo", None, None, "2020-01-02"), ("", 7.0, "B", None)]
    assert docs[3]["wikipedia"] is None and docs[3]["reviews"] == [] and docs[3]["cast"] == [] and "source_id" not in two
    rows = {r["id"]: r for r in lines(folder / "out/search_rows")}
    assert set(rows) == {"movie-2", "movie-3", "movie-2-review-0", "movie-2-review-1"} and "tagline" not in rows["movie-2"]
    counts = {(r["section"], r["name"]): r["value"] for r in lines(folder / "out/manifest")}
    assert counts["source", "movies"] == 6 and counts["source", "credits"] == 0 and counts["output", "documents"] == 2 and counts["output", "children"] == 2
    assert (counts["output", "dropped_non_numeric_id"], counts["output", "dropped_no_plot"], counts["output", "dropped_short_plot"]) == (1, 1, 1)
    kind = "movie_id long, title string, reviews array<struct<text:string,rating:double>>, num_reviews int"
    assert {r.movie_id: len(r.reviews) for r in FS.read_jsonl(spark, paths["collection"], kind).collect()} == {2: 2, 3: 0}


def test_invalid_documents(spark, folder):
    write(folder / "credits.csv", BD.COLUMNS["credits"], [{"movie_id": "3", "crew_roles": "No Job"}])
    with pytest.raises(Exception, match="invalid document 3: crew_roles"):
        BD.build(spark, str(folder), f"{folder}/strict")
    assert not (folder / "strict").exists()
    BD.build(spark, str(folder), f"{folder}/loose", strict=False)
    assert [d["movie_id"] for d in lines(folder / "loose/collection")] == [2]
    assert [(d["movie_id"], d["violations"]) for d in lines(folder / "loose/rejected")] == [(3, ["crew_roles"])]


def test_no_files(spark, tmp_path):
    BD.build(spark, f"{tmp_path}/none", f"{tmp_path}/out")
    assert lines(tmp_path / "out/collection") == [] and {r["value"] for r in lines(tmp_path / "out/manifest") if r["section"] != "filter"} == {0}


def test_csv_and_qrels_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'q"x', 1), ("é\nf", None, 2)], "x string, y string, z int")
    FS.write_csv(df, f"{tmp_path}/csv", ["y", "x"])
    back = FS.read_csv_by_name(spark, f"{tmp_path}/csv", ["x", "y", "w"])
    assert sorted((r.x, r.y, r.w) for r in back.collect()) == [("a,b", 'q"x', ""), ("é\nf", "", "")]
    qrels = spark.createDataFrame([("Q2", "1", 0), ("Q1", "20", 2), ("Q1", "3", 1)], "qid string, doc string, rel int")
    FS.write_trec_qrels(qrels, f"{tmp_path}/qrels")
    assert [r.value for r in spark.read.text(f"{tmp_path}/qrels").collect()] == ["Q1 0 20 2", "Q1 0 3 1", "Q2 0 1 0"]
    assert FS.read_optional(spark, f"{tmp_path}/nothing.csv", "a string, b int").collect() == []
    (tmp_path / "bom.csv").write_text("﻿a,b\n1,x\n", encoding="utf-8")
    assert [tuple(r) for r in FS.read_csv(spark, f"{tmp_path}/bom.csv", "a string, b string").collect()] == [("1", "x")]
