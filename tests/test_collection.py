import pytest
from pyspark.sql import functions as F

from quarry.operators import collection as C

MOVIE = ("movie_id", "seq", "title", "original_title", "release_date", "runtime", "original_language", "status", "overview", "tagline", "genres", "vote_average", "vote_count", "popularity", "budget", "revenue")
LONG = " ".join(f"word{i}" for i in range(50))


def frame(spark, names, rows, ints=("seq",)):
    return spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n in ints else 'string'}" for n in names))


@pytest.fixture(scope="module")
def sources(spark):
    movies = [
        ("7", 0, "Old", "", "1999-01-01", "0", "en", "Released", " o ", "", "Drama, ,Crime", "7.5", "3", "1.5", "0", "12.9"),
        ("7", 5, " New ", " ", "1999-13-77", "91.8", "en", "Released", " o ", "", "Drama, ,Crime", "7.5", "3", "1.5", "0", "12.9"),
        ("8", 1, "", "x", "soon", "-", "", "", "", "t", "", "11", "2", "x", "-5", ""),
        ("9", 2, "No votes", "x", "2500-01-01", "5", "", "", "", "", "", "6", "", "", "", ""),
        ("ab", 3, "Bad id", "x", "", "", "", "", "", "", "", "", "", "", "", ""),
        ("10", 4, "No plot", "x", "", "", "", "", "", "", "", "", "", "", "", ""),
        ("11", 6, "Short", "x", "", "", "", "", "", "", "", "", "", "", "", ""),
        ("12", 7, "Only notes", "x", "", "", "", "", "", "", "", "", "", "", "", ""),
        (None, 8, "No id", "x", "", "", "", "", "", "", "", "", "", "", "", ""),
    ]
    credits = [("7", 0, "A; B ;; ", "Al (Max (old)); Bo ; (Ghost)", "A; C", "A (Director)); C"), ("99", 0, "Z", "", "", "")]
    links = [("7", 0, "Wrong", "http://x", "", "", "primary"), ("7", 1, " T ", "http://t", "Q1", " ", "secondary"), ("8", 0, "No url", " ", "Q2", "tt", "primary")]
    plots = [("7", 0, "ok", f"[1] {LONG} [a]"), ("8", 0, " ok ", LONG), ("9", 0, "ok", LONG), ("10", 0, "no_plot", LONG), ("11", 0, "ok", LONG[:-8] + "[12]"), ("12", 0, "ok", "[1][b]"), ("ab", 0, "ok", LONG)]
    reviews = [("7", 1, "Cy", "8", " b\r\nc ", "2020-05-06T07:08"), ("7", 0, " ", "", "a", "later"), ("8", 3, None, "x", None, None), ("10", 4, "D", "1", "dropped", "2020-01-01"), ("404", 5, "E", "1", "no movie", "2020-01-01")]
    return {
        "movies": frame(spark, MOVIE, movies), "credits": frame(spark, ("movie_id", "seq", "director", "cast", "crew_names", "crew_roles"), credits),
        "links": frame(spark, ("movie_id", "seq", "wikipedia_title", "wikipedia_url", "wikidata_id", "imdb_id", "match_method"), links),
        "plots": frame(spark, ("movie_id", "seq", "status", "plot"), plots),
        "reviews": frame(spark, ("movie_id", "seq", "author", "author_rating", "content", "created_at"), reviews),
    }


def build(s):
    decisions = C.plot_decisions(s["movies"], s["plots"])
    kids = C.children(s["reviews"], decisions.where("drop_reason is null"))
    return decisions, kids, C.parents(s["movies"], s["credits"], s["links"], decisions, kids)


def test_each_movie_has_one_reason(sources):
    got = {r.movie_id: r.drop_reason for r in build(sources)[0].collect()}
    assert got == {"7": None, "8": None, "9": None, "ab": "non_numeric_id", None: "non_numeric_id", "10": "no_plot", "12": "no_plot", "11": "short_plot"}


def test_typed_parents(sources):
    rows = {r.movie_id: r for r in build(sources)[2].collect()}
    seven, eight, nine = rows[7], rows[8], rows[9]
    assert set(rows) == {7, 8, 9}
    assert (seven.title, seven.original_title, seven.release_date, seven.year, seven.runtime, seven.genres) == ("New", None, "1999-13-77", 1999, 91, ["Drama", "Crime"])
    assert (seven.vote_average, seven.vote_count, seven.popularity, seven.budget, seven.revenue, seven.overview, seven.tagline) == (7.5, 3, 1.5, None, 12, "o", None)
    assert seven.director == ["A", "B"] and seven.crew_names == ["A", "C"]
    assert [tuple(x) for x in seven.cast] == [("Al", "Max (old)", 0), ("Bo", None, 1), ("", "Ghost", 2)]
    assert [tuple(x) for x in seven.crew_roles] == [("A", "Director"), ("C", None)]
    assert seven.wikipedia.asDict() == {"title": "T", "url": "http://t", "wikidata_id": "Q1", "imdb_id": None, "match_method": "secondary"}
    assert seven.plot == LONG and seven.num_reviews == 2
    assert (eight.release_date, eight.year, eight.runtime, eight.wikipedia, eight.cast, eight.num_reviews) == (None, None, None, None, [], 1)
    assert (nine.year, nine.release_date, nine.vote_average, nine.vote_count) == (None, "2500-01-01", None, 0)


def test_children_keep_source_order(sources):
    got = sorted(tuple(r) for r in build(sources)[1].collect())
    assert got == [("7", 0, None, None, "a", "later", 1), ("7", 1, "Cy", 8.0, "b\nc", "2020-05-06", 2), ("8", 0, None, None, "", None, 0)]


def test_violations_and_strict_build(sources):
    rows = build(sources)[2]
    got = {r.movie_id: r.violations for r in C.validated(rows).collect()}
    assert got == {7: ["crew_roles"], 8: ["title", "budget", "vote_average"], 9: []}
    with pytest.raises(Exception, match="invalid document"):
        C.validated(rows, strict=True).collect()
    assert C.validated(rows.where("movie_id = 9"), strict=True).count() == 1


def test_manifest_counts_add_up(sources):
    decisions, kids, _ = build(sources)
    got = {(r.section, r.name): r.value for r in C.manifest(sources, decisions, kids).collect()}
    assert got["filter", "min_plot_words"] == 50 and got["source", "movies"] == 9 and got["source", "reviews"] == 5
    assert (got["output", "documents"], got["output", "dropped_non_numeric_id"], got["output", "dropped_no_plot"], got["output", "dropped_short_plot"], got["output", "children"]) == (3, 2, 2, 1, 3)


def test_search_rows(sources):
    _, kids, rows = build(sources)
    got = {r.id: r for r in C.search_rows(rows, kids).collect()}
    assert set(got) == {"movie-7", "movie-8", "movie-9", "movie-7-review-0", "movie-7-review-1", "movie-8-review-0"}
    assert got["movie-7"]["cast.name"] == ["Al", "Bo"] and got["movie-7"]["cast.character"] == ["Max (old)", "Ghost"] and got["movie-7"]["cast.order"] == [0, 1, 2]
    assert got["movie-7"]["crew_roles.job"] == ["Director"] and got["movie-7"]["wikipedia.imdb_id"] is None
    assert got["movie-7-review-1"].review_created_at == "2020-05-06T00:00:00Z" and got["movie-7-review-0"].review_created_at is None
    assert got["movie-7-review-1"].parent_id == "movie-7" and got["movie-7-review-1"].title is None


def test_nested_documents(sources):
    _, kids, rows = build(sources)
    got = {r.movie_id: r for r in C.nested(rows, kids).collect()}
    assert [x.text for x in got[7].reviews] == ["a", "b\nc"] and got[9].reviews == [] and "source_id" not in got[9].asDict()
    with pytest.raises(Exception, match="too many reviews"):
        C.nested(rows, kids, most=1).collect()


def test_counters(sources):
    _, kids, rows = build(sources)
    got = {r.name: r.value for r in C.counters(rows, kids).collect()}
    assert got["documents"] == 3 and got["several_directors"] == 1 and got["no_cast"] == 2 and got["with_review"] == 2 and got["with_rating"] == 1
    assert got["linked"] == 1 and got["linked_imdb"] == 0 and got["reviews"] == 3 and got["mean_rating"] == 8.0 and got["longest_review"] == 2


def test_empty_tables(sources):
    none = {k: v.where(F.lit(False)) for k, v in sources.items()}
    decisions, kids, rows = build(none)
    assert rows.count() == 0 and kids.count() == 0 and C.search_rows(rows, kids).count() == 0
    assert {r.value for r in C.manifest(none, decisions, kids).where("section <> 'filter'").collect()} == {0}
