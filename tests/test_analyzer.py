"""Analyzer golden checks (index and query side use the same chain)."""

from pyspark.sql import functions as F

from quarry.functions import analyze as A
from quarry.operators import search as SR


def analyze(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(A.analyze("t")).first()[0]


def test_golden_terms(spark):
    assert analyze(spark, "Amélie") == ["amelie"]
    assert analyze(spark, "Café") == ["cafe"]
    assert analyze(spark, "The Matrix") == ["matrix"]
    assert analyze(spark, "the and") == []
    assert analyze(spark, "runners") == ["runner"]
    assert analyze(spark, "Moulins") == ["moulin"]
    assert analyze(spark, "running") == ["running"]
    assert analyze(spark, "science-fiction") == ["science", "fiction"]
    assert analyze(spark, "Straße Œuvre") == ["strasse", "oeuvre"]
    assert analyze(spark, "stories glasses cities aies") == ["story", "glasse", "city", "aie"]


def test_positions_keep_stopword_gaps(spark):
    df = spark.createDataFrame([(1, "science of the fiction")], "doc long, text string")
    texts = SR.field_texts(df, "doc", {"text": "text"})
    rows = SR.doc_positions(texts).select("pos", "term").orderBy("pos").collect()
    assert [(r.pos, r.term) for r in rows] == [(0, "science"), (3, "fiction")]


def test_char_ngrams(spark):
    df = spark.createDataFrame([("abcde",), ("ab",)], "t string")
    out = [r[0] for r in df.select(A.char_ngrams(F.col("t"), 3)).collect()]
    assert out == [["abc", "bcd", "cde"], []]
