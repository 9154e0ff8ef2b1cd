"""De-duplication, positions, linking."""

from pyspark.sql import functions as F

from quarry.operators import prepare as P


def test_positional_index_hot_key(spark):
    rows = [(0, i) for i in range(3000)] + [(k, i) for k in range(1, 50) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, o int")
    out = P.positional_index(df, "k", "o", num_partitions=8)
    bad = out.filter(F.col("pos") != F.col("o")).count()
    assert bad == 0 and out.count() == len(rows)


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "z"), (1, 3, "c")], "k int, s int, v string")
    first = {r.k: r.v for r in P.first_wins(df, "k", "s").collect()}
    last = {r.k: r.v for r in P.last_wins(df, "k", "s").collect()}
    assert first == {1: "a", 2: "z"} and last == {1: "c", 2: "z"}


def test_first_occurrence_distinct(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "x"), (1, 4, "z")], "k int, o int, v string")
    out = [(r.v, r.pos) for r in P.first_occurrence_distinct(df, "k", "v", "o").orderBy("pos").collect()]
    assert out == [("x", 0), ("y", 1), ("z", 2)]


def test_two_pass_link(spark):
    ents = spark.createDataFrame([(1, 10, 20), (2, 11, 21), (3, 12, 22), (4, 13, 23), (5, 14, 24)], "e int, p int, s int")
    prim = spark.createDataFrame([(10, "P10"), (11, None), (12, None), (14, "P14")], "p int, article string")
    sec = spark.createDataFrame([(21, "S21"), (22, None), (23, "S23"), (24, "S24")], "s int, article string")
    out = {r.e: (r.found, r.article, r.match_method) for r in P.two_pass_link(ents, "e", prim, "p", sec, "s").collect()}
    assert out[1] == (True, "P10", "primary")
    assert out[2] == (True, "S21", "secondary")      # primary without article, secondary has one
    assert out[3] == (True, None, "primary")         # neither has an article
    assert out[4] == (True, "S23", "secondary")      # only secondary
    assert out[5] == (True, "P14", "primary")        # primary wins when it has an article


def test_nested_and_joined_list(spark):
    df = spark.createDataFrame([(1, 2, "B", None), (1, 1, "A", "x"), (2, 1, "C", "y")], "k int, o int, name string, detail string")
    nested = P.nested_list(df, "k", "o", ["name", "detail"])
    out = {r.k: r.s for r in nested.select("k", P.joined_list(F.col("items"), "name", "detail").alias("s")).collect()}
    assert out == {1: "A (x); B", 2: "C (y)"}


def test_positions_with_payload_and_without_exchange_reuse(spark):
    from pyspark.sql import Window

    from quarry.operators.prepare import positional_index

    rows = spark.range(120_000).selectExpr(
        "if(id % 3 = 0, 0, id % 500) as k", "xxhash64(id) as o", "id as payload", "concat('x', id) as more").unionByName(
        spark.createDataFrame([(None, 2, -1, None), (None, 1, -2, None)], "k long, o long, payload long, more string"))
    want = rows.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("o")) - 1).select("payload", "want")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = positional_index(rows, "k", "o")
        assert got.columns == [*rows.columns, "pos"] and dict(got.dtypes)["pos"] == "bigint"
        joined = got.join(want, "payload")
        assert joined.count() == 120_002 and joined.where("pos != want").count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
