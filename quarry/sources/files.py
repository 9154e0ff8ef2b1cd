"""File sources and sinks: CSV, JSON Lines, TREC runs and qrels.

Every reader takes an explicit schema (never ``inferSchema``) and returns a
lazy DataFrame; every writer is a distributed ``DataFrame.write``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.globStatus(p) is not None and len(fs.globStatus(p)) > 0


def read_csv(spark: SparkSession, path: str, schema: StructType | str, bom: bool = True) -> DataFrame:
    """SC1 + SC2: header CSV, UTF-8, quoted fields with embedded newlines.
    With ``bom`` a leading U+FEFF is removed from the first column's values
    (a BOM file shifts it into the header, which the schema replaces)."""
    df = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        .option("encoding", "UTF-8").schema(schema).csv(path)
    )
    if bom:
        first = df.columns[0]
        df = df.withColumn(first, F.regexp_replace(F.col(first), "^﻿", ""))
    return df


def read_csv_by_name(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """SC1 + SC2: like ``read_csv``, all strings and found by their header
    names (a byte-order mark before the first is ignored), in whatever order;
    a column that the file lacks is empty, others are left out. Empty fields
    are empty strings. ``_metadata`` stays available."""
    df = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
        .option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    )
    named = {c.lstrip("\ufeff").strip('"'): c for c in reversed(df.columns)}
    there = [F.coalesce(F.col(f"`{named[c]}`"), F.lit("")).alias(c) if c in named else F.lit("").alias(c) for c in columns]
    return df.select(*there, "_metadata")


def read_optional(spark: SparkSession, path: str, schema: StructType | str, reader=None) -> DataFrame:
    """SC3: a missing input is an empty table of the declared schema."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return (reader or (lambda p: read_csv(spark, p, schema)))(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SC4: JSON Lines of nested documents with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_jsonl_lenient(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """SC5: a JSON-lines archive read as text; each line is classified
    (blank, malformed, non_object, missing_<key>, ok) and kept with its line
    number, so rejects are a filter away and nothing stops the job."""
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    v = F.try_parse_json(F.col("value"))
    status = F.when(F.trim("value") == "", F.lit("blank")).when(v.isNull(), F.lit("malformed")).when(
        ~F.schema_of_variant(v).startswith("OBJECT"), F.lit("non_object")
    )
    for key in required:
        status = status.when(F.try_variant_get(v, f"$.{key}", "variant").isNull(), F.lit(f"missing_{key}"))
    return lines.select("line_no", F.col("value").alias("raw"), v.alias("record"), status.otherwise(F.lit("ok")).alias("status"))


def read_trec_run(spark: SparkSession, path: str) -> DataFrame:
    """SC6: whitespace-separated ``qid Q0 docid rank score run_id``; a line
    with fewer than six fields fails the job. (run_id, qid, doc, rank, score)."""
    parts = F.split(T.py_strip(F.col("value")), r"\s+")
    lines = spark.read.text(path).filter(T.py_strip(F.col("value")) != "")
    checked = lines.select(
        F.when(F.size(parts) >= 6, parts).otherwise(
            F.raise_error(F.concat(F.lit("TREC run line has fewer than 6 fields: "), F.col("value")))
        ).alias("p")
    )
    return checked.select(
        F.col("p")[5].alias("run_id"), F.col("p")[0].alias("qid"), F.col("p")[2].alias("doc"),
        F.col("p")[3].cast("int").alias("rank"), F.col("p")[4].cast("double").alias("score"),
    )


def read_json_run(spark: SparkSession, path: str) -> DataFrame:
    """SC7: per-query JSON results, one record a line (``qid``, ``results[]``); rank
    defaults to the position, a null score to 0."""
    schema = "qid string, results array<struct<rank:int, movie_id:string, score:double>>"
    raw = spark.read.schema(schema).json(path)
    ex = raw.select("qid", F.posexplode("results").alias("pos", "r"))
    return ex.select(
        "qid", F.col("r.movie_id").alias("doc"),
        F.coalesce(F.col("r.rank"), F.col("pos") + 1).alias("rank"),
        F.coalesce(F.col("r.score"), F.lit(0.0)).alias("score"),
    )


def resolve_run(trec: DataFrame, json_run: DataFrame) -> DataFrame:
    """SC8: prefer the TREC rows; queries absent there (zero-hit queries are
    not written to TREC files) come from the JSON run. A (qid, doc) that both
    hold with different ranks fails the job when the result is read."""
    other = json_run.select("qid", "doc", F.col("rank").alias("_rank"))
    clash = F.col("_rank").isNotNull() & (F.col("_rank") != F.col("rank"))
    trec = trec.join(other, ["qid", "doc"], "left").select(
        "qid", "doc", F.when(clash, F.raise_error(F.concat(F.lit("runs disagree on "), "qid", F.lit(" "), "doc"))).otherwise(F.col("rank")).alias("rank"), "score")
    missing = json_run.join(trec.select("qid").distinct(), "qid", "left_anti")
    return trec.select("qid", "doc", "rank", "score").unionByName(missing.select("qid", "doc", "rank", "score"))


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """SC9: judgments CSV (qid, docid, rel, ...). Blank grades are skipped,
    a grade outside 0/1/2 fails the job, and for a repeated (qid, docid) the
    last row wins (file order)."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.withColumn("_seq", F.monotonically_increasing_id())
    df = df.filter(F.col("rel").isNotNull() & (F.trim("rel") != ""))
    rel = F.trim("rel")
    checked = df.withColumn(
        "rel", F.when(rel.isin("0", "1", "2"), rel.cast("int")).otherwise(
            F.raise_error(F.concat(F.lit("invalid grade: "), rel))
        )
    )
    w = Window.partitionBy("qid", "docid").orderBy(F.col("_seq").desc())
    last = checked.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return last.select("qid", F.col("docid").alias("doc"), "rel")


def write_trec_run(run: DataFrame, path: str, run_id: str) -> None:
    """SC13 / SC14: ``qid Q0 docid rank score run_id`` sorted by need, rank."""
    line = F.concat_ws(" ", F.col("qid").cast("string"), F.lit("Q0"), F.col("doc").cast("string"),
                       F.col("rank").cast("string"), F.format_string("%.6f", F.col("score")), F.lit(run_id))
    run.orderBy("qid", "rank").select(line.alias("value")).write.mode("overwrite").text(path)


def write_trec_qrels(qrels: DataFrame, path: str) -> None:
    """SC13: ``qid 0 docid rel`` sorted by need, docid."""
    line = F.concat_ws(" ", F.col("qid").cast("string"), F.lit("0"), F.col("doc").cast("string"),
                       F.col("rel").cast("string"))
    qrels.orderBy("qid", "doc").select(line.alias("value")).write.mode("overwrite").text(path)


def write_run_json(run: DataFrame, path: str) -> None:
    """SC14: one JSON record per need, ``{qid, results: [{rank, movie_id,
    score}, ...]}`` in rank order, as ``read_json_run`` reads them. A need's
    results are as many as the run's depth."""
    item = F.struct("rank", F.col("doc").cast("string").alias("movie_id"), "score")
    needs = run.groupBy(F.col("qid").cast("string").alias("qid")).agg(F.array_sort(F.collect_list(item)).alias("results"))
    needs.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """SC12: fixed column list, extra columns ignored, header row, quotes
    inside a field doubled as the readers expect."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", chr(34)).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """SC11: nested documents as JSON Lines (UTF-8, non-ASCII kept)."""
    df.write.mode("overwrite").json(path)


def manifest(counts: dict[str, DataFrame]) -> DataFrame:
    """SC15: one row of named counts (each a ``count()`` of a DataFrame,
    computed as aggregates and joined, never collected)."""
    out = None
    for name, df in counts.items():
        c = df.agg(F.count(F.lit(1)).alias(name)).withColumn("_k", F.lit(1))
        out = c if out is None else out.join(c, "_k")
    return out.drop("_k")
