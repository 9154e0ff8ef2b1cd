"""Incremental resume: a second delivery is processed once, old ids skipped."""

import uuid

from pyspark.sql import functions as F

from quarry.functions import analyze as A
from quarry.streaming.incremental import resume_append


def test_resume_append(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "Cats run"), (2, "Dogs bark")], "doc_id long, text string").write.parquet(src + "/a")

    def process(df):
        return df.select("doc_id", F.size(A.analyze("text")).alias("dl"))

    name = "t-" + uuid.uuid4().hex
    schema = "doc_id long, text string"
    assert resume_append(spark, src, schema, "doc_id", out, process, name) == 2
    # new delivery: one new id, one already processed id
    spark.createDataFrame([(2, "Dogs bark"), (3, "Birds sing songs")], schema).write.parquet(src + "/b")
    assert resume_append(spark, src, schema, "doc_id", out, process, name) == 1
    assert resume_append(spark, src, schema, "doc_id", out, process, name) == 0
    rows = sorted((r.doc_id, r.dl) for r in spark.read.parquet(out).collect())
    assert rows == [(1, 2), (2, 2), (3, 3)]
