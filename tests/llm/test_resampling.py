import math

import numpy as np
import pytest

from quarry.llm import resampling


def test_good_text_is_kept_and_sampled(spark, docs_of, prose):
    rows = [(i, prose(i, 80)) for i in range(200)] + [(1000 + i, prose(i, 60) + " zqx zqy zqx2") for i in range(100)] + [(2000, None), (2001, ""), (2002, prose(1, 30_000))]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)] + [(1000 + i, 1, 1) for i in range(80)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = resampling.resample(docs_of(rows), labels).collect()
    verdict = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert sum(verdict[i].kept for i in range(200)) >= 190 and sum(verdict[1000 + i].kept for i in range(100)) <= 10
    assert not verdict[2000].kept and verdict[2001].n_grams == 0 and verdict[2000].log_ratio == 0
    assert sum(r.selected for r in got) == math.ceil(0.25 * len(rows))
    assert min(r.gumbel_key for r in got if r.selected) > max(r.gumbel_key for r in got if not r.selected)


def test_no_labels_no_rows(spark, docs_of, prose):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = resampling.resample(docs_of([(i, prose(i, 9)) for i in range(8)]), none).collect()
    assert all(r.kept and r.log_ratio == 0 for r in got) and sum(r.selected for r in got) == 2
    assert resampling.resample(docs_of([]), none).collect() == []


@pytest.mark.parametrize("k", [1, 777, 25_000, 40_000])
def test_kth_largest(spark, k):
    values = np.random.default_rng(0).gumbel(size=40_000) * 1e3
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert resampling.kth_largest(frame, "v", k) == np.sort(values)[-k]
    assert resampling.kth_largest(frame, "v", 40_001) is None
    assert resampling.kth_largest(frame.selectExpr("1.5D as v"), "v", k) == 1.5


def test_repeats_count_in_the_ratio(spark):
    """The weight is the log ratio of the probabilities of all occurrences."""
    import pyarrow as pa
    from types import SimpleNamespace

    w = np.random.default_rng(1).normal(size=resampling.BUCKETS)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2]), pa.array(["x", "x x x", None])], ["_row", "t"])
    one, three, none = [r for b in resampling._scorer(SimpleNamespace(value=w))(iter([batch])) for r in b.to_pylist()]
    assert (one["n_grams"], three["n_grams"], none["n_grams"]) == (1, 5, 0)
    pair = (three["log_ratio"] - 3 * one["log_ratio"]) / 2
    assert np.isclose(w[resampling.BUCKETS // 2:], pair).any() and none["log_ratio"] == 0
