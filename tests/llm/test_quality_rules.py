import re

import numpy as np
import pandas as pd

from quarry.llm import decision_list


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    where = {}
    for i in range(len(words) - 2):
        where.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def test_counts_equal_brute_force(docs_of, prose):
    texts = [None, "", " \n\t ", "a b c a b c", "é ß 日本 x", "l\nl\n\n\nl ", "a#b *c* | <d> &", "x " * 60, prose(1, 80) + "\n" + prose(1, 80), prose(3, 50_000), "u v w\x0bx\x1fy"]
    rows = list(enumerate(texts)) + [(0, None)]
    got = decision_list.judge(docs_of(rows), [], carry=["doc_id", "n_words"]).select("_row.doc_id", *decision_list.COUNTS, "base_failed", "kept").collect()
    assert sorted(tuple(r) for r in got) == sorted((i, *brute(t), not brute(t)[-1]) for i, t in rows)
    assert decision_list.judge(docs_of([]), []).collect() == []


def test_rules_are_found_and_applied_in_order(spark):
    rng = np.random.default_rng(0)
    rows = pd.DataFrame({f: rng.random(3000) for f in decision_list.FEATURES})
    bad = ((rows["symbol_share"] > 0.8) | (rows["upper_share"] > 0.7) & (rows["mean_word"] <= 0.3)).to_numpy()
    rules = decision_list.learn_rules(rows, bad)
    assert {c.feature for r in rules for c in r} >= {"symbol_share", "upper_share", "mean_word"}
    got = spark.createDataFrame(rows).select(decision_list.verdict(rules).alias("rule")).toPandas()["rule"].to_numpy()
    assert ((got > 0) == bad).mean() > 0.98
    first = [next((i for i, r in enumerate(rules, 1) if all(c.holds(rows.iloc[[k]])[0] for c in r)), 0) for k in range(50)]
    assert first == got[:50].tolist()


def test_no_labels_no_rules(spark, docs_of, prose):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert decision_list.learn(docs_of([(1, prose(1, 60))]), none) == []
