import itertools

import numpy as np

from quarry.llm import setsketch


def sets_of(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(5))))


def brute(rows):
    sets = {i: sets_of(t) for i, t in rows}
    comp = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y) and comp[a] != comp[b]:
            low, high = sorted((comp[a], comp[b]))
            comp = {i: low if c == high else c for i, c in comp.items()}
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def answer(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def test_components_equal_brute_force(docs_of, prose):
    rows, n = [], 0
    for g in range(12):
        words = prose(g, 120).split()
        for k in range(10):  # copies with k changed words, so links straddle the threshold
            own = list(words)
            for j in range(k):
                own[(j * 37 + k * 11 + g) % 120] = f"x{g}{k}{j}"
            rows.append((n, " ".join(own)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one two"), (n + 4, "ONE two"), (n + 5, "one two three"), (n + 6, prose(99, 30_000)), (n + 7, prose(99, 30_000) + " end")]
    assert answer(setsketch.near_duplicates(docs_of(rows))) == brute(rows)


def test_chain_is_one_component(docs_of, prose):
    words = prose(5, 200).split()
    rows = []
    for i in range(12):
        words[i * 9] = f"new{i}"
        rows.append((i, " ".join(words)))
    got = answer(setsketch.near_duplicates(docs_of(rows)))
    assert got == brute(rows)
    assert {c for _, c, _ in got.values()} == {0}


def test_stragglers_of_a_large_group(docs_of, prose):
    """Copies of one text with scattered edits: many share most shingles and
    are linked with nothing, some only with another straggler."""
    base = prose(3, 140).split()
    rows = []
    for i in range(240):
        own = list(base)
        for j in range(i % 12):  # edited places and new words recur between copies
            own[(i * 31 + j * 53) % 140] = f"e{(i * 7 + j) % 40}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, rows[11 + 12 * i][1] + f" tail{i}") for i in range(15)]
    want = brute(rows)
    sizes = {}
    for _, c, _ in want.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert max(sizes.values()) > 80 and 1 in sizes.values() and any(1 < s < 10 for s in sizes.values())
    assert answer(setsketch.near_duplicates(docs_of(rows))) == want


def test_few_pairs_of_stragglers(spark, docs_of, prose):
    """The last step alone: no link between components is missed, and pairs
    stay far below those of the group."""
    base = prose(3, 140).split()
    texts = []
    for i in range(300):
        own = list(base)
        for j in range(i % 12):
            own[(i * 31 + j * 53) % 140] = f"e{(i * 7 + j) % 40}"
        texts.append(" ".join(own))
    texts = list(dict.fromkeys(texts))
    sets = [sets_of(t) for t in texts]
    links = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    top = {0} | {b for a, b in links if a == 0}
    comp = [0 if i in top else i for i in range(len(texts))]
    members = spark.createDataFrame([(7, i, c) for i, c in enumerate(comp)], "bucket long, node long, comp long")
    met = spark.createDataFrame([(i, len(s)) for i, s in enumerate(sets)], "node long, n long")
    written = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    got = {(r.a, r.b) for r in setsketch._remaining(members, met, written).distinct().collect()}
    across = {(a, b) for a, b in links if comp[a] != comp[b]}
    assert across and across <= got
    assert len(got) < len(texts) * (len(texts) - 1) / 2 / 10


def test_repeated_rows_null_ids_and_no_rows(docs_of, prose):
    t = prose(1, 50)
    got = [tuple(r) for r in setsketch.near_duplicates(docs_of([(3, t), (3, t), (5, t), (None, t), (4, "z " * 40)])).select("doc_id", "component_id", "kept").collect()]
    assert sorted(got, key=str) == sorted([(3, 3, True), (3, 3, True), (5, 3, False), (None, 3, False), (4, 4, True)], key=str)
    assert setsketch.near_duplicates(docs_of([])).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 1400).astype(np.uint64)
    a, b = pool[:1000], pool[400:]
    regs = setsketch.registers(np.concatenate((a, b, pool)), np.repeat([0, 1, 2], [1000, 1000, 1400]), 3)
    assert (setsketch.merge(regs[0], regs[1]) == regs[2]).all()
    j, near = setsketch.estimate(regs[:1], regs[1:2], np.array([1000.0]), np.array([1000.0]))
    assert abs(j[0] - 600 / 1400) < 0.1 and not near[0]
