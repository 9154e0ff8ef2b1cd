from quarry.llm import decontamination, licenses


def windows(text):
    words = decontamination.words_of(text)
    return {tuple(words[i:i + 13]) for i in range(max(1, len(words) - 12))} if words else set()


def test_contamination_equals_brute_force(spark, docs_of, prose, monkeypatch):
    items = [(i, prose(900 + i, 5 + 4 * i)) for i in range(12)] + [(50, "Two-words"), (51, None), (52, "..."), (None, prose(1, 30)), (3, prose(903, 17))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    part = prose(908, 37).upper().replace(" ", ", ")
    rows = [(1, prose(2, 100) + " " + part + "\n" + prose(4, 100)), (2, part), (3, prose(5, 4000) + " TWO\twords!"), (4, None), (5, ""), (6, "?!"),
            (7, prose(900, 5)), (7, prose(900, 5)), (8, prose(911, 12)), (9, "é" + prose(900, 5)), (10, prose(7, 60_000))]
    want = set()
    for i, t in rows:
        words, hit, own = decontamination.words_of(t), set(), set()
        for item, text in items:
            for w in windows(text) if item is not None else ():
                for k in range(len(words) - len(w) + 1):
                    if words[k] == w[0] and tuple(words[k:k + len(w)]) == w:
                        hit |= set(range(k, k + len(w)))
                        own.add(str(item))
        want.add((i, len(words), len(hit), tuple(sorted(own)), bool(hit) and 20 * len(hit) >= len(words)))
    for limit in (4_000_000, 300):  # one automaton, and several over parts of the benchmark
        monkeypatch.setattr(decontamination, "PART_BYTES", limit)
        found = decontamination.find(docs_of(rows), benchmark).select("_row.doc_id", "_row.text", "n_words", "n_hit", "items", "spans", "contaminated").collect()
        assert {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found} == want
        assert len(found) == len(rows)
        for r in found:  # offsets point to the hit words of the original text
            assert sum(len(decontamination.words_of(r.text[s["start"]:s["end"]])) for s in r.spans) == r.n_hit
    assert decontamination.find(docs_of([]), benchmark).collect() == []
    assert not decontamination.find(docs_of(rows), benchmark.limit(0)).where("contaminated").collect()



def test_licenses(docs_of, prose):
    mit = licenses.TEMPLATES["MIT"]
    edited = mit.replace("free of charge", "at no cost").upper()
    rows = [(1, prose(1, 300) + "\n" + licenses.TEMPLATES["MIT-notice"] + "\n" + prose(2, 20)), (2, edited), (3, " ".join(mit.split()[:20])), (4, None), (5, ""),
            (6, "released under the mit"), (7, licenses.TEMPLATES["CC-BY-NC-4.0-notice"]), (7, licenses.TEMPLATES["CC-BY-NC-4.0-notice"]), (None, mit), (8, prose(3, 50_000) + " " + mit)]
    got = {(r.doc_id, r.license, r.containment == 1) for r in licenses.scan(docs_of(rows)).collect()}
    assert got == {(1, "MIT-notice", True), (2, "MIT", False), (7, "CC-BY-NC-4.0-notice", True), (None, "MIT", True), (8, "MIT", True)}
    assert licenses.scan(docs_of(rows)).count() == len(got)
    assert licenses.scan(docs_of([])).collect() == []
    assert licenses.scan(docs_of(rows), templates={"short": "mit license"}).collect() == []


def test_every_template_is_found_at_the_start_and_inside(spark, docs_of, prose):
    """Whole texts give their opening passages too, and equal brute force."""
    import re

    def fives(text):
        w = re.findall("[a-z0-9]+", text.lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    rows = []
    for i, body in enumerate(licenses.TEMPLATES.values()):
        rows += [(4 * i, body), (4 * i + 1, body + " " + prose(i, 30)), (4 * i + 2, prose(i, 31 + i % 2) + " " + body), (4 * i + 3, prose(i, 40) + "\n" + body + "\n" + prose(i + 1, 40))]
    want = {(i, name) for i, text in rows for name, body in licenses.TEMPLATES.items()
            if 100 * len(fives(body) & fives(text)) >= 75 * len(fives(body))}
    assert {(r.doc_id, r.license) for r in licenses.scan(docs_of(rows)).collect()} == want
    assert {i for i, _ in want} == {i for i, _ in rows}


def test_a_notice_at_the_start_has_two_windows(spark):
    """The first window begins before the text and holds its first two shingles."""
    from pyspark.sql import functions as F

    one = spark.createDataFrame([(1, "a b c d e f g h i")], "k int, t string").select("k", licenses.words(F.col("t")).alias("_words"))
    cut = licenses._windows(one, ["k"], licenses.STEP)
    assert cut.count() == 4  # five shingles: windows from -2, 0, 2 and 4
