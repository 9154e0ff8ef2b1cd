import hashlib
import zlib

import pytest

from quarry.llm import extraction, warc

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies <button>ok</button></div>
<div class="layout"><div class="sidebar"><p>Long sidebar text here.</p></div><main><article class="post-12"><h1>Title &amp; more</h1>
<p>First <a href="x">link</a>&nbsp;para&#8217;s   text with some length.</p><ul><li>one<li>two</ul><div class="ad">Buy now</div><form>Name <input name=q></form>
<p>Second<br>line</article><section id="comments"><p>A reader comment that is long, long, long, long, long, long, long.</p></section></main></div><footer>(c)</footer>"""
TEXT = "Title & more\nFirst link para’s text with some length.\none\ntwo\nSecond line"


@pytest.mark.parametrize("source, text", [
    (PAGE, TEXT), (None, ""), ("", ""), ("<", "<"), ("<p", ""), ("plain text", "plain text"), ("<p>x<p>y", "x\ny"), ("</p>" * 3, ""),
    ("<script>never closed <p>x</p>", ""), ("<a title='>'>q</a>", "q"), ("<div>" * 3000 + "deep", "deep"), ("<p>a<!-- <p>b --> c</p>", "a c"),
    ("<table><tr><td>1<td>2</table>", "1\n2"), ("<p>caf&eacute; &lt;b&gt; &#x41;</p>", "café <b> A"), ("<nav>menu</nav><p>t</p>", "t"),
])
def test_main_text(source, text):
    assert extraction.main_text(source) == text


LONG = "A sentence of the article with some length. " * 4


@pytest.mark.parametrize("start, end", [
    ("<div class='content-sidebar-wrap'>", "</div>"), ("<div id='page' class='has-sidebar'>", "</div>"), ("<div class='post no-comments'>", "</div>"),
    ("<div class='widget'><section id='search'>", "</section></div>"), ("<div class='social'><div class='inner'>", "</div></div>"),
])
def test_wrappers_with_furniture_names_keep_the_article(start, end):
    for inner in ("article", "main", "div"):
        page = f"<body><div class='sidebar'><p>Side text.</p></div>{start}<{inner}><p>{LONG}</p></{inner}>{end}<div class='legal'><p>Some rights.</p></div></body>"
        assert extraction.main_text(page).startswith(LONG.strip()) and "Side" not in extraction.main_text(page)


def test_parts_of_the_article_stay_and_furniture_goes():
    page = f"""<body><article><div class='header'><h1 class='banner'>Title</h1></div><p class='notice'>{LONG}</p><h2 id='social-impact'>Impact</h2><p>{LONG}</p>
<section id='related-work'><h2 id='search-results'>Results</h2><p>{LONG}<span class='ad'>x</span></p></section><div class='share-buttons'>Share</div>
<div class='related_posts'><article>Teaser</article></div></article><ol class='commentlist'><li><article><p>{LONG * 9}</p></article></ol></body>"""
    text = LONG.strip()
    assert extraction.main_text(page) == "\n".join(["Title", text, "Impact", text, "Results", LONG + "x"])


def test_hosts_vote(spark):
    post = lambda i: f"<body><div class='c'><p>{'body text ' * 5}{i}</p></div><div class='teaser'><p>more</p></div></body>"
    odd = f"<body><div class='c'><p>{'short. ' * 3}</p></div><div class='teaser'><p>{'a very long teaser ' * 9}</p></div></body>"
    rows = [(i, f"http://h.example/{i}", post(i), 1) for i in range(9)] + [(9, "http://H.example:80/9", odd, 1), (10, None, PAGE, 1), (10, None, PAGE, 1), (11, "http://h.example/n", None, 1), (12, "x", "", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id, r.text) for r in extraction.extract(pages).select("_row.page_id", "text").collect())
    assert (0, ("body text " * 5) + "0") in got and got.count((10, TEXT)) == 2 and (11, "") in got and (12, "") in got
    assert (9, ("short. " * 3).strip()) in got  # the host's path wins over the page's longest block
    assert extraction.extract(pages.limit(0)).collect() == []


def test_archives_round_trip(spark, tmp_path):
    big, other = "é" * 600, "b" * 1000
    rows = [(1, "u\n1", big), (2, None, big), (3, "u", other), (4, "u", "b" * 999), (5, "u", "b" * 999), (6, "u", None), (7, "u", ""), (8, "u", big), (3, "u", other), (9, "u", "x" * 3_000_000), (None, "u", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write(pages.withColumn("digest", pages.url), str(tmp_path))
    assert index.count() == len(rows)
    found = warc.read(index, str(tmp_path)).collect()
    got = sorted((r.page_key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    want = []
    for i, _, t in rows:
        raw = (t or "").encode()
        revisit = i in (1, 2)
        want.append(("" if i is None else str(i), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", "8" if revisit else None))
    assert got == sorted(want) and all(r.intact for r in found)
    assert {r.page_key: r.payload for r in found}["8"] == big.encode()
    some = warc.read(index.where("page_key in ('4', '9')"), str(tmp_path)).collect()
    assert sorted(r.page_key for r in some) == ["4", "9"]
    whole = b"".join(zlib.decompress(p.read_bytes()[r.offset:r.offset + r.length], 31) for r in index.collect() for p in [tmp_path / r.file.rsplit("/")[-1]])
    assert whole.count(b"WARC/1.1\r\n") == len(rows)
    assert warc.read(warc.write(pages.limit(0), str(tmp_path)), str(tmp_path)).collect() == []


def test_ranges_are_merged():
    assert warc.merged([(0, 10), (10, 5), (100, 5), (10**7, 3)]) == [(0, 105, [(0, 10), (10, 5), (100, 5)]), (10**7, 10**7 + 3, [(10**7, 3)])]
