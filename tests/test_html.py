"""Section extraction on hand-made pages (plot headings at h2/h3)."""

from pyspark.sql import functions as F

from quarry.operators import html as H

PAGES = [
    (1, "<h2>Cast</h2><p>x</p><h2>Plot</h2><p>One <b>two</b>.</p><p>Three &amp; four</p><h2>Reception</h2><p>no</p>"),
    (2, "<h2>Background</h2><h3>Synopsis</h3><p>A</p><h3>Ending</h3><p>B</p><h2>Music</h2><p>C</p>"),
    (3, "<h2>Plot</h2><p>first</p><h2>Release</h2><h2>Plot</h2><p>second</p>"),
    (4, "<h2>Cast</h2><p>nothing here</p>"),
    (5, "<script>var t='</p>';</script><h2 id='p'>Plot summary</h2><p class='c'>open<p>next<!-- <h2>x</h2> --></div>"),
]


def test_plot_sections(spark):
    df = spark.createDataFrame(PAGES, "id int, html string")
    parts = H.section_parts(H.blocks(F.col("html")))
    sec = H.section_text(parts)
    out = {r[0]: (r[1], r[2]) for r in df.select("id", sec, H.extraction_status(sec)).collect()}
    assert out[1] == ("One two . Three & four", "ok")
    assert out[2] == ("A Ending B", "ok")
    assert out[3] == ("first", "ok")
    assert out[4] == (None, "no_plot")
    assert out[5] == ("open next", "ok")
