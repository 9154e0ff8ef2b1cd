"""Section extraction from article HTML as per-row column expressions.

A page is cut into ordered blocks with regular expressions (no HTML parser
library): script/style/comments are dropped, every opening block tag
(h1/h2/h3/p by default) starts a block, and container tags (div, nav,
footer, ...) end one; an unclosed <p> therefore ends at the next block.
The section is then a left fold over the page's blocks (``aggregate``):

  * a start tag whose text is one of ``headings`` (any text when
    ``headings`` is None) opens the section; the heading itself is skipped;
  * after that, the first ``stop_tags`` block that is not a start closes it
    for good (a later second matching heading is ignored);
  * every other non-empty block in between is kept (sub-headings included).

Everything is row-local: no shuffle, no window, no Python UDF; a page is
processed where it is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from ..functions import text as T

BLOCK_TAGS = ("h1", "h2", "h3", "p")
CONTAINER_TAGS = (
    "html", "head", "body", "div", "article", "section", "nav", "header", "footer", "main", "aside",
    "ul", "ol", "li", "table", "tr", "td", "th", "form", "title",
)

# HTML entities decoded in block text (&amp; last).
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)

OPEN, SEP = "\x01", "\x02"


def drop_pattern() -> str:
    return r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"


def block_open_pattern(block_tags: Sequence[str] = BLOCK_TAGS) -> str:
    return r"(?i)<(" + "|".join(block_tags) + r")(?:\s[^>]*)?>"


def boundary_pattern(block_tags: Sequence[str] = BLOCK_TAGS) -> str:
    closing = "|".join(tuple(block_tags) + CONTAINER_TAGS)
    opening = "|".join(CONTAINER_TAGS)
    return r"(?i)</(?:" + closing + r")\s*>|<(?:" + opening + r")(?:\s[^>]*)?>"


def marked(html: Column, block_tags: Sequence[str] = BLOCK_TAGS) -> Column:
    c = F.regexp_replace(html, F.lit(drop_pattern()), F.lit(" "))
    c = F.regexp_replace(c, F.lit(block_open_pattern(block_tags)), F.lit(OPEN + "$1" + SEP))
    return F.regexp_replace(c, F.lit(boundary_pattern(block_tags)), F.lit(OPEN + "/" + SEP))


def block_text(body: Column) -> Column:
    c = F.regexp_replace(body, F.lit(r"<[^>]+>"), F.lit(" "))
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return T.collapse_ws(c)


def blocks(html: Column, block_tags: Sequence[str] = BLOCK_TAGS) -> Column:
    """array<struct<tag, text>> of the page's blocks in document order."""
    segs = F.split(marked(html, block_tags), OPEN)
    parsed = F.transform(
        F.filter(segs, lambda s: F.locate(SEP, s) > F.lit(0)),
        lambda s: F.struct(
            F.lower(F.substring_index(s, SEP, 1)).alias("tag"),
            block_text(F.substring_index(s, SEP, -1)).alias("text"),
        ),
    )
    tags = F.array(*[F.lit(t) for t in block_tags])
    return F.filter(parsed, lambda b: F.array_contains(tags, b["tag"]))


def section_parts(blk: Column, start_tags: Sequence[str] = ("h2", "h3"),
                  headings: Iterable[str] | None = config.PLOT_HEADINGS,
                  stop_tags: Sequence[str] = ("h2",)) -> Column:
    """Texts of the section's blocks (array<string>), empty when none."""
    starts = F.array(*[F.lit(t) for t in start_tags])
    stops = F.array(*[F.lit(t) for t in stop_tags])
    heads = F.array(*[F.lit(h) for h in headings]) if headings is not None else None

    def state(started, stopped, parts):
        return F.struct(started.alias("started"), stopped.alias("stopped"), parts.alias("parts"))

    init = state(F.lit(False), F.lit(False), F.array().cast("array<string>"))

    def step(acc, b):
        is_start = F.array_contains(starts, b["tag"])
        if heads is not None:
            is_start = is_start & F.array_contains(heads, F.lower(b["text"]))
        return (
            F.when(acc["stopped"], acc)
            .when(is_start, state(F.lit(True), F.lit(False), acc["parts"]))
            .when(acc["started"] & F.array_contains(stops, b["tag"]), state(F.lit(True), F.lit(True), acc["parts"]))
            .when(acc["started"] & (b["text"] != F.lit("")),
                  state(F.lit(True), F.lit(False), F.array_append(acc["parts"], b["text"])))
            .otherwise(acc)
        )

    return F.aggregate(blk, init, step, lambda acc: acc["parts"])


def section_text(parts: Column) -> Column:
    """Joined section, null when empty (ND5)."""
    return F.when(F.size(parts) > 0, F.array_join(parts, " "))


def extraction_status(section: Column, error: Column | None = None) -> Column:
    """ND6: 'not_found' for an error response, else 'ok' / 'no_plot'."""
    st = F.when(section.isNotNull(), F.lit("ok")).otherwise(F.lit("no_plot"))
    if error is not None:
        st = F.when(error, F.lit("not_found")).otherwise(st)
    return st
