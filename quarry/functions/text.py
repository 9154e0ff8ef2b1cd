"""Scalar text and value functions as Spark column expressions.

All regexes are written so that Java (Spark) and RE2 give the same matches:
whitespace is an explicit character class (the set Python's ``str.isspace``
accepts), ``.`` runs in UNIX_LINES mode, and ``^`` in multi-line mode starts
only after ``\\n``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace characters of Python's str.isspace(), written
# out for RE2 (the SQL cross-check) ...
WS_SQL = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NON_WS_SQL = "[^" + WS_SQL[1:]
# ... and for Java, where the Unicode White_Space class plus U+001C..U+001F
# is the same set and about four times faster than the spelled-out class.
WS = r"(?U:[\s\x{1C}-\x{1F}])"
NON_WS = r"(?U:[^\s\x{1C}-\x{1F}])"

# Numeric literal accepted by Python's float() (after trimming),
# excluding infinities and NaN, which cannot become an integer.
FLOAT_LITERAL = r"^[+-]?(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """Unicode trim (Python ``str.strip()``)."""
    return F.regexp_replace(_c(col), F.lit(f"^{WS}+|{WS}+$"), F.lit(""))


def blank_to_null(col: Column | str) -> Column:
    """FN6: trimmed text, or null when blank."""
    s = py_strip(col)
    return F.when(s == F.lit(""), F.lit(None).cast("string")).otherwise(s)


def strip_markup(col: Column | str) -> Column:
    """FN1: tags, bullet markers, **bold**, _italic_ removed, then trimmed."""
    c = F.regexp_replace(_c(col), F.lit(r"<[^>]+>"), F.lit(""))
    c = F.regexp_replace(c, F.lit(rf"(?md)^{WS}*\*{WS}+"), F.lit(""))
    c = F.regexp_replace(c, F.lit(r"(?d)\*\*(.*?)\*\*"), F.lit("$1"))
    c = F.regexp_replace(c, F.lit(r"(?d)_(.*?)_"), F.lit("$1"))
    return py_strip(c)


def word_count(col: Column | str) -> Column:
    """FN3: number of whitespace-separated words."""
    return F.regexp_count(_c(col), F.lit(NON_WS + "+"))


def collapse_ws(col: Column | str) -> Column:
    """FN17: runs of whitespace become one space, then trimmed."""
    return py_strip(F.regexp_replace(_c(col), F.lit(WS + "+"), F.lit(" ")))


def strip_footnotes(col: Column | str) -> Column:
    """FN10: remove [12] / [a] markers, then trim."""
    return py_strip(F.regexp_replace(_c(col), F.lit(r"\[(?:\d+|[a-z])\]"), F.lit("")))


def crlf_to_lf(col: Column | str) -> Column:
    """FN13."""
    return F.replace(_c(col), F.lit("\r\n"), F.lit("\n"))


def safe_double(col: Column | str, zero_to_null: bool = False) -> Column:
    """FN5: Python-float-like parse of a string; blank/invalid -> null."""
    s = py_strip(_c(col).cast("string"))
    ok = s.rlike(FLOAT_LITERAL)
    v = F.when(ok, F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
    if zero_to_null:
        v = F.when(v != F.lit(0.0), v)
    return v


def safe_long(col: Column | str, zero_to_null: bool = False) -> Column:
    """FN4: trunc(float(x)); blank/invalid/out of range -> null."""
    d = safe_double(col)
    v = F.when(F.abs(d) < F.lit(9.2e18), d.cast("long"))
    if zero_to_null:
        v = F.when(v != F.lit(0), v)
    return v


def split_list(col: Column | str, sep: str = ";") -> Column:
    """FN7: split on a separator, trim parts, drop empty parts."""
    parts = F.transform(F.split(_c(col), F.lit(_re_escape(sep))), lambda x: py_strip(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def _re_escape(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def parse_name_paren(col: Column | str, drop_all_trailing: bool = False) -> Column:
    """FN8/FN9: ``Name (Detail)`` entries of a ``;`` list ->
    array<struct<name, detail, order>>. Split at the first '('; drop one
    trailing ')' (FN8) or all trailing ')' (FN9); blank detail -> null;
    ``order`` is the output position."""
    entries = split_list(col, ";")

    def one(e: Column, i: Column) -> Column:
        has = F.locate("(", e) > F.lit(0)
        name = F.when(has, F.substring_index(e, "(", 1)).otherwise(e)
        rest = F.when(has, e.substr(F.locate("(", e) + F.lit(1), F.lit(10**9)))
        if drop_all_trailing:
            rest = F.regexp_replace(rest, F.lit(r"\)+$"), F.lit(""))
        else:
            rest = F.regexp_replace(rest, F.lit(r"\)$"), F.lit(""))
        detail = blank_to_null(rest)
        return F.struct(py_strip(name).alias("name"), detail.alias("detail"), i.alias("order"))

    return F.transform(entries, one)


def date_prefix(col: Column | str) -> Column:
    """FN11: the YYYY-MM-DD prefix or null."""
    v = F.regexp_extract(_c(col), r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.when(v != F.lit(""), v)


def year_of(col: Column | str, lo: int = 1800, hi: int = 2100) -> Column:
    """FN12: first four digits of a valid date, null outside [lo, hi]."""
    y = F.substring(date_prefix(col), 1, 4).try_cast("int")
    return F.when(y.between(lo, hi), y)


def url_title(col: Column | str) -> Column:
    """FN14: last path segment of a URL, '_' -> ' ', percent-decoded
    ('+' is kept literally)."""
    seg = F.element_at(F.split(_c(col), F.lit("/")), -1)
    seg = F.replace(F.replace(seg, F.lit("_"), F.lit(" ")), F.lit("+"), F.lit("%2B"))
    return F.try_url_decode(seg) if hasattr(F, "try_url_decode") else F.url_decode(seg)


def format_score(col: Column | str, decimals: int = 6) -> Column:
    """FN22."""
    return F.format_string(f"%.{decimals}f", _c(col))


def composite_key(prefix: str, col: Column | str, child: str | None = None,
                  child_col: Column | str | None = None) -> Column:
    """FN23: ``prefix-<id>`` or ``prefix-<id>-child-<n>``."""
    parts = [F.lit(prefix + "-"), _c(col).cast("string")]
    if child is not None and child_col is not None:
        parts += [F.lit(f"-{child}-"), _c(child_col).cast("string")]
    return F.concat(*parts)


def remove_words(col: Column | str, pattern: str) -> Column:
    """FN24: words matching a pattern become a space."""
    return F.regexp_replace(_c(col), F.lit(pattern), F.lit(" "))


def replace_map(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """FN25: exact replacements applied in order."""
    c = _c(col)
    for a, b in mapping.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def profile_words(col: Column | str, stopwords: Iterable[str], min_len: int = 3) -> Column:
    """FN16: lower-case ASCII word tokens [a-z']+, stopwords and tokens
    shorter than ``min_len`` removed."""
    stop = F.array(*[F.lit(w) for w in stopwords]).cast("array<string>")
    toks = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"[a-z']+"), 0)
    return F.filter(toks, lambda t: ~F.array_contains(stop, t) & (F.length(t) >= F.lit(min_len)))


def substring_matches(text: Column | str, terms: Column) -> Column:
    """FN18: terms contained in the text, case-folded, not word-bounded."""
    low = F.lower(_c(text))
    return F.filter(terms, lambda t: F.position(F.lower(t), low) > F.lit(0))


def title_or_url(title: Column | str, url: Column | str) -> tuple[Column, Column]:
    """FN15: (title, origin): the given title, else the one that the address
    ends with, else null; origin is link, url or unmatched."""
    given, derived = blank_to_null(title), blank_to_null(url_title(url))
    origin = F.when(given.isNotNull(), F.lit("link")).when(derived.isNotNull(), F.lit("url")).otherwise(F.lit("unmatched"))
    return F.coalesce(given, derived), origin
