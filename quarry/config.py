"""Parameters and fixed values shared by the Spark jobs and their SQL oracles.

Everything that must be identical between the DataFrame code and the
DuckDB cross-check lives here, so both sides are generated from one place.
"""

from __future__ import annotations

import unicodedata

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# BM25 (Robertson & Zaragoza 2009) defaults.
BM25_K1 = 1.2
BM25_B = 0.75

# Default top-k depth of a run and pooling depth.
RUN_DEPTH = 20

# Reciprocal-rank-fusion constant.
RRF_K = 60

# Analyzer stopwords: the public Lucene/Solr English stop set.
ANALYZER_STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
)

# Section headings that open a plot section in article HTML.
PLOT_HEADINGS = ("plot", "synopsis", "premise", "plot summary")

# Word-token pattern of the analyzer (letters, digits, underscore; inner
# apostrophe or period keeps a token together).
TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"

# Word pattern of the corpus term-frequency profile (ASCII letters and ').
PROFILE_WORD_PATTERN = r"[a-z']+"

# Multi-letter folds that a one-to-one translate cannot express.
MULTI_FOLDS = (("ß", "ss"), ("æ", "ae"), ("œ", "oe"))

# Single-letter folds without a canonical decomposition.
EXTRA_FOLDS = (("ø", "o"), ("đ", "d"), ("ł", "l"), ("ı", "i"), ("ħ", "h"))


def _fold_table() -> tuple[str, str]:
    """Accent-fold table built by rule: every lower-case Latin letter in
    U+00C0..U+024F whose canonical decomposition is an ASCII letter followed
    by combining marks maps to that ASCII letter."""
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        ch = chr(cp)
        if ch != ch.lower():
            continue
        d = unicodedata.normalize("NFD", ch)
        if (
            len(d) > 1
            and d[0].isascii()
            and d[0].isalpha()
            and all(unicodedata.combining(x) for x in d[1:])
        ):
            src.append(ch)
            dst.append(d[0])
    for a, b in EXTRA_FOLDS:
        src.append(a)
        dst.append(b)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()

# Broadcast bound: a side is broadcast only when it has at most this many rows.
BROADCAST_MAX_ROWS = 2_000_000

# Rows that one task makes out of its postings (about 100 bytes each in a hash
# aggregate or a sort); the number of tasks follows from it.
TASK_ROWS = 1_000_000

# Rows of a batch's query terms up to which every task holds them as arrays and
# scores whole blocks of documents; more are joined.
HELD_TERMS = 100_000
