import pytest

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, lang]) rows with columns whose
    names clash with the operators' own results."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        return frame.selectExpr("*", "'x' as n_words", "1 as kept", "2 as score", "3 as spans")

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic invented sentences."""
    def make(seed, n, alphabet="abcdefgh"):
        out, state = [], seed * 2654435761 % 2**32
        for _ in range(n):
            state = (state * 1664525 + 1013904223) % 2**32
            word = "".join(alphabet[(state >> s) % len(alphabet)] for s in (4, 9, 14, 19, 24))
            out.append(word[: 2 + state % 4])
        return " ".join(out)

    return make
