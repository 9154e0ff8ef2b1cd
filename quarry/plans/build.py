"""The collection build as a job over files: five CSV sources in a folder to
the collection, its search rows and the manifest in another.

Outputs are folders of part files. Whatever the sources hold, the parents are
validated and written once before any output, so a build with an invalid
document fails without leaving one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import collection as C
from ..sources import files as FS
from ..sources.store import stage

# Columns of each source; all are strings.
COLUMNS = {
    "movies": ("movie_id", "title", "original_title", "release_date", "runtime", "original_language", "status", "overview", "tagline",
               "genres", "vote_average", "vote_count", "popularity", "budget", "revenue"),
    "credits": ("movie_id", "director", "cast", "crew_names", "crew_roles"),
    "links": ("movie_id", "wikidata_id", "imdb_id", "wikipedia_title", "wikipedia_url", "match_method"),
    "plots": ("movie_id", "status", "plot"),
    "reviews": ("movie_id", "author", "author_rating", "content", "created_at"),
}


def read_sources(spark: SparkSession, folder: str, names: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The five sources with a sequence column (file, row), from ``movies.csv``
    and so on or the file names in ``names``; a file that is not there is an
    empty table. Columns are found by name, in any order; one that
    a file lacks is empty."""
    out = {}
    for name, columns in COLUMNS.items():
        path = f"{folder.rstrip('/')}/{(names or {}).get(name, f'{name}.csv')}"
        if not FS.exists(spark, path):
            out[name] = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", seq struct<file:string,row:long>")
            continue
        df = FS.read_csv_by_name(spark, path, columns)
        out[name] = df.withColumn("seq", F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))).select(*columns, "seq")
    return out


def build(spark: SparkSession, source: str, target: str, strict: bool = True, min_words: int = C.MIN_PLOT_WORDS, most_reviews: int = 100_000,
          names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Build the collection from ``source`` into ``target`` and return the
    paths of its parts: ``collection`` (nested JSON lines, nulls kept),
    ``search_rows`` (JSON lines, null fields left out) and ``manifest``. With
    ``strict`` an invalid document fails the build, otherwise such documents
    are written to ``rejected`` and to no other part."""
    tables = read_sources(spark, source, names)
    decisions = stage(C.plot_decisions(tables["movies"], tables["plots"], min_words), "decisions")
    kids = stage(C.children(tables["reviews"], decisions.where("drop_reason is null")), "children")
    rows = C.parents(tables["movies"], tables["credits"], tables["links"], decisions, kids)
    rows = stage(C.validated(rows, strict), "parents")
    valid = rows.where("size(violations) = 0").drop("violations")
    own = kids.join(valid.select(F.col("source_id").alias("movie_id")), "movie_id", "left_semi")
    paths = {part: f"{target.rstrip('/')}/{part}" for part in ("collection", "search_rows", "manifest", "rejected")}
    C.nested(valid, own, most_reviews).write.mode("overwrite").json(paths["collection"], ignoreNullFields=False)
    FS.write_jsonl(C.search_rows(valid, own), paths["search_rows"])
    FS.write_jsonl(C.manifest(tables, decisions, own, min_words), paths["manifest"])
    if strict:
        del paths["rejected"]
    else:
        FS.write_jsonl(rows.where("size(violations) > 0"), paths["rejected"])
    return paths
