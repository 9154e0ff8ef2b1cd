"""Derived tables written once to the shared checkpoint folder.

A derived table (for example a saved ranking run that several evaluations
read) is written as Parquet under ``spark.checkpoint.dir`` in a folder whose
name carries a fingerprint of its inputs (path, size and modification time
of every input file) and of the package source. A changed input or changed
code gives a new folder, so a stored table is never stale; an existing complete folder is read instead of recomputed.
Paths go through the Hadoop FileSystem API, so the same code works for a
local folder and for cluster storage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _code_version() -> str:
    """Digest of the package source, so a stored table built by other code
    is never reused."""
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for dirpath, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()


_CODE = _code_version()


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    h = hashlib.sha1(_CODE.encode())
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        for st in fs.listStatus(p):
            h.update(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()};".encode())
    return h.hexdigest()[:16]


def derived(spark: SparkSession, name: str, inputs: Sequence[str],
            build: Callable[[], DataFrame]) -> DataFrame:
    """Read the stored table ``name`` for these inputs, building and writing
    it first when absent."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quarry-derived/{name}-{fingerprint(spark, inputs)}"
    fs, p = _fs(spark, path + "/_SUCCESS")
    if not fs.exists(p):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write an intermediate result once as Parquet under the shared
    checkpoint folder and continue from the written copy (a lineage cut:
    later consumers and retries read the files instead of recomputing the
    producing job). One write job; the read side is a vectorized scan."""
    import uuid

    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/quarry-stage/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
