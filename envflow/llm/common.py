"""Shared helpers: table access, scratch tables, input tidying."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow.session import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_SHIPPED: set[str] = set()


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, once Python workers of its application can import this package.

    The package's sources (a few files) go to the workers by ``addPyFile``, which
    serves them from the driver; nothing has to be installed on the executors.
    """
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        tmp = tempfile.mkdtemp(prefix="sources-")
        atexit.register(shutil.rmtree, tmp, ignore_errors=True)  # Spark serves the file until the driver ends
        name = f"{tmp}/{os.path.basename(root)}.zip"
        with zipfile.ZipFile(name, "w") as z:
            for d, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        z.write(f"{d}/{f}", os.path.relpath(f"{d}/{f}", os.path.dirname(root)))
        sc.addPyFile(name)
        _SHIPPED.add(sc.applicationId)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it back.

    Cuts lineage: what follows does not recompute ``df`` when an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text"):
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def sized(n: int, per: int, least: int = 1) -> int:
    """How many parts of about ``per`` rows hold ``n`` rows."""
    return max(least, -(-int(n) // int(per)))


def runs(batches, keys: int):
    """Slices of Arrow batches that are sorted by their first ``keys`` columns (numbers without nulls), as
    ``(new, slice)``: ``new`` is false where a slice goes on with the run of the one before."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        cut = np.zeros(b.num_rows - 1, dtype=bool)
        for c in cols:
            cut |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(cut) + 1).tolist(), b.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:]):
            key = tuple(c[lo] for c in cols)
            yield key != last, b.slice(lo, hi - lo)
            last = key


def whole_runs(batches, keys: int):
    """The runs of such batches, each as one table; for runs of bounded size."""
    import pyarrow as pa

    held = []
    for new, part in runs(batches, keys):
        if new and held:
            yield pa.Table.from_batches(held)
            held = []
        held.append(part)
    if held:
        yield pa.Table.from_batches(held)
