"""Helpers the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.session import work_dir
from barlake.sources.sinks import measured

#: A word: a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_OPTION, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000

#: Bytes of text that a numpy pass holds at once, small enough for a core's cache; a single
#: longer text is taken alone.
BLOCK_BYTES = 1 << 18


def ship(spark: SparkSession) -> None:
    """Let the cluster's Python workers import this package; once per application.

    Where the session has no size of Arrow batches of its own, it gets BATCH_ROWS: texts are
    long, and both Spark and Python hold a batch in memory several times.
    """
    if spark.conf.get(BATCH_OPTION, None) is None:
        spark.conf.set(BATCH_OPTION, BATCH_ROWS)
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if package.is_dir() and not any("barlake-code" in name for name in context._python_includes):
        folder = tempfile.mkdtemp(prefix="barlake-code-")  # the driver serves the file while it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/barlake-code-{uuid.uuid4().hex}", "zip", package.parent, package.name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back.

    The lineage ends there, so a lost executor costs no more than the tasks that read the
    files, and what follows sees one and the same result.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_rows(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``staged``, and the number of rows that were written."""
    seen = Observation()
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, measured(seen, "n")["n"]


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows, or all if there are no more: those with the smallest hashes of ``key``.

    The cut follows from the number of rows, so nothing is sorted and the choice depends on
    neither order nor partitions. ``df`` is read twice.
    """
    span = 1 << 30
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(key), F.lit(span)) < span * rows // total)


def per_batch(fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]):
    """A mapInArrow function from one that turns a batch into batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return run


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    column = column.fill_null("")
    wide = column.cast(pa.large_string())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES, rows: int = 512) -> Iterator[tuple[int, int]]:
    """Row ranges (from, to) of at most ``rows`` texts of about ``size`` bytes, at least one text."""
    n, start = len(offsets) - 1, 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), start + rows, n)
        yield start, stop
        start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit of 64-bit values over all output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
