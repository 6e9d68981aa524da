"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step takes at most (a longer text is a step of its own).
STEP_BYTES = 4 << 20
#: Bytes of an Arrow batch between the JVM and Python.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Let an Arrow batch hold 8 MB at most where the session says nothing about it: rows are texts of any length, and a batch is held by the JVM and by Python at once.

    The setting stays in the session, since the plans that need it run later.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def frugal(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """f, giving its free memory back when a task is over: a Python worker waits for the next task, of whatever operator, beside the executor's JVM."""

    @functools.wraps(f)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def quiet_threads() -> None:
    """One thread per Python worker: Spark already runs one worker per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    os.environ.setdefault("OMP_NUM_THREADS", "1")


def raw(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def plain(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Each text; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about `limit` bytes of text, whatever the row count."""
    for batch in batches:
        i = batch.schema.get_field_index(column)
        n = batch.num_rows
        if n and batch.column(i).nbytes <= limit:
            yield batch
            continue
        lengths = pa.compute.binary_length(batch.column(i)).to_pylist()
        begin = held = 0
        for k, x in enumerate(lengths):
            if k > begin and held + (x or 0) > limit:
                yield batch.slice(begin, k - begin)
                begin, held = k, 0
            held += x or 0
        if n > begin:
            yield batch.slice(begin, n - begin)
