"""Where intermediate tables go: always a folder that every executor can see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; set to a fresh local folder only where it is unset (tests, one machine)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext.getCheckpointDir()
        if held:
            found = held
        elif spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            found = tempfile.mkdtemp(prefix="twinleaf-")
            spark.sparkContext.setCheckpointDir(found)
            found = spark.sparkContext.getCheckpointDir()
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found.rstrip("/")


#: Paths of the tables made in each open scope.
_scopes: list[list[str]] = []


#: Spark's switch: shuffle files go when the query that made them ends, not when the driver happens to collect its garbage.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, keep: bool = False, free: bool = False) -> DataFrame:
    """Write df into the shared folder and read it back: the lineage ends there and a lost executor costs nothing done before.

    keep: the table outlives the innermost scratch() and belongs to the one around it.
    free: the shuffle files of the writing go when it is done.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true" if free else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE, before)
    if len(_scopes) > keep:
        _scopes[-1 - keep].append(path)
    return spark.read.schema(df.schema).parquet(path)


def large(df: DataFrame) -> DataFrame:
    """df, for a join: a table that grows with the input, so merged and never sent to the driver for a broadcast.

    The planner goes by the size of the compressed files and counts no row that explode()
    adds; what it takes for some MB can be over a GB, and adaptive execution lets a
    broadcast stand once it is planned.
    """
    return df.hint("merge")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are cut inside are deleted at the end: what is still to be read must be written by then, or kept."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def put(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a file of bounded size into the shared folder; returns its address."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(bytearray(data))
    out.close()
    return files.makeQualified(path).toString()


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by cut() once no later plan reads it."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/cut-" in path:
            delete(spark, path)
