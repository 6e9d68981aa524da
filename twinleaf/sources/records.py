"""Records from TSV files or tables, with validation; generic JSON and Parquet readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinleaf.functions.text import trimmed

REQUIRED = ("id", "section", "name")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (of any file system that Spark reads) is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, count) of keys that occur more than once."""
    return df.groupBy(key).count().where("count > 1")


def require_unique(df: DataFrame, key: str = "id") -> DataFrame:
    found = duplicate_keys(df, key).orderBy(key).take(1)
    if found:
        raise ValueError(f"duplicate {key}: {found[0][0]!r}")
    return df


def _has_byte_order_mark(spark: SparkSession, path: str) -> bool:
    """Whether a file begins with one; Spark's own readers skip it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        return False
    stream = fs.open(p)
    try:
        return [stream.read() for _ in range(3)] == [0xEF, 0xBB, 0xBF]
    finally:
        stream.close()


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a UTF-8 TSV file with a header and CSV quoting, all columns as strings, empty fields as "", with their place `pos`.

    A missing file is a FileNotFoundError, missing columns are a ValueError. A byte
    order mark is part of the first column's name. Short rows give empty fields.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"{path}: expected a TSV file with the columns {', '.join(REQUIRED)}")
    df = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, inferSchema=False, encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if _has_byte_order_mark(spark, path):
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0].lstrip("\ufeff"))
    require_columns(df)
    # a multi-line file is one task's work: ids rise in the order of rows
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns]).withColumn("pos", F.monotonically_increasing_id())


def clean_records(df: DataFrame) -> DataFrame:
    """id, section, name trimmed (null: empty), rows without id or name dropped; `pos` is kept if there is one."""
    require_columns(df)
    out = df.select(*[trimmed(F.col(c).cast("string")).alias(c) for c in REQUIRED], *(["pos"] if "pos" in df.columns else []))
    return out.where("id <> '' and name <> ''")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Validated records of a TSV file: columns present, blank rows dropped, ids unique."""
    return require_unique(clean_records(read_tsv(spark, path)))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, or JSON by the path's ending (.json: one document, .jsonl: one a line)."""
    if path.endswith((".json", ".jsonl")):
        return spark.read.json(path, multiLine=path.endswith(".json"))
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, or one JSON object a line with sorted keys for .jsonl; overwrites, makes parents."""
    if path.endswith(".jsonl"):
        df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").parquet(path)
