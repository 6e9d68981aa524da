"""A training-corpus pipeline: quality, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the caller
writes as Parquet and rereads as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinleaf.llm import queries
from twinleaf.llm.bpe import encode
from twinleaf.llm.minhash import near_duplicates
from twinleaf.llm.mixing import mixed
from twinleaf.llm.quality import accepted
from twinleaf.llm.secrets import masked
from twinleaf.storage import cut, delete, scratch, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (labels of `labels.quality`) does not reject; every row is judged by its text alone, a null one as an empty one."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: Similarity, in percent of the union of two documents' shingles, from which one of them goes.
LIKE = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group of near-duplicates (similarity of 0.8 or more); rows without an id or without words are in no group and stay.

    Rows are judged one by one: an id's other text stays if nothing like it does, and of rows with one id and text one stays.
    An empty table stays empty; other columns go along.
    """
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        gone = near_duplicates(docs, percent=LIKE).where("not kept and doc_id is not null").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # ids repeat, with one text or with several: every row is judged by a number of its own, in the order of the ids
    order = ["doc_id", F.sha2("text", 256)]
    rows = docs.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    rows = cut(rows.withColumn("_row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())))
    gone = near_duplicates(rows, id_col="_row", percent=LIKE).where("not kept and _row is not null").select("_row")
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with secrets in its text masked; n_chars follows the text. Null texts, and their n_chars, stay as they are."""
    return masked(docs).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, in the order in which sources reach their target weights; a null source is one of its own."""
    return mixed(docs, queries.TARGET_WEIGHTS)


#: A table of a row for each file is broadcast up to this many.
FILES = 100_000


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip, mix_position: whole texts encoded, and decoded again to compare; the place of each in the mix.

    A place is that of the row in the files that mix() wrote: they are numbered in the
    order of the mix, and so are the rows in each. So neither texts nor ids are shuffled.
    Null texts count as empty; null ids and repeated rows give a row each.
    """
    placed = docs.select("doc_id", "text", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("_part"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_part", "_file").agg(F.count("*").alias("_n"))  # a row for each file
    before = sizes.select("_file", (F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part", "_file")) - F.col("_n")).alias("_before"))
    if len(docs.inputFiles()) <= FILES:
        before = F.broadcast(before)
    coded = encode(placed, queries.tokenizer("byte_bpe_50k.json"), keep=["_file", "_row"])
    return coded.join(before, "_file").select("doc_id", "n_tokens", "ids", "round_trip", (F.col("_before") + F.col("_row")).alias("mix_position"))


STAGES = [("quality_classifier", quality), ("near_dedup", near_dedup), ("secret_scan", secrets), ("mixing", mix), ("bpe_encoding", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table; each result is written to the shared folder and read again. Rows are in the order of the mix.

    Of the shared folder's tables, all but the last stage's are deleted as soon as they are read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    last = None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        if last:
            delete(spark, last)
        last = f"{base}/{name}"
        docs = spark.read.parquet(last)
    return docs.orderBy("mix_position")


#: The classifier, the inferred automata and the schedule have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None
