"""Pairs to an arbiter in batches, and its verdicts back."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinleaf.config import Config
from twinleaf.storage import cut, large

NO_VERDICT = "no verdict from LLM"
#: Marks of a negative title.
NEGATIVE = ["ошибк", "отмен", "негативн", "превышен", "несуществ", "лимит", "неверн"]
_IN_PARTITION = (1 << 33) - 1


def numbered(df: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """Add a row's place (from 0) in the whole order, without a window over one partition.

    Rows are dealt by ranges and sorted; the table is written, so that the ranges stay
    as they are, and each range then adds the rows of those before it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    before = counts.select("_part", (F.sum("_c").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_c")).alias("_before"))  # a row per range
    return dealt.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(_IN_PARTITION)).drop("_at", "_part", "_before")


def batches(candidates: DataFrame, config: Config = Config()) -> DataFrame:
    """Add batch_id, from 1: batch_size pairs each, in the order of score (falling) and pair_id."""
    out = numbered(candidates, F.desc("score"), F.col("pair_id"), name="_n")
    return out.withColumn("batch_id", (F.floor(F.col("_n") / config.batch_size) + 1).cast("int")).drop("_n")


def hydrated(batched: DataFrame, features: DataFrame) -> DataFrame:
    """(batch_id, pair_id, score, tier, a, b): both ends with id, section, name, transfer_types. A missing end raises when the row is read."""
    side = F.struct("id", "section", "name", F.col("transfer_type_set").alias("transfer_types"))
    ends = features.select(F.col("id").alias("_id"), side.alias("_side"))
    df = batched
    for end in ("a", "b"):
        df = df.join(ends.withColumnRenamed("_id", f"{end}_id").withColumnRenamed("_side", end), f"{end}_id", "left")
        df = df.withColumn(end, F.when(F.col(end).isNull(), F.raise_error(F.concat(F.lit("no record with id "), f"{end}_id"))).otherwise(F.col(end)))
    return df.select("batch_id", "pair_id", "score", "tier", "a", "b")


def manifest(batched: DataFrame) -> DataFrame:
    """batch_id, file, verdict_file, count."""
    name = F.format_string("batch_%04d", "batch_id")
    return batched.groupBy("batch_id").agg(F.count("*").alias("count")).select("batch_id", F.concat(name, F.lit(".json")).alias("file"), F.concat(name, F.lit(".jsonl")).alias("verdict_file"), "count")


def progress(manifest: DataFrame) -> DataFrame:
    """One row: total_batches, total_pairs."""
    return manifest.agg(F.count("*").alias("total_batches"), F.coalesce(F.sum("count"), F.lit(0)).alias("total_pairs"))


def last_verdicts(verdicts: DataFrame) -> DataFrame:
    """Of several verdicts of a pair, the last by batch and line."""
    order = Window.partitionBy("pair_id").orderBy(F.desc("batch_id"), F.desc("line_no"))
    return verdicts.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def merge_verdicts(candidates: DataFrame, verdicts: DataFrame) -> DataFrame:
    """pair_id, verdict, reason, a_id, b_id, score, tier of every candidate; unanswered ones are uncertain."""
    given = last_verdicts(verdicts).select("pair_id", "verdict", "reason", F.lit(True).alias("_given"))
    df = candidates.select("pair_id", "a_id", "b_id", "score", "tier").join(large(given), "pair_id", "left")
    reason = F.when(F.col("_given"), F.col("reason")).otherwise(NO_VERDICT)
    return df.select("pair_id", F.coalesce("verdict", F.lit("uncertain")).alias("verdict"), reason.alias("reason"), "a_id", "b_id", "score", "tier")


def pending_pairs(batched: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Pairs without a verdict."""
    return batched.join(verdicts.select("pair_id").distinct(), "pair_id", "left_anti")


def missing_batches(manifest: DataFrame, answered: DataFrame) -> DataFrame:
    """Rows of the manifest without a verdict file (answered: a table of batch_id)."""
    return manifest.join(answered.select("batch_id").distinct(), "batch_id", "left_anti")


class PairArbiter(Protocol):
    """Judges candidate pairs: any of them, each row (pair_id, verdict, reason, batch_id, line_no)."""

    def __call__(self, candidates: DataFrame, features: DataFrame) -> DataFrame: ...


def rule_verdicts(candidates: DataFrame, features: DataFrame, negative: list[str] | None = None, lower: float = Config.lower) -> DataFrame:
    """A stand-in for the outside arbiter: (pair_id, verdict, reason, batch_id, line_no).

    A negative mark in the name of one end only makes the pair different_functionality;
    else a score from `lower` makes it a duplicate.
    """
    pattern = "(?i)" + "|".join(NEGATIVE if negative is None else negative)
    marked = features.select("id", F.lower("name").rlike(pattern).alias("_m"))
    df = candidates.join(marked.select(F.col("id").alias("a_id"), F.col("_m").alias("_ma")), "a_id").join(marked.select(F.col("id").alias("b_id"), F.col("_m").alias("_mb")), "b_id")
    apart = F.col("_ma") != F.col("_mb")
    verdict = F.when(apart, "different_functionality").when(F.col("score") >= lower, "duplicate").otherwise("different_functionality")
    reason = F.when(apart, "one title is negative").when(F.col("score") >= lower, "titles agree").otherwise("titles differ")
    return df.select("pair_id", verdict.alias("verdict"), reason.alias("reason"), F.lit(1).alias("batch_id"), F.lit(0).cast("bigint").alias("line_no"))
