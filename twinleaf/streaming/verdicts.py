"""Verdict files as a stream: each trigger takes up the new ones and keeps the latest verdict of every pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from twinleaf.operators.exchange import last_verdicts
from twinleaf.sources.exchange import valid_verdicts, verdict_lines


def verdict_stream(spark: SparkSession, directory: str) -> DataFrame:
    """pair_id, verdict, reason, batch_id, line_no of batch_NNNN.jsonl files as they appear."""
    whole = spark.readStream.schema("value string").option("wholetext", True).option("pathGlobFilter", "batch_*.jsonl").format("text").load(directory)
    return valid_verdicts(verdict_lines(whole))


def keep_latest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream's verdicts to a Parquet table, one folder per trigger; latest() reads it. A repeated trigger overwrites its own folder."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/trigger={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str) -> DataFrame:
    return last_verdicts(spark.read.parquet(path))
