"""Sections: profile, rule classification, routing, merging with outside labels."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinleaf.config import Config
from twinleaf.functions.lexicon import Lexicon, labels_of, marker_count
from twinleaf.functions.text import Lemmatizer, matching_text, path_segments, with_lemmas


def parse_records(records: DataFrame, config: Config = Config()) -> DataFrame:
    """id, section, section_segments, name (and pos)."""
    rest = ["pos"] if "pos" in records.columns else []
    return records.select("id", "section", path_segments(F.col("section"), config.section_sep).alias("section_segments"), "name", *rest)


def section_profile(parsed: DataFrame, samples: int = 5, order: str = "pos") -> DataFrame:
    """section, segments, count, sample_names: the first names by `order`.

    The samples are numbered by a window that keeps `samples` rows per section before
    the shuffle's end, so a section of any size collects five.
    """
    counts = parsed.groupBy("section").agg(F.first("section_segments").alias("segments"), F.count("*").alias("count"))
    first = parsed.withColumn("_n", F.row_number().over(Window.partitionBy("section").orderBy(order))).where(F.col("_n") <= samples)
    names = first.groupBy("section").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "name"))), lambda x: x["name"]).alias("sample_names"))
    return counts.join(names, "section").select("section", "segments", "count", "sample_names")


def category_of(types: Column, markers: Column) -> tuple[Column, Column]:
    """(category, confidence) from labels found and markers counted."""
    some, marked = F.size(types) > 0, markers > 0
    category = F.when(some & ~marked, "transfer-type").when(~some & marked, "feature").when(some & marked, "mixed").otherwise("unknown")
    confidence = F.when(some & marked, 0.55).when(some | marked, 0.9).otherwise(0.0)
    return category, confidence


def classify_sections(sections: DataFrame, lexicon: Lexicon, lemmatizer: Lemmatizer | None = None) -> DataFrame:
    """Add section_path, category, transfer_types, feature_score, confidence to rows with a section."""
    df = with_lemmas(sections.withColumnRenamed("section", "section_path").withColumn("id", F.col("section_path")), "section_path", "_lemmas", lexicon, lemmatizer)
    df = df.withColumn("_text", matching_text(F.col("_lemmas"))).withColumn("transfer_types", labels_of(F.col("_text"), lexicon)).withColumn("feature_score", marker_count(F.col("_text"), lexicon))
    category, confidence = category_of(F.col("transfer_types"), F.col("feature_score"))
    return df.withColumn("category", category).withColumn("confidence", confidence).drop("_lemmas", "_text", "id")


def route(classified: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(classified, ambiguous)."""
    sure = (F.col("confidence") >= config.confidence) & (F.col("category") != "unknown")
    return classified.where(sure), classified.where(~sure)


def last_labels(labels: DataFrame, key: str = "section_path", order: str = "pos") -> DataFrame:
    """Of several labels of a section, the last."""
    return labels.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")


def merge_labels(classified: DataFrame, ambiguous: DataFrame, labels: DataFrame) -> DataFrame:
    """section_path, category, transfer_types, source (heuristic, llm or fallback), reason.

    Labels of classified sections are ignored; ambiguous ones without a label keep
    their own category, unknown becoming other.
    """
    sure = classified.select("section_path", "category", "transfer_types", F.lit("heuristic").alias("source"), F.lit(None).cast("string").alias("reason"))
    given = last_labels(labels).select("section_path", F.col("category").alias("_c"), F.col("transfer_types").alias("_t"), F.col("reason").alias("_r"))
    joined = ambiguous.select("section_path", "category", "transfer_types").join(given, "section_path", "left")
    found = F.col("_c").isNotNull()
    rest = joined.select(
        "section_path",
        F.when(found, F.col("_c")).when(F.col("category") == "unknown", "other").otherwise(F.col("category")).alias("category"),
        F.when(found, F.col("_t")).otherwise(F.col("transfer_types")).alias("transfer_types"),
        F.when(found, "llm").otherwise("fallback").alias("source"),
        F.when(found, F.col("_r")).alias("reason"),
    )
    return sure.unionByName(rest)


class SectionLabeller(Protocol):
    """Labels ambiguous sections: any of them, each row (section_path, category, transfer_types, confidence, reason, pos)."""

    def __call__(self, ambiguous: DataFrame) -> DataFrame: ...


def rule_labels(ambiguous: DataFrame) -> DataFrame:
    """A stand-in for the outside labeller: mixed stays mixed, labelled sections are transfer-type, others feature."""
    category = F.when(F.col("category") == "mixed", "mixed").when(F.size("transfer_types") > 0, "transfer-type").otherwise("feature")
    return ambiguous.select("section_path", category.alias("category"), "transfer_types", F.lit(0.8).alias("confidence"), F.lit("rule").alias("reason"), F.lit(0).alias("pos"))
