"""Duplicate groups from verdicts, and the report's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.operators.components import connected_components
from twinleaf.operators.exchange import numbered
from twinleaf.sources.exchange import VERDICTS
from twinleaf.storage import large

NO_TYPES, UNKNOWN, DEFAULT_REASON = "∅", "?", "no reason given"


def duplicate_edges(verdicts: DataFrame) -> DataFrame:
    """(a_id, b_id, score, reason) of duplicate verdicts, a_id < b_id; of repeated edges the last by pair_id."""
    found = verdicts.where("verdict = 'duplicate' and a_id <> b_id").select(F.least("a_id", "b_id").alias("a_id"), F.greatest("a_id", "b_id").alias("b_id"), "score", "reason", "pair_id")
    return found.groupBy("a_id", "b_id").agg(F.max_by(F.struct("score", "reason"), "pair_id").alias("e")).select("a_id", "b_id", "e.score", "e.reason")


def duplicate_groups(verdicts: DataFrame, features: DataFrame) -> DataFrame:
    """size, member_ids, transfer_type_sets, pair_edges of each component of duplicate edges.

    Members without a record have no label set but stay members.
    """
    edges = duplicate_edges(verdicts)
    members = connected_components(edges.select("a_id", "b_id"))
    types = members.join(features.select(F.col("id").alias("node"), F.col("transfer_type_set")), "node", "left")
    grouped = types.groupBy("component").agg(F.count("*").alias("size"), F.array_sort(F.collect_list("node")).alias("member_ids"), F.array_sort(F.collect_set("transfer_type_set")).alias("transfer_type_sets"))
    inside = edges.join(members.select(F.col("node").alias("a_id"), "component"), "a_id")
    listed = inside.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("a_id", "b_id", "score", "reason"))).alias("pair_edges"))
    return grouped.join(listed, "component").select("size", "member_ids", "transfer_type_sets", "pair_edges")


def totals(groups: DataFrame) -> DataFrame:
    """group_count, duplicate_pair_count, largest_group; zeros without groups."""
    return groups.agg(F.count("*").alias("group_count"), F.coalesce(F.sum(F.size("pair_edges")), F.lit(0)).alias("duplicate_pair_count"), F.coalesce(F.max("size"), F.lit(0)).alias("largest_group"))


def in_order(groups: DataFrame) -> DataFrame:
    """Groups with number, from 1: larger first, then by members (of which the least tells groups apart)."""
    return numbered(groups, F.desc("size"), F.element_at("member_ids", 1), name="_n").withColumn("number", F.col("_n") + 1).drop("_n")


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    """One row: total_pairs and a count for each verdict, zeros included."""
    return verdicts.agg(F.count("*").alias("total_pairs"), *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in VERDICTS])


def summary(records: DataFrame, verdicts: DataFrame, groups: DataFrame, sections: DataFrame) -> DataFrame:
    """One row: records, pairs by verdict, groups, largest group, sections not settled by the heuristic."""
    one = F.lit(1).alias("_k")
    parts = [records.agg(F.count("*").alias("total_records")), verdict_counts(verdicts), totals(groups), sections.agg(F.count_if(F.col("source") != "heuristic").alias("ambiguous_sections"))]
    out = parts[0].select(one, "*")
    for p in parts[1:]:  # one row each
        out = out.join(p.select(one, "*"), "_k")
    return out.drop("_k")


def pair_table(verdicts: DataFrame, features: DataFrame, verdict: str) -> DataFrame:
    """pair_id, a_id, b_id, score, reason and both ends' names and types of pairs with a verdict; "?" for what is missing, "∅" for no types."""
    shown = F.when(F.size("transfer_type_set") > 0, F.array_join("transfer_type_set", ", ")).otherwise(NO_TYPES)
    ends = features.select("id", "name", "section", shown.alias("types"))
    df = verdicts.where(F.col("verdict") == verdict)
    for e in ("a", "b"):
        df = df.join(large(ends.select(F.col("id").alias(f"{e}_id"), *[F.col(c).alias(f"{e}_{c}") for c in ("name", "section", "types")])), f"{e}_id", "left")
    return df.select("pair_id", "a_id", "b_id", F.format_string("%.3f", "score").alias("score"), F.coalesce("reason", F.lit(DEFAULT_REASON)).alias("reason"), *[F.coalesce(f"{e}_{c}", F.lit(UNKNOWN)).alias(f"{e}_{c}") for e in ("a", "b") for c in ("name", "section", "types")])


def unsettled_sections(sections: DataFrame) -> DataFrame:
    """Sections that the heuristic did not settle."""
    return sections.where("source <> 'heuristic'")


def member_table(groups: DataFrame, features: DataFrame) -> DataFrame:
    """number, id, name, section, types of each member of numbered groups."""
    shown = F.when(F.size("transfer_type_set") > 0, F.array_join("transfer_type_set", ", ")).otherwise(NO_TYPES)
    ends = features.select("id", "name", "section", shown.alias("types"))
    members = groups.select("number", F.explode("member_ids").alias("id"))
    return members.join(ends, "id", "left").select("number", "id", *[F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in ("name", "section", "types")])


def evidence_table(groups: DataFrame) -> DataFrame:
    """number, a_id, b_id, score, reason of each edge of numbered groups."""
    return groups.select("number", F.explode("pair_edges").alias("e")).select("number", "e.a_id", "e.b_id", F.format_string("%.3f", "e.score").alias("score"), F.coalesce("e.reason", F.lit(DEFAULT_REASON)).alias("reason"))
