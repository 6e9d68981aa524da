"""Connected components of an edge table, by alternating star contraction.

Each round is two aggregations and two joins over the edges alone; labels never
reach the driver. A node with very many neighbours is aggregated map-side, and
the join back to its neighbours is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.storage import cut, remove


def _hang(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Hang the neighbours of every node under the least of them.

    both_ways: a node's larger neighbours move to its least neighbour (or itself);
    otherwise the node and its smaller neighbours move to the least of these.
    """
    if both_ways:
        seen = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        seen = seen.select(F.col("high").alias("node"), F.col("low").alias("other"))
        least = seen.groupBy("node").agg(F.min("other").alias("least"))
        moved = seen.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.least("least", "node").alias("low"))
    else:
        seen = edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
        least = seen.groupBy("node").agg(F.min("other").alias("least"))
        moved = seen.join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low")).unionByName(least.select(F.col("node").alias("high"), F.col("least").alias("low")))
    return moved.where("high > low").distinct()


def connected_components(edges: DataFrame, a: str = "a_id", b: str = "b_id", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the least node reachable.

    Self-loops, repeated edges and edges with a null end are ignored: a node that
    only has those does not appear. An empty table gives an empty result.
    """
    kind = edges.schema[a].dataType
    stars = cut(edges.select(F.greatest(a, b).alias("high"), F.least(F.col(a), F.col(b)).alias("low")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    mark = None
    for _ in range(max_rounds):
        old, stars = stars, cut(_hang(_hang(stars, True), False))
        remove(edges.sparkSession, old)
        seen = stars.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = stars.select(F.col("low").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots).select(F.col("node").cast(kind), F.col("component").cast(kind))
