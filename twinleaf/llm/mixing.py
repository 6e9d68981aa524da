"""Mixing sources to target weights by Pfair scheduling.

A source's rows, in hash order, are cut into blocks. Weights become the least whole
numbers in exactly their ratio; they add up to the period. Block k of a source with
c of a period's n slots is released at floor(k * n / c) and due at ceil((k + 1) * n / c);
of the released blocks the one with the earliest deadline goes next. So at every slot
a source is less than one block away from its share by weight.

The windows of a period repeat, and so does its schedule: where a block goes follows from
its number alone. Whenever a source runs out, at whatever slot, a new span begins with the
weights of the rest; there are as many spans as sources with rows. The driver works out a
period of each span, or less of it where the span ends within its first one, and nothing
else on it grows with the rows. The tasks get the spans' first slots and each source's
first block in each span (a quarter of the square of the number of sources in numbers of
4 bytes at the usual sizes), and work out the periods that their own rows fall in.
Sources of weight 0 come when all others are placed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import gcd, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from twinleaf.llm.common import bound_batches

BLOCK = 32
#: Rows of a hash bucket of a source: within one, rows are numbered in one task.
BUCKET_ROWS = 4000


def shares(weights: list[float]) -> list[int]:
    """The least whole numbers in exactly the ratio of the weights, as these are written in decimals."""
    exact = [Fraction(str(w)) for w in weights]
    if any(w < 0 for w in exact):
        raise ValueError("weights can't be negative")
    whole = [int(w * lcm(*(x.denominator for x in exact))) for w in exact]
    common = gcd(*whole) or 1
    return [w // common for w in whole]


def turns(counts: list[int], left: list[int]) -> Iterator[int]:
    """Whose block each slot holds, from the first on: over a period, or until a source has placed as many blocks as it has left."""
    n = sum(counts)
    waiting = [(0, -(-n // c), s, 0) for s, c in enumerate(counts)]  # release, deadline, source, block
    ready: list[tuple[int, int, int]] = []
    heapq.heapify(waiting)
    for slot in range(n):
        while waiting and waiting[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(waiting)[1:])
        _, s, k = heapq.heappop(ready)
        yield s
        if k + 1 == left[s]:
            return
        heapq.heappush(waiting, ((k + 1) * n // counts[s], -(-(k + 2) * n // counts[s]), s, k + 1))


class Span:
    """The slots of one period among sources with these counts in it and these numbers of blocks left, or up to where one runs out."""

    def __init__(self, counts: list[int], left: list[int]):
        g = gcd(*counts)
        self.counts = [c // g for c in counts]
        self.period = sum(self.counts)
        self.left = left
        self.order = np.fromiter(turns(self.counts, left), np.int32)
        self.at = np.argsort(self.order, kind="stable")  # slots of each source's blocks, source after source
        self.ends = np.bincount(self.order, minlength=len(counts)).cumsum()

    def slot(self, s: int, k):
        """The slot of the k-th block (a number or an array) of the s-th source."""
        c = self.counts[s]
        return k // c * self.period + self.at[(int(self.ends[s - 1]) if s else 0) + k % c]

    def end(self) -> tuple[int, np.ndarray]:
        """(number of slots until a source runs out, blocks that each has placed by then)."""
        if len(self.order) < self.period:
            return len(self.order), np.bincount(self.order, minlength=len(self.counts))
        size = min(int(self.slot(s, x - 1)) for s, x in enumerate(self.left)) + 1
        turn, within = divmod(size, self.period)
        return size, turn * np.array(self.counts, np.int64) + np.bincount(self.order[:within], minlength=len(self.counts))


class Plan:
    """Where each source's blocks go, from the sources' row counts and whole-number weights.

    Held are the spans' first slots and each source's first block in each of its spans;
    a span's period is worked out again where it is needed, and a few are remembered.
    """

    def __init__(self, rows: list[int], weights: list[int], block: int):
        self.block, self.weights = block, weights
        self.blocks = [-(-r // block) for r in rows]
        self.starts: list[int] = []
        self.since = [0] * len(rows)  # a source's first span
        firsts: list[list[int]] = [[] for _ in rows]
        done, start, alive, short = [0] * len(rows), 0, [], []
        while True:
            alive = [s for s in alive if done[s] < self.blocks[s]]
            if not alive:
                rest = [s for s, b in enumerate(self.blocks) if done[s] < b]
                alive = [s for s in rest if weights[s]] or rest
                for s in alive:
                    self.since[s] = len(self.starts)
            if not alive:
                break
            span = Span([weights[s] or 1 for s in alive], [self.blocks[s] - done[s] for s in alive])
            size, placed = span.end()
            self.starts.append(start)
            for s, n in zip(alive, placed.tolist(), strict=True):
                firsts[s].append(done[s])
                done[s] += n
                if done[s] == self.blocks[s] and done[s] * block > rows[s]:
                    short.append((start + size - 1, done[s] * block - rows[s]))
            start += size
        self.firsts = [np.array(f, np.int32 if b < 1 << 31 else np.int64) for f, b in zip(firsts, self.blocks, strict=True)]
        self.known: dict[int, tuple[list[int], Span]] = {}
        # a source's last block, in its last span's last slot, may be short: what comes after it moves up
        self.short_at = np.array([x for x, _ in short], np.int64)
        self.short_by = np.concatenate([[0], np.cumsum([y for _, y in short])]).astype(np.int64)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def span(self, i: int) -> tuple[list[int], Span]:
        """The sources of the i-th span, and its period."""
        if i not in self.known:
            if len(self.known) >= 16:
                self.known.clear()
            alive = [s for s, f in enumerate(self.firsts) if self.since[s] <= i < self.since[s] + len(f)]
            self.known[i] = alive, Span([self.weights[s] or 1 for s in alive], [self.blocks[s] - int(self.firsts[s][i - self.since[s]]) for s in alive])
        return self.known[i]

    def slots(self, source: int, k: np.ndarray) -> np.ndarray:
        """The slot of the source's k-th block."""
        which = np.searchsorted(self.firsts[source], k, side="right") - 1
        out = np.empty(len(k), np.int64)
        for i in np.unique(which).tolist():
            number = self.since[source] + i
            alive, span = self.span(number)
            m = which == i
            out[m] = self.starts[number] + span.slot(alive.index(source), k[m] - int(self.firsts[source][i]))
        return out

    def place(self, source: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, position) of a source's rows by their rank in it."""
        slot = self.slots(source, rank // self.block)
        return slot, slot * self.block + rank % self.block - self.short_by[np.searchsorted(self.short_at, slot, side="left")]


def _placed(plan, numbers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, p = numbers.value, plan.value
        for batch in batches:
            i, r = batch.num_columns - 2, batch.num_columns - 1
            source = np.array([of[x] for x in batch.column(i).to_pylist()], np.int64)
            rank = batch.column(r).to_numpy()
            slot, position = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for s in np.unique(source):
                m = source == s
                slot[m], position[m] = p.place(int(s), rank[m])
            yield pa.RecordBatch.from_arrays([*batch.columns[:i], pa.array(rank // p.block), pa.array(slot), pa.array(position)], names=[*batch.schema.names[:i], "_block", "_slot", "_position"])

    return run


def _ordered(df: DataFrame, id_col: str, source_col: str, weights: dict[str, float], block: int) -> DataFrame:
    """df's columns, numbered c0, c1 and so on (whatever their names), with _block, _slot and _position."""
    spark = df.sparkSession
    bound_batches(spark)
    at = {c: f"c{k}" for k, c in enumerate(df.columns)}
    marked = df.toDF(*at.values())
    marked = marked.withColumn("_source", F.coalesce(F.col(at[source_col]).cast("string"), F.lit("\x00"))).withColumn("_hash", F.xxhash64(F.col(at[id_col]).cast("string")))
    rows = sorted(map(tuple, marked.groupBy("_source").count().collect()))  # one row per source
    # a source's rows are numbered by hash bucket, so that one that holds a third of all rows is still many tasks' work
    buckets = 1 << max(0, (max([c for _, c in rows], default=1) // BUCKET_ROWS).bit_length())
    marked = marked.withColumn("_bucket", F.pmod(F.shiftrightunsigned("_hash", 20), F.lit(buckets)).cast("int"))
    counted = marked.groupBy("_source", "_bucket").agg(F.count("*").alias("n"))
    before = counted.select("_source", "_bucket", (F.sum("n").over(Window.partitionBy("_source").orderBy("_bucket")) - F.col("n")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_source", "_bucket").orderBy("_hash", at[id_col], *[at[c] for c in ("text",) if c in at]))
    ranked = marked.withColumn("_n", number).join(before, ["_source", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_n") - 1)
    plan = spark.sparkContext.broadcast(Plan([c for _, c in rows], shares([weights.get(s, 1.0) for s, _ in rows]) if rows else [], block))
    numbers = spark.sparkContext.broadcast({s: k for k, (s, _) in enumerate(rows)})
    ranked = ranked.select(*at.values(), "_source", "_rank")
    schema = StructType([*ranked.schema.fields[:-2], *(StructField(n, LongType()) for n in ("_block", "_slot", "_position"))])
    return ranked.mapInArrow(_placed(plan, numbers), schema)


def mix_positions(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per input row: id, source, block (of its source), slot (of the mix), position (0 to rows - 1).

    weights: target weight by source; a source without one has 1. Every row is placed
    once: when a source has run out, the others share its slots by their weights. A
    null source is a source of its own; rows with equal ids keep any order among
    themselves; other columns are ignored; an empty table gives an empty result.
    """
    out = _ordered(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source")), "id", "source", weights, block)
    return out.select(F.col("c0").alias(id_col), F.col("c1").alias(source_col), F.col("_block").alias("block"), F.col("_slot").alias("slot"), F.col("_position").alias("position"))


def mixed(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """All rows and columns of docs, in mixed order: files and the rows in them follow the positions.

    Weights, null sources and an empty table are as mix_positions has them. Null and
    empty texts, null ids and repeated rows are rows like any other; rows of one id are
    in the order of a column `text`, if there is one. Other columns, of whatever
    names, go along.
    """
    placed = _ordered(docs, id_col, source_col, weights, block)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(parts, "_position").sortWithinPartitions("_position").select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
