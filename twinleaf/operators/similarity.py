"""Block-local TF-IDF cosine by an inverted index: only pairs that share a term are ever formed.

With a threshold, a block's records are dealt into chunks, each two chunks are compared
at once in hashed vectors, whose products are never less than the cosine (likely_pairs),
and a pair's cosine is then taken from its two whole vectors.

Where every pair is asked for, each two chunks are multiplied through an inverted index in
one task, which holds a bounded number of products at once and hands on whole cosines
(every_cosine): nothing is shuffled for a pair.

Records may stand for several of the same text (a column n): these count in the block's
size and in the frequencies of their terms, but have one vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinleaf.storage import cut, large

#: Width of hashed vectors, records of a dense piece, and what a chunk's number of records is measured by (its square root).
BUCKETS, PIECE, CHUNKS = 2048, 1024, 48
#: Of every_cosine: what a chunk is measured by, ids of a row on average; cells, products and rows that a task holds at once.
WHOLE, COPIES, CELLS, PRODUCTS, ROWS = 24, 64, 1 << 20, 1 << 20, 1 << 17


def _unscaled(items: DataFrame, grams: Column) -> DataFrame:
    """(block, id, term, w, df) of items (block, id, ...): sublinear term frequency times smoothed idf of the block, whose size counts all its items."""
    n = F.col("n") if "n" in items.columns else F.lit(1).cast("bigint")
    sizes = items.groupBy("block").agg(F.sum(n).alias("n"))
    tf = items.select("block", "id", n.alias("n"), F.explode(grams).alias("term")).groupBy("block", "id", "term").agg((1 + F.ln(F.count("*"))).alias("tf"), F.first("n").alias("n"))
    df = tf.groupBy("block", "term").agg(F.sum("n").alias("df"))
    return tf.drop("n").join(large(df), ["block", "term"]).join(sizes, "block").select("block", "id", "term", (F.col("tf") * (F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"), "df")


def weights(items: DataFrame, grams: Column) -> DataFrame:
    """(block, id, term, w, df): vectors of unit length, a row for each term. Items without terms count in their block's size."""
    # a term of one record weighs in its norm, so rare terms stay until the norm is known
    w = _unscaled(items, grams)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("block", "id")))
    return w.select("block", "id", "term", (F.col("w") / norm).alias("w"), "df")


def vectors(items: DataFrame, grams: Column) -> DataFrame:
    """(block, id, terms): the same, a row for each record; terms are (df, term, w), in no order."""
    listed = _unscaled(items, grams).groupBy("block", "id").agg(F.collect_list(F.struct("df", "term", "w")).alias("terms"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return listed.select("block", "id", F.transform("terms", lambda x: F.struct(x["df"].alias("df"), x["term"].alias("term"), (x["w"] / F.col("norm")).alias("w"))).alias("terms"))


def cosine_pairs(weighted: DataFrame, name: str = "sim") -> DataFrame:
    """(block, a_id, b_id, name) for pairs a_id < b_id of a block that share a term; terms of one record are left out before the join."""
    shared = weighted.where("df > 1")
    a = shared.select("block", "term", F.col("id").alias("a_id"), F.col("w").alias("wa"))
    b = shared.select("block", "term", F.col("id").alias("b_id"), F.col("w").alias("wb"))
    return a.join(b, ["block", "term"]).where("a_id < b_id").groupBy("block", "a_id", "b_id").agg(F.sum(F.col("wa") * F.col("wb")).alias(name))


def _dense(rows: np.ndarray, buckets: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """n vectors of BUCKETS numbers."""
    return np.bincount(rows.astype(np.int64) * BUCKETS + buckets, weights, n * BUCKETS).astype(np.float32).reshape(n, BUCKETS)


class _Pieces:
    """Hashed vectors of a chunk, dense for PIECE records at once."""

    def __init__(self, part: pa.Table):
        self.n = part.num_rows
        lists = part["buckets"].combine_chunks()
        self.ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        self.buckets = lists.flatten().to_numpy()
        self.weights = part["ws"].combine_chunks().flatten().to_numpy()

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        for begin in range(0, self.n, PIECE):
            ends = self.ends[begin : begin + PIECE + 1]
            of = slice(ends[0], ends[-1])
            yield begin, _dense(np.repeat(np.arange(len(ends) - 1), np.diff(ends)), self.buckets[of], self.weights[of], len(ends) - 1)


def _near(least: float):
    def run(group: pa.Table) -> pa.Table:
        lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
        one, other = (group.filter(pa.compute.equal(group["chunk"], c)) for c in (lo, hi))
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, x in _Pieces(one):
            for j, y in _Pieces(other):
                if lo == hi and j < i:
                    continue
                at, to = np.nonzero(x @ y.T >= least)
                new = (at + i < to + j) if lo == hi else slice(None)
                a.append(at[new] + i)
                b.append(to[new] + j)
        ids = [t["id"].combine_chunks().take(pa.array(np.concatenate(k))) for t, k in ((one, a), (other, b))]
        block = group["block"].combine_chunks().take(pa.array(np.zeros(len(ids[0]), np.int64)))
        return pa.Table.from_arrays([block, *ids], names=["block", "_a", "_b"])

    return run


def chunked(rows: DataFrame, length: int = CHUNKS, spread: int = 1) -> DataFrame:
    """Add chunk, lo, hi: rows (block, id, ...) dealt into chunks of their block, a copy for each two chunks lo <= hi of which theirs is one.

    The number of a block's chunks grows with the square root of its rows (of their
    column n, if there is one), and so do their length and the copies. spread: so many
    times the session's number of partitions.
    """
    n = F.sum("n") if "n" in rows.columns else F.count("*")
    sizes = rows.groupBy("block").agg(F.ceil(F.sqrt(n) / length).alias("_m"))
    dealt = rows.join(sizes, "block").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("_m")))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m") - 1)))
    dealt = dealt.withColumn("lo", F.least("chunk", "_o")).withColumn("hi", F.greatest("chunk", "_o")).drop("_m", "_o")
    return dealt.repartition(spread * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block", "lo", "hi")


def likely_pairs(found: DataFrame, least: float) -> DataFrame:
    """(block, a_id, b_id) of all pairs a_id < b_id of vectors() with cosine `least` or more, and some others.

    Terms are hashed into BUCKETS numbers. Weights are positive, so terms that meet in
    one only add to a product: it is the cosine or more, and no pair is missed. What a
    task holds grows with the square root of its block, and no pair is shuffled that is
    not likely.
    """
    shared = F.filter("terms", lambda x: x["df"] > 1)
    bucket = F.transform(shared, lambda x: F.pmod(F.xxhash64(x["term"]), F.lit(BUCKETS)).cast("int"))
    rows = found.select("block", "id", bucket.alias("buckets"), F.transform(shared, lambda x: x["w"].cast("float")).alias("ws")).where(F.size("buckets") > 0)
    kind = found.select("block", F.col("id").alias("_a"), F.col("id").alias("_b")).schema
    near = chunked(rows).groupBy("block", "lo", "hi").applyInArrow(_near(least - 1e-4), kind)  # products are of single precision
    return near.select("block", F.least("_a", "_b").alias("a_id"), F.greatest("_a", "_b").alias("b_id"))


def _shared_out(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of counts that add up to `most` or less; a count above that has a slice of its own."""
    ends, begin = np.cumsum(counts), 0
    while begin < len(counts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, "right")))
        yield slice(begin, end)
        begin = end


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... counts[0] - 1, 0, 1, ... counts[1] - 1 and so on."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of two chunks (or one with itself): the ids and the cosine of each pair that shares a term."""
    group = pa.Table.from_batches(list(batches)).sort_by("chunk")  # lo comes first
    within = group["lo"][0] == group["hi"][0]
    n = group.num_rows
    n_one = n if within else pa.compute.sum(pa.compute.equal(group["chunk"], group["lo"][0])).as_py()
    first = 0 if within else n_one  # of the other chunk
    n_other = n - first
    if not n_one or not n_other:
        return
    ids = pa.concat_arrays([c.flatten() for c in group["ids"].chunks])
    order = pa.compute.sort_indices(ids)
    ids, rank = ids.take(order), np.empty(len(ids), np.int64)
    rank[order.to_numpy()] = np.arange(len(ids))
    sizes = pa.compute.list_value_length(group["ids"]).to_numpy().astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    terms = pa.chunked_array([c.flatten() for c in group["terms"].chunks]).dictionary_encode().unify_dictionaries()
    codes = np.concatenate([c.indices.to_numpy() for c in terms.chunks])
    ws = np.concatenate([c.flatten().to_numpy() for c in group["ws"].chunks])
    lengths = pa.compute.list_value_length(group["terms"]).to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    # the other chunk's records and weights by term
    held = slice(ends[first], None)
    by_term = np.argsort(codes[held], kind="stable")
    record, weight = np.repeat(np.arange(n_other), lengths[first:])[by_term], ws[held][by_term]
    count = np.bincount(codes[held], minlength=codes.max() + 1)
    start = np.cumsum(count) - count
    for begin in range(0, n_one, step := max(1, CELLS // n_other)):
        end = min(begin + step, n_one)
        of = slice(ends[begin], ends[end])
        row, code, w = np.repeat(np.arange(end - begin) * n_other, lengths[begin:end]), codes[of], ws[of]
        sums = np.zeros((end - begin) * n_other)
        for part in _shared_out(count[code], PRODUCTS):
            k = count[code[part]]
            at = np.repeat(start[code[part]], k) + _spread(k)
            sums += np.bincount(np.repeat(row[part], k) + record[at], np.repeat(w[part], k) * weight[at], len(sums))
        cell = np.flatnonzero(sums)  # weights are positive
        i, j = cell // n_other + begin, cell % n_other + first
        if within:
            cell, i, j = (x[j >= i] for x in (cell, i, j))
        for part in _shared_out(sizes[i] * sizes[j], ROWS):
            x, y, sim = i[part], j[part], sums[cell[part]]
            k = sizes[x] * sizes[y]
            place, wide = _spread(k), np.repeat(sizes[y], k)
            a = rank[np.repeat(begins[x], k) + place // wide]
            b = rank[np.repeat(begins[y], k) + place % wide]
            new = np.repeat(x != y, k) | (a < b)  # a row's own ids: each pair once
            a, b, sim = a[new], b[new], np.repeat(sim, k)[new]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.minimum(a, b))), ids.take(pa.array(np.maximum(a, b))), pa.array(sim)], names=["a_id", "b_id", "sim"])


def every_cosine(items: DataFrame, grams: Column) -> DataFrame:
    """(a_id, b_id, sim): the pairs of cosine_pairs(weights(items, grams)), for grams of the column text, in tables that they do not fit.

    Equal texts have one vector, in rows of some of their ids. What is written and
    shuffled grows with the rows and the square root of their block; the pairs are as many
    as they are, and go straight to what reads them.
    """
    own = items.groupBy("block", "id").agg(F.array_sort(F.collect_list("text")).alias("texts"))  # of an id that is there twice the terms count together
    alike = own.groupBy("block", "texts").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    found = vectors(alike.select("block", F.col("rep").alias("id"), "n", F.explode("texts").alias("text")), grams)
    shared = found.select("block", F.col("id").alias("rep"), F.filter("terms", lambda x: x["df"] > 1).alias("terms")).where(F.size("terms") > 0)
    some = own.join(alike, ["block", "texts"]).groupBy("block", "rep", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / COPIES)).alias("_k")).agg(F.min("id").alias("id"), F.collect_list("id").alias("ids"), F.count("*").alias("n"))
    rows = cut(some.join(shared, ["block", "rep"]).select("block", "id", "ids", "n", F.col("terms.term").alias("terms"), F.col("terms.w").alias("ws")))
    kind = items.select(F.col("id").alias("a_id"), F.col("id").alias("b_id"), F.lit(0.0).alias("sim")).schema
    return chunked(rows, WHOLE, 4).drop("id", "n").groupBy("block", "lo", "hi").applyInArrow(_every, kind)


def shared_terms(terms: Column) -> Column:
    """The terms that another record has too, with their weights, as a map."""
    return F.map_from_entries(F.transform(F.filter(terms, lambda x: x["df"] > 1), lambda x: F.struct(x["term"].alias("term"), x["w"].alias("w"))))


def dot(a: Column, b: Column) -> Column:
    """The product of two vectors; 0 if either is null."""
    both = F.map_values(F.map_zip_with(a, b, lambda _, x, y: x * y))
    return F.coalesce(F.aggregate(both, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))), F.lit(0.0))


def cosines_of(pairs: DataFrame, records: DataFrame, names: list[str]) -> DataFrame:
    """The given pairs (block, a_id, b_id) with their cosines in each of the named vectors of `records` (block, id, vectors).

    A pair takes one row through the plan, whatever the length of its vectors.
    """
    for end in ("a", "b"):
        ends = records.select("block", F.col("id").alias(f"{end}_id"), *[F.col(n).alias(f"_{end}_{n}") for n in names])
        pairs = pairs.join(large(ends), ["block", f"{end}_id"], "left")
    return pairs.select("block", "a_id", "b_id", *[dot(F.col(f"_a_{n}"), F.col(f"_b_{n}")).alias(n) for n in names])


def block_pairs(items: DataFrame) -> DataFrame:
    """(block, a_id, b_id) of all pairs of a block; only for a threshold of 0, where pairs without a shared term count too."""
    a, b = items.select("block", F.col("id").alias("a_id")), items.select("block", F.col("id").alias("b_id"))
    return a.join(b, "block").where("a_id < b_id")
