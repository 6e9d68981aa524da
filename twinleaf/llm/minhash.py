"""Near-duplicate detection with b-bit MinHash.

A document is the set of its distinct 5-word shingles. Equal sets are first merged
by a 128-bit digest of the set, so that a group of copies costs one row from then
on. Each remaining set gets 512 one-permutation minima (empty bins borrow from a
bin that a hash of the empty one names), of which the low 8 bits are kept; 8
neighbouring minima make one of 64 bands. Sets that share a band are candidates.
The number of agreeing minima, corrected for the 1/256 of chance agreements,
estimates the similarity; what may reach the threshold is confirmed on full sets.

No bucket is capped and no pairs of a bucket are emitted wholesale:

1. every member of a bucket is compared with the bucket's least member, its hub, on
   packed signatures, and confirmed with the hub that it is most like;
2. components of the confirmed links are found; a hub whose bucket mates are by now in
   one component is finished, since none of their other pairs can change a result;
3. for the rest, members outside the hub's component are compared with all others that
   share a bucket of that hub, in blocks of bounded size, on packed signatures; a pair
   leaves a block only if its estimate may reach the threshold and its ends are in
   different components, and leaves one block only;
4. these, and pairs with further hubs across components, are confirmed too, and
   components of all links give the result.

At similarity 0.85 a pair is missed by all bands with probability (1-0.85^8)^64,
about 1e-9, and by the estimate (slack: 4.7 standard errors) about 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches, frugal, raw, steps
from twinleaf.operators.components import connected_components
from twinleaf.storage import cut, scratch

WORDS = 5
BINS = 512
ROWS = 8  # minima in a band, of 8 bits each: one 64-bit word
BANDS = BINS // ROWS
SLACK = 0.075
BLOCK = 256
SIEVE = 1 << 26  # bits: 8 MB
_U = np.uint64
_MIX = [_U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (xor-shift-multiply)."""
    x = (x ^ (x >> _U(30))) * _MIX[1]
    x = (x ^ (x >> _U(27))) * _MIX[2]
    return x ^ (x >> _U(31))


_WEIGHTS = _mix(np.arange(1, WORDS + 1, dtype=np.uint64) * _MIX[0]) | _U(1)
_SEEDS = _mix(np.arange(1, WORDS + 2, dtype=np.uint64) * _MIX[1])


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text. Word hashes are kept in a dictionary of bounded bytes."""

    def __init__(self, limit: int = 16 << 20):
        self.seen: dict[bytes, int] = {}
        self.held, self.limit = 0, limit

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: only A-Z change, only 0x20 and 0x09-0x0D separate
        if not words:
            return np.empty(0, np.uint64)
        seen = self.seen
        if self.held > self.limit:
            seen.clear()
            self.held = 0
        try:
            h = np.array([seen[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in seen:
                    seen[w] = xxhash.xxh3_64_intdigest(w)
                    self.held += len(w) + 150
            h = np.array([seen[w] for w in words], np.uint64)
        k = min(WORDS, len(h))
        n = len(h) - k + 1
        s = np.full(n, _SEEDS[k], np.uint64)
        for j in range(k):
            s += h[j : j + n] * _WEIGHTS[j]
        return np.unique(_mix(s))


def _borrow_order() -> np.ndarray:
    """Row t: for each empty bin, the bin it asks at its t-th attempt."""
    t = np.arange(4 * BINS, dtype=np.uint64)[:, None] * _MIX[0]
    return (_mix(t + np.arange(BINS, dtype=np.uint64)[None] * _MIX[1]) >> _U(64 - 9)).astype(np.int32)


_ORDER = _borrow_order()


def signature(shingles: np.ndarray) -> np.ndarray:
    """512 bytes: the low 8 bits of one minimum per bin, empty bins filled."""
    out = np.zeros(BINS, np.uint8)
    if not len(shingles):
        return out
    bins = (shingles >> _U(64 - 9)).astype(np.int32)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    filled = np.zeros(BINS, bool)
    filled[bins[first]] = True
    # the bin is the top of the word, so the first word of a bin is its minimum; its bits are mixed again before the low ones are kept
    out[bins[first]] = (_mix(shingles[first]) & _U(255)).astype(np.uint8)
    empty = np.flatnonzero(~filled)
    for asked in _ORDER:
        if not len(empty):
            break
        from_ = asked[empty]
        ok = filled[from_]
        out[empty[ok]] = out[from_[ok]]
        empty = empty[~ok]
    for e in empty:  # some 1e-9 of tiny sets get here: the next filled bin
        out[e] = out[np.flatnonzero(filled)[0]]
    return out


def estimate(mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of one packed signature with many.

    Both are arrays of 64-bit words, eight bit planes of eight words each: minima
    agree where no plane differs, so the zero bits of the OR of all XORs count them.
    """
    x = np.bitwise_xor(others, mine).reshape(len(others), 8, BINS // 64)
    agree = BINS - np.bitwise_count(np.bitwise_or.reduce(x, axis=1)).sum(axis=1, dtype=np.int64)
    return (agree / BINS - 1 / 256) / (1 - 1 / 256)


def planes(sigs: np.ndarray) -> np.ndarray:
    """(n, 512) bytes to (n, 64) words of bit planes."""
    n = len(sigs)
    bits = np.unpackbits(sigs.reshape(n, BINS, 1), axis=2)  # n, bins, 8
    return np.packbits(bits.transpose(0, 2, 1), axis=2).reshape(n, -1).view(np.uint64)


def _described(percent: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in steps(batches, "text"):
            n, digest, sig = [], [], []
            for text in raw(batch.column(1)):
                s = shingler(text)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                # n shingles are most like n + 1 that hold them all: smaller sets than that reach percent with no other and need no signature
                sig.append(signature(s).tobytes() if len(s) and 100 * len(s) >= percent * (len(s) + 1) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["id", "n", "digest", "sig"])

    return run


@frugal
def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shift = (np.arange(BANDS, dtype=np.uint64) + _U(1)) * _MIX[0]
    for batch in batches:
        for b in range(0, batch.num_rows, 4096):
            part = batch.slice(b, 4096)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            sigs = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint64).reshape(len(ids), BANDS)
            key = _mix(sigs + shift)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).ravel()), pa.array(np.tile(np.arange(BANDS, dtype=np.int16), len(ids))), pa.array(np.repeat(ids, BANDS))], names=["bucket", "band", "id"])


def _estimated(threshold: float):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(0, batch.num_rows, 512):
                part = batch.slice(b, 512)
                x, y = (planes(np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(-1, BINS)) for i in (2, 3))
                likeness = estimate(y, x)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(likeness)], names=["a", "b", "likeness"]).filter(pa.array(likeness >= threshold))

    return run


def _blocks(threshold: float):
    """Compare the two blocks of each (hub, x, y) group; the groups arrive sorted and are of bounded size."""

    def pairs(hub: int, x: int, y: int, ids, comp, blk, hubs, bits):
        left, right = np.flatnonzero(blk == x), np.flatnonzero(blk == y)
        for i in left:
            other = right[right > i] if x == y else right
            other = other[comp[other] != comp[i]]
            for j in other[estimate(bits[i], bits[other]) >= threshold] if len(other) else ():
                if min(hubs[i] & hubs[j]) == hub:  # a pair leaves one group only
                    yield min(ids[i], ids[j]), max(ids[i], ids[j])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def close():
            if key is not None and len(held) > 1:
                ids, comp, blk = (np.array([h[k] for h in held]) for k in (0, 1, 2))
                bits = planes(np.frombuffer(b"".join(h[4] for h in held), np.uint8).reshape(-1, BINS))
                out.extend(pairs(*key, ids, comp, blk, [set(h[3]) for h in held], bits))

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
            out.clear()
            return rows

        for batch in batches:
            for hub, x, y, *rest in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if (hub, x, y) != key:
                    close()
                    held.clear()
                    key = (hub, x, y)
                held.append(rest)
                if len(out) > 20_000:
                    yield flush()
        close()
        yield flush()

    return run


def _places(ids: np.ndarray) -> np.ndarray:
    """The two bits of each id in a sieve of SIEVE bits."""
    h = _mix(ids.astype(np.int64).view(np.uint64) ^ _MIX[0])
    return np.stack([h & _U(SIEVE - 1), h >> _U(32) & _U(SIEVE - 1)], axis=1)


@frugal
def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = _places(batch.column(0).to_numpy(zero_copy_only=False)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array((at >> _U(6)).astype(np.int32)), pa.array((_U(1) << (at & _U(63))).view(np.int64))], names=["word", "bits"])


def _sieve(ids: DataFrame):
    """A Bloom filter of the ids, of SIEVE bits whatever their number, broadcast.

    It spares texts that no pair needs a shuffle. One that passes by chance only costs
    time: the joins that follow are exact.
    """
    rows = ids.mapInArrow(_marks, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(SIEVE // 64, np.int64)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return ids.sparkSession.sparkContext.broadcast(words.view(np.uint64))


def _sets(sieve):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            at = _places(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            passes = ((sieve.value[at >> _U(6)] >> (at & _U(63))) & _U(1)).all(axis=1)
            yield from _shingled(batch.filter(pa.array(passes)), shingler)

    return run


def _shingled(whole: pa.RecordBatch, shingler: Shingler) -> Iterator[pa.RecordBatch]:
    for batch in steps([whole], "text"):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingler(t).tobytes() for t in raw(batch.column(1))], pa.binary())], names=["id", "shingles"])


def _confirmed(percent: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    need = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    made = docs.where("id is not null").mapInArrow(_sets(_sieve(need)), "id long, shingles binary")
    sets = cut(made.groupBy("id").agg(F.min("shingles").alias("shingles")))
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(_confirmed(percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Rows whose sets satisfy 100 * intersection >= percent * union are linked;
    component_id is the least id reachable over links, kept is id = component_id.
    percent is at least 80: the bands are made for that.

    Null or empty texts have no shingles and are linked with nothing. Fewer than
    five words make one shingle, the whole sequence. Repeated rows get equal
    results, so an id that occurs twice with one text is kept twice. A row with a
    null id takes part in nothing: component_id is null and kept false. If an id
    occurs with different texts, the least of its sets stands for it in steps 2 to 4. An empty
    table gives an empty result. Other columns are ignored.
    """
    if percent < 80:
        raise ValueError("percent must be at least 80")
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made = cut(docs.mapInArrow(_described(percent), "id long, n long, digest binary, sig binary"))
    classes = made.where("digest is not null and id is not null").groupBy("digest", "n", "sig").agg(F.min("id").alias("rep"))
    reps = cut(classes.select("digest", "rep", "sig"))
    with scratch(docs.sparkSession):
        final = cut(_linked(docs, reps, percent), keep=True)
    least = reps.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = made.select("id", "n", "digest").join(least, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _linked(docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the representatives (digest, rep, sig) that some other is linked with: steps 1 to 4 over docs (id, text)."""
    signed = reps.where("sig is not null").select(F.col("rep").alias("id"), "sig")
    threshold = percent / 100 - SLACK

    members = signed.mapInArrow(_bands, "bucket long, band smallint, id long")
    crowded = members.groupBy("bucket", "band").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1")
    to_hub = cut(members.join(crowded, ["bucket", "band"]).where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())

    def with_sigs(pairs: DataFrame) -> DataFrame:
        return pairs.join(signed.select(F.col("id").alias("a"), F.col("sig").alias("ga")), "a").join(signed.select(F.col("id").alias("b"), F.col("sig").alias("gb")), "b").select("a", "b", "ga", "gb")

    likely = cut(with_sigs(to_hub).mapInArrow(_estimated(threshold), "a long, b long, likeness double"))
    # first each member with the hub that it is most like
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("likeness", -F.col("a"))).alias("a")).select("a", "b")
    comps = cut(connected_components(_confirm(best, docs, percent), "a", "b"))

    def placed(pairs: DataFrame, end: str) -> DataFrame:
        return pairs.join(comps.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))

    # what this has not settled: other hubs, and members with each other
    early = placed(placed(likely.select("a", "b"), "a"), "b").where("ca <> cb").select("a", "b")
    open_ = cut(placed(placed(to_hub, "a"), "b").select(F.col("a").alias("hub"), F.col("b").alias("id"), F.col("cb").alias("comp"), (F.col("ca") != F.col("cb")).alias("rest")))
    sizes = open_.groupBy("hub").agg(F.count_if("rest").alias("n_rest"), F.count_if(~F.col("rest")).alias("n_main"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1 and n_rest > 0")
    sizes = sizes.select("hub", F.ceil(F.col("n_rest") / BLOCK).cast("int").alias("r"), F.ceil(F.col("n_main") / BLOCK).cast("int").alias("m"))
    place = open_.join(sizes, "hub").withColumn("own", F.when(F.col("rest"), F.pmod(F.xxhash64("id"), "r")).otherwise(F.pmod(F.xxhash64("id"), F.greatest("m", F.lit(1)))).cast("int"))
    # blocks 0..m-1 are of the hub's component, m..m+r-1 of the others; a task (x, y) takes x from the others and y from either
    tasks = F.expr("""
        if(rest,
           concat(if(m > 0, transform(sequence(0, greatest(m - 1, 0)), j -> struct(m + own as x, j as y)), array()),
                  transform(sequence(0, r - 1), j -> struct(m + least(own, j) as x, m + greatest(own, j) as y))),
           transform(sequence(0, r - 1), j -> struct(m + j as x, own as y)))""")
    spread = place.select("hub", "id", "comp", F.when(F.col("rest"), F.col("m") + F.col("own")).otherwise(F.col("own")).alias("blk"), F.explode(tasks).alias("t"))
    hubs = open_.groupBy("id").agg(F.collect_list("hub").alias("hubs"))  # one for each band at most
    work = spread.join(signed.join(hubs, "id"), "id").select("hub", "t.x", "t.y", "id", "comp", "blk", "hubs", "sig")
    work = work.repartition("hub", "x", "y").sortWithinPartitions("hub", "x", "y")
    late = cut(work.mapInArrow(_blocks(threshold), "a long, b long").unionByName(early).distinct())
    if late.isEmpty():
        return comps
    # the links so far are kept as stars of their components
    stars = comps.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return connected_components(stars.unionByName(_confirm(late, docs, percent)), "a", "b")
