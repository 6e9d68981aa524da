"""Document fingerprints: improbable-feature digests.

Every 64-byte window of a text has an entropy; windows are ranked by how rare their
entropy is in the whole corpus. The window of least rank in each run of 64
neighbouring windows gains a point, and windows with at least 16 points are the
text's features; a text of fewer than 256 windows has shorter runs, a quarter of its
windows or less, and needs fewer points, a quarter of the run. Texts of less than 128
bytes have their 16-byte windows as features too, or, below 64 bytes, only these. The
features' hashes go into a chain of 2048-bit Bloom filters, 5 bits each, a new filter
after 160 features. Two digests are compared filter by filter: bits in common beyond
those expected by chance, over the most there could be.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches, frugal, raw, steps

WINDOW, RUN, SHORT = 64, 64, 16
LEVELS = 1024  # entropies are kept as whole numbers, 6 bits of entropy being LEVELS - 1
BITS, HASHES, PER_FILTER = 2048, 5, 160
STEP = 1 << 20
_U = np.uint64

# entropy of a window of counts c: 6 - sum(c * log2 c) / 64; sums are kept exact as whole numbers
_SCALE = 1 << 24
_C = np.arange(1, WINDOW + 1)
_CLOGC = np.concatenate([[0], np.rint(_C * np.log2(_C) * _SCALE)]).astype(np.int64)
_GAIN = np.diff(_CLOGC)  # of one byte more, at c bytes


def entropies(text: np.ndarray) -> np.ndarray:
    """The entropy level of every 64-byte window of a byte array (none if it is shorter)."""
    n = len(text) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.int64)
    before, after = np.zeros(len(text), np.uint8), np.zeros(len(text), np.uint8)
    for d in range(1, WINDOW):
        same = text[d:] == text[:-d]
        before[d:] += same
        after[:-d] += same
    # sliding by one byte: the byte that enters meets `before` equals, the one that leaves left `after` equals
    first = np.bincount(text[:WINDOW], minlength=256)
    change = _GAIN[before[WINDOW:]] - _GAIN[after[: n - 1]]
    # the entering byte counts the leaving one if they are equal: then nothing changes
    # (before[i] looks 63 back, which excludes the leaving byte at i - 64, so both are counts in the 63 bytes between)
    sums = np.concatenate([[_CLOGC[first].sum()], change]).cumsum()
    return ((6 * WINDOW * _SCALE - sums) * (LEVELS - 1) // (6 * WINDOW * _SCALE)).clip(0, LEVELS - 1)


def selected(ranks: np.ndarray) -> np.ndarray:
    """Places of the windows that are the leftmost of least rank in at least a quarter as many runs as a run has windows.

    A run has RUN windows, or the greatest power of two up to a quarter of all windows.
    """
    if not len(ranks):
        return np.empty(0, np.int64)
    run = min(RUN, 1 << max(0, (len(ranks) // 4).bit_length() - 1))
    key = ranks.astype(np.int64) << 32 | np.arange(len(ranks))
    width = 1
    while width < run:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    place = (key & 0xFFFFFFFF).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])  # leftmost minima never go back
    points = np.diff(np.r_[starts, len(place)])
    best = starts[points >= max(1, run // 4)]
    return place[best] if len(best) else place[starts[[int(points.argmax())]]]


_BYTE_WEIGHTS = (np.random.Generator(np.random.PCG64(64)).integers(0, 1 << 63, WINDOW, np.uint64) << _U(1)) | _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def feature_hashes(text: np.ndarray, places: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A 64-bit hash of the window at each place."""
    out = [np.empty(0, np.uint64)]
    for b in range(0, len(places), 4096):
        windows = text[places[b : b + 4096, None] + np.arange(window)]
        out.append(_mix((windows.astype(np.uint64) * _BYTE_WEIGHTS[:window]).sum(axis=1, dtype=np.uint64) + _U(WINDOW - window)))
    return np.concatenate(out)


def digest(hashes: np.ndarray) -> bytes:
    """Chained filters of the features in order, each once; each filter is 256 bytes and the number of its features (2 bytes)."""
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    out = []
    for b in range(0, len(hashes), PER_FILTER):
        part = hashes[b : b + PER_FILTER]
        bits = np.zeros(BITS, np.uint8)
        for k in range(HASHES):
            bits[(part >> _U(11 * k)) & _U(BITS - 1)] = 1
        out.append(np.packbits(bits).tobytes() + len(part).to_bytes(2, "big"))
    return b"".join(out)


def _filters(x: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(x, np.uint8).reshape(-1, BITS // 8 + 2)
    return np.ascontiguousarray(rows[:, :-2]).view(np.uint64), rows[:, -2].astype(np.int64) * 256 + rows[:, -1]


def _overlap(a: np.ndarray, na: np.ndarray, b: np.ndarray) -> float:
    """The mean, over the filters of a by their features, of each one's best normalised overlap with a filter of b."""
    ones_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = weight = 0.0
    for row, n in zip(a, na, strict=True):
        ones = int(np.bitwise_count(row).sum(dtype=np.int64))
        common = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        most = np.minimum(ones, ones_b)
        chance = ones * ones_b / BITS
        floor = chance + 0.3 * (most - chance)  # an overlap below this is what unrelated filters show
        score = ((common - floor) / np.maximum(most - floor, 1e-9)).clip(0, 1)
        total += float(score.max()) * int(n)
        weight += int(n)
    return total / weight


def likeness(x: bytes, y: bytes) -> float:
    """0 to 1, the same both ways: how much of the digest with fewer filters is in the other; of as many, the mean of both ways.

    Equal digests have 1, an empty one has 0 with any other.
    """
    if x == y:
        return 1.0
    if not x or not y:
        return 0.0
    (a, na), (b, nb) = sorted((_filters(x), _filters(y)), key=lambda f: len(f[0]))
    return _overlap(a, na, b) if len(a) < len(b) else (_overlap(a, na, b) + _overlap(b, nb, a)) / 2


class Fingerprinter:
    """Digests of texts under the corpus's entropy ranks (rank 0: the rarest entropy)."""

    def __init__(self, ranks: np.ndarray):
        self.ranks = ranks

    def features(self, text: bytes) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint64)
        data = np.frombuffer(text, np.uint8)
        found = [np.empty(0, np.uint64)]
        if len(text) < SHORT:  # one feature, of the padded text
            found.append(_mix(feature_hashes(np.concatenate([data, np.zeros(SHORT - len(text), np.uint8)]), np.array([0]), SHORT) + _U(len(text))))
        elif len(text) < 2 * WINDOW:
            found.append(feature_hashes(data, np.arange(len(text) - SHORT + 1), SHORT))
        if len(text) >= WINDOW:
            found.append(feature_hashes(data, selected(self.ranks[entropies(data)])))
        return np.concatenate(found)

    def __call__(self, text: bytes) -> bytes:
        return digest(self.features(text))


def shown(x: bytes) -> str:
    return base64.b64encode(x).decode()


@frugal
def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(LEVELS, np.int64)
    for batch in steps(batches, "text", STEP):
        # windows that reach over two texts are left out; one pass over many short texts is much faster than one for each
        texts = raw(batch.column(0))
        data = np.frombuffer(b"".join(texts), np.uint8)
        levels = entropies(data)
        ends = np.cumsum([len(t) for t in texts])
        inside = np.ones(len(levels) + 1, np.int64)
        inside[-1:] = 0
        edge = np.zeros(len(levels) + 1, np.int64)
        for e in ends[:-1]:
            lo, hi = max(0, e - WINDOW + 1), min(e, len(levels))
            if lo < hi:
                edge[lo] += 1
                edge[hi] -= 1
        counts += np.bincount(levels[edge.cumsum()[:-1] == 0], minlength=LEVELS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS, dtype=np.int32)), pa.array(counts)], names=["level", "n"])


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of each entropy level by its frequency over all windows of all texts; levels that never occur come last, ties by level."""
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_histogram, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()  # LEVELS rows
    n = np.zeros(LEVELS, np.int64)
    for level, count in rows:
        n[level] = count
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.lexsort((np.arange(LEVELS), n, n == 0))] = np.arange(LEVELS)
    return ranks


def _compared(ranks):
    """Rows (part, own, id, text) sorted by part and id: each is compared with the one after it; the last of a part (own false) is only that."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter(ranks.value)
        waiting = None  # part, id, text, digest
        for batch in steps(batches, "text", STEP):
            out: list[tuple] = []
            for part, own, i, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                text = text or ""
                mine = None
                if waiting is not None and waiting[0] == part:
                    mine = make(text.encode())
                    out.append(_row(make, *waiting[1:], text, mine))
                waiting = (part, i, text, make(text.encode()) if mine is None else mine) if own else None
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return run


def _row(make: Fingerprinter, i, text: str, mine: bytes, after: str, next_: bytes) -> tuple:
    k = len(text) // 4
    edited = (text[: len(text) - k] + after[:k]).encode()
    changed = make(edited) if k else mine
    return i, len(text), hashlib.sha256(edited).hexdigest(), shown(mine), shown(changed), likeness(mine, changed), likeness(mine, next_)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next row is the one after in the order of id (nulls first), then text; after
    the last comes the first. The edited text has its last floor(n_chars / 4) code
    points replaced by the next text's first as many, or all if it has fewer. A null
    text counts as empty, with an empty fingerprint; a single row is its own next.
    Repeated rows follow each other; other columns are ignored; an empty table gives
    an empty result.

    Rows are dealt by ranges of the id, with bounds from its quantiles (two ranges for
    each shuffle partition, by default); each range also gets the first row of the
    next, so one shuffle of the text does it all.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("i"))
    bound_batches(spark)
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(ids.select(F.percentile_approx("i", [k / parts for k in range(1, parts)], max(10_000, 4 * parts))).first()[0] or [])) if parts > 1 else []
    ranks = spark.sparkContext.broadcast(entropy_ranks(docs, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("i", F.coalesce("id", F.lit(-(1 << 63))))
    edges = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    # the number of bounds below or at the id: a binary search, as the bounds are sorted
    part = F.lit(0)
    if bounds:
        at = F.expr("aggregate(sequence(0, {n}), struct(0 as lo, {size} as hi), (s, k) -> if(s.lo < s.hi, if(get(edges, div2(s)) <= i, struct(div2(s) + 1 as lo, s.hi as hi), struct(s.lo as lo, div2(s) as hi)), s), s -> s.lo)".replace("{n}", str(len(bounds).bit_length() + 1)).replace("{size}", str(len(bounds))).replace("div2(s)", "cast((s.lo + s.hi) div 2 as int)"))
        part = at
    rows = rows.withColumn("edges", edges).withColumn("part", part).drop("edges")
    first = {r[0]: r[1] for r in rows.select("part", "i").groupBy("part").agg(F.min("i")).collect()}  # one row per part
    used = sorted(first)
    before = {first[p]: used[k - 1] for k, p in enumerate(used)}  # the first id of a part also goes to the part before
    if not used:
        spread = rows.withColumn("own", F.lit(True))
    else:
        heads = spark.createDataFrame(list(before.items()), "i long, also int")
        more = rows.join(F.broadcast(heads), "i").select("i", "id", "text", F.col("also").alias("part"), F.lit(False).alias("own"))  # a row per part
        spread = rows.withColumn("own", F.lit(True)).select("i", "id", "text", "part", "own").unionByName(more)
    # own rows first; of several rows with the next part's first id, the first counts: after it nothing waits
    spread = spread.repartition(F.col("part")).sortWithinPartitions("part", F.desc("own"), "i", "text")
    kinds = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return spread.select("part", "own", "id", "text").mapInArrow(_compared(ranks), kinds).withColumnRenamed("id", id_col)
