"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text's terms are its words (hashed), its byte-class bigrams and trigrams (letters of
either case, digits, blanks and each kind of mark are classes) and terms for repetition:
words equal to the one before, windows and lines met before. Weights are square roots of
term shares times idf; the right singular vectors of the labelled texts' matrix span
the latent space. The labelled vectors are bounded in number (PER_LABEL), broadcast,
and every document's cosine with every one of them is computed in blocks; the
K nearest, of equal ones (to nine digits) those of least id, vote with a power of their
cosine.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches, frugal, raw, steps

#: Labelled texts that take part, of each label (in hash order of the id).
PER_LABEL = 2000
DIMENSIONS, K, POWER, BLOCK = 64, 15, 8, 128
CLASSES, HASHED, WORDS, EXTRA = 24, 1024, 1024, 4
WIDTH = CLASSES**2 + HASHED + WORDS + EXTRA


def _classes() -> np.ndarray:
    table = np.full(256, 1, np.int64)  # other bytes
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!", b"?", b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"()[]{}", b"/\\", b"=+", b"'\"`", b":;", b"-_~^@")):
        for c in chars:
            table[c] = k + 1 if k else 0
    table[128:] = 0  # letters beyond ASCII, mostly
    return table


_CLASS = _classes()


class Features:
    """Term counts of texts; word hashes are kept in a bounded dictionary."""

    def __init__(self, limit: int = 16 << 20):
        self.seen: dict[bytes, int] = {}
        self.held, self.limit = 0, limit  # bytes

    def __call__(self, text: bytes) -> np.ndarray:
        out = np.zeros(WIDTH, np.float32)
        c = _CLASS[np.frombuffer(text, np.uint8)]
        if len(c) > 1:
            two = c[:-1] * CLASSES + c[1:]
            out[: CLASSES**2] = np.bincount(two, minlength=CLASSES**2)
            three = (two[:-1] * CLASSES + c[2:]) * 40503 >> 4 & HASHED - 1
            out[CLASSES**2 : CLASSES**2 + HASHED] = np.bincount(three, minlength=HASHED)
        words = text.lower().split()
        seen = self.seen
        if self.held > self.limit:
            seen.clear()
            self.held = 0
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh3_64_intdigest(w)
            self.held += len(w) + 150
        h = np.array([seen[w] for w in words], np.uint64)
        n = len(h)
        out[-WORDS - EXTRA : -EXTRA] = np.bincount((h % np.uint64(WORDS)).astype(np.int64), minlength=WORDS)
        if n > 1:
            out[-1] = (h[1:] == h[:-1]).sum() * 5
        if n >= 5:
            w = sum((h[j : n - 4 + j] * np.uint64(0x9E3779B97F4A7C15 + 2 * j) for j in range(5)), np.zeros(n - 4, np.uint64))
            out[-2] = (n - 4 - len(np.unique(w))) * 5
        lines = [x for x in text.split(b"\n") if x.strip()]
        out[-3] = (len(lines) - len(set(lines))) * 50
        out[-4] = 1
        return out


class Model:
    """idf, latent axes and labelled vectors."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float):
        self.prior = prior
        self.labels = labels.astype(np.float64)
        self.idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1
        self.axes = _axes(self._weighted(counts)) if len(counts) else np.zeros((WIDTH, DIMENSIONS))
        self.vectors = self.project(counts)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)) * self.idf

    def project(self, counts: np.ndarray) -> np.ndarray:
        x = self._weighted(counts) @ self.axes
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """0 to 1 for each row of counts: the vote of the K nearest labelled vectors."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        k = min(K, len(self.labels))
        # rounded, a cosine does not depend on the other rows of its block; of equal ones the first go before
        sims = np.round(self.project(counts) @ self.vectors.T, 9)
        near = np.argpartition(np.arange(len(self.labels)) * 1e-14 - sims, k - 1, axis=1)[:, :k]
        near.sort(axis=1)
        weights = np.maximum(np.take_along_axis(sims, near, 1), 0) ** POWER
        return np.round((((weights * self.labels[near]).sum(1) + 1e-3 * self.prior) / (weights.sum(1) + 1e-3)).clip(0, 1), 7)


def _axes(x: np.ndarray) -> np.ndarray:
    """The right singular vectors of the greatest singular values, by subspace iteration from a fixed start."""
    y = x @ np.random.Generator(np.random.PCG64(1)).standard_normal((x.shape[1], min(2 * DIMENSIONS, len(x))))
    for _ in range(5):
        y = np.linalg.qr(x @ (x.T @ y))[0]
    axes = np.linalg.svd(y.T @ x, full_matrices=False)[2][:DIMENSIONS].T
    return np.pad(axes, ((0, 0), (0, DIMENSIONS - axes.shape[1])))


@frugal
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in steps(batches, "text"):
        rows = [features(t).astype(np.float32).tobytes() for t in raw(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["id", "counts"])


def _fitted(label_of: dict, prior: float):
    """One model of all rows (id, counts): a task of 2 * PER_LABEL rows at most, so that the driver holds the finished model alone."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((i, c) for b in batches for i, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        rows = list(dict(rows).items())
        counts = np.frombuffer(b"".join(c for _, c in rows), np.float32).reshape(len(rows), WIDTH)
        model = Model(counts, np.array([label_of[i] for i, _ in rows], float), prior)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return run


def _scores(model: Model, texts: list[bytes], features: Features) -> np.ndarray:
    out = [np.empty(0)]
    for b in range(0, len(texts), BLOCK):
        out.append(model.score(np.stack([features(t) for t in texts[b : b + BLOCK]])))
    return np.concatenate(out)


def _scored(model):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(model.value, raw(batch.column(1)), features), pa.float64())], names=["id", "score"])

    return run


def _accepted(model, text_col: str):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in steps(batches, text_col):
            score = _scores(model.value, raw(batch.column(batch.schema.get_field_index(text_col))), features)
            yield batch.filter(pa.array(score >= 0.5))

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id") -> Model:
    """A model from labels of ids whose crc32 mod 3 is not 1: at most PER_LABEL texts of each label, in hash order of the id.

    Labels other than 0 and 1, null ids and ids without a text are ignored; an id
    with both labels counts as 1.
    """
    bound_batches(docs.sparkSession)
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(label_id).isNotNull()).where(F.crc32(F.col(label_id).cast("string")) % 3 != 1)
    usable = usable.groupBy(F.col(label_id).alias("id")).agg(F.max(label_col).alias("label"))
    total, good = usable.agg(F.count("*"), F.sum("label")).first()
    picked = None
    for value in (0, 1):
        some = usable.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(PER_LABEL)
        picked = some if picked is None else picked.unionByName(some)
    label_of = dict(map(tuple, picked.select("id", "label").collect()))  # 2 * PER_LABEL rows at most
    ids = docs.sparkSession.createDataFrame([(i,) for i in label_of], f"id {docs.select(id_col).schema[0].dataType.simpleString()}")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id", "left_semi")
    counted = texts.mapInArrow(_counted, f"id {ids.schema[0].dataType.simpleString()}, counts binary")
    prior = (good or 0) / total if total else 0.5
    made = counted.repartition(1).mapInArrow(_fitted(label_of, prior), "model binary").collect()  # a row, or none where no partition is left
    return pickle.loads(made[0][0]) if made else Model(np.empty((0, WIDTH), np.float32), np.empty(0), prior)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """One row per input row: id, held_out (crc32 of the id as text, mod 3, is 1), score, predicted (1 from 0.5).

    A null or empty text is like no labelled one and gets about the share of good
    labels; without any labels every score is 0.5. Repeated rows and null ids
    (held_out false) give a row each; other columns are ignored; an empty table gives
    an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, label_id))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(_scored(model), f"id {kind}, score double")
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(False))
    return out.select(F.col("id").alias(id_col), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """The rows of docs, all columns, that the classifier predicts to be of label 1.

    Null and empty texts, null ids, repeated rows and an empty table are judged as
    quality_scores has them; columns of whatever names go along. Without any labels
    every row stays.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, label_id))
    return docs.mapInArrow(_accepted(model, text_col), docs.schema)
