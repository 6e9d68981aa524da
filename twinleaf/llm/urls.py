"""URL filter: allow and block rules, and gradient-boosted trees for what no rule covers.

The trees are fitted on labelled URLs: a table of them, of which a bounded number takes
part (MAX_LABELLED, those of least hash), or by default a list of common kinds of junk
and ordinary addresses, made by rule (seed_labels). Verdicts of the rules are no labels:
they say what is wanted of some hosts and languages, not what junk looks like.

Features are lexical: lengths, depth, digit ratio, entropy, parameter counts, hyphens,
and log-odds of the host's suffixes, of the path's ending and (the greatest and the
least) of the host's words. A labelled URL's own odds come from the other FOLDS - 1
parts of the labels, so that no URL's label is among its features.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path prefix); the longest that fits decides.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MAX_LABELLED = 20_000
TREES, DEPTH, RATE, BINS, LEAST, FOLDS = 80, 3, 0.15, 32, 8, 5

#: Words that hosts of the labelled list are made of: of advertising, gambling, adult, drug, loan and phishing hosts, and of ordinary ones.
_JUNK_WORDS = """
ad ads adult bet bets betting bonus cash casino cheap click clicks crypto dating deals doubler escort free jackpot
lender loan loans lottery lucky meds payday pharmacy phish pills poker popup porn prize replica sex singles slots spam
sweepstakes track tracker viagra win winner xxx
""".split()
_PLAIN_WORDS = """
archive art atlas blog bike botany chess city climate college council courses docs farm film forum gallery garden
health history journal lab library maps math museum music news open park physics poetry railways recipes school science
society theatre travel university weather wiki
""".split()


def seed_labels() -> list[tuple[str, int]]:
    """Labelled URLs of common kinds (1: block), made by rule.

    Hosts of one or two words of a list, hosts of words that no list has (ordinary), and
    hosts of random letters and digits (junk), with paths and queries of all kinds.
    """
    rng = random.Random(5)
    out = []

    def add(host: str, k: int, label: int) -> None:
        for j, suffix in enumerate(("com", "net", "org", "info")):
            lang, front = ("en", "fr", "de", "es")[(j + k) % 4], ("www.", "", "m.", "blog.")[(j + k // 4) % 4]
            path = rng.choice([f"{rng.randint(1, 9999)}", f"{rng.randint(1, 9999)}.html", f"{rng.randint(1, 9999)}/", f"{rng.randint(1, 9999)}#top", f"{rng.randint(1, 9999)}?page=2&ref=x", f"{rng.randint(1, 9999)}?utm_source=feed"])
            out.append((f"{rng.choice(['http', 'https'])}://{front}{host}.example.{suffix}/{lang}/{path}", label))

    for label, words in ((1, _JUNK_WORDS), (0, _PLAIN_WORDS)):
        for k, word in enumerate(words):
            add(word, k, label)
            add(f"{word}-{words[(k + 7) % len(words)]}", k + 1, label)
            add(f"{word}{rng.randint(1, 99)}", k + 2, label)
    for k in range(120):
        word = "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") + rng.choice(["", "", "n", "s", "th"]) for _ in range(rng.randint(1, 5)))
        add(word if k % 4 else f"{word}-{word[::-1]}", k, 0)
        if k % 3 == 0:
            add("".join(rng.choices("bcdfghjklmnpqrstvwxz0123456789", k=rng.randint(9, 16))), k, 1)
    return out


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path: empty without "://"."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def by_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits; of equal length the one with the longer host."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def split_url(url: str | None) -> tuple[str, str, str, str]:
    """Host, path, query and fragment, as parts() has them."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", "", ""
    rest, _, fragment = rest.partition("#")
    rest, _, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path, query, fragment


def _host_words(url: str | None) -> set[str]:
    """The runs of letters of the host, but for its last two labels."""
    return set(re.findall("[a-z]+", ".".join(split_url(url)[0].split(".")[:-2])))


def _endings(url: str | None) -> tuple[str, str, str, str]:
    host, path, _, _ = split_url(url)
    labels, segments = host.split("."), [x for x in path.split("/") if x]
    return labels[-1], ".".join(labels[-2:]), segments[0] if segments else "", path.rpartition(".")[2] if "." in path.rpartition("/")[2] else "/" * path.endswith("/")


def lexical(url: str | None, odds: list[dict[str, float]]) -> list[float]:
    host, path, query, fragment = split_url(url)
    whole = url or ""
    n = max(1, len(whole))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(whole).values())
    labels = host.split(".")
    digits = sum(c.isdigit() for c in whole)
    words = [odds[-1].get(w, 0.0) for w in _host_words(url)]
    return [
        len(whole), len(host), len(path), len(query), path.count("/"), len(labels), max(map(len, labels)), host.count("-"), path.count("-"),
        digits / n, sum(c.isdigit() for c in host) / max(1, len(host)), entropy, query.count("=") + (query != "" and "=" not in query), len(fragment), whole.startswith("https:"),
        *(o.get(e, 0.0) for o, e in zip(odds, _endings(url))), max(words, default=0.0), min(words, default=0.0),
    ]


class Trees:
    """Gradient boosting with logistic loss over binned features; small, deterministic, no dependence but numpy."""

    def __init__(self, urls: list[str | None], y: np.ndarray):
        seen: list[dict[str, np.ndarray]] = [defaultdict(lambda: np.zeros((FOLDS, 2))) for _ in range(5)]
        folds = [zlib.crc32((u or "").encode()) % FOLDS for u in urls]  # copies are in one fold
        for u, label, fold in zip(urls, y, folds, strict=True):
            for counts, e in zip(seen, _endings(u)):
                counts[e][fold, int(label)] += 1
            for w in _host_words(u):
                seen[-1][w][fold, int(label)] += 1
        self.odds = [self._odds({e: c.sum(axis=0) for e, c in counts.items()}) for counts in seen]
        self.edges, self.base, self.trees = [], -math.inf, []
        if not len(urls):  # nothing is known: nothing is blocked
            return
        others = [[self._odds({e: c.sum(axis=0) - c[f] for e, c in counts.items()}) for counts in seen] for f in range(FOLDS)]
        x = np.array([lexical(u, others[f]) for u, f in zip(urls, folds, strict=True)], float).reshape(len(urls), -1)
        self.edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
        binned = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(self.edges, x.T, strict=True)], axis=1)
        rate = min(max(y.mean(), 0.01), 0.99)
        self.base = math.log(rate / (1 - rate))
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, p - y, p * (1 - p), np.arange(len(y)), DEPTH)
            self.trees.append(tree)
            score += self._walk(tree, binned)

    @staticmethod
    def _odds(counts: dict[str, np.ndarray]) -> dict[str, float]:
        """Log-odds of being blocked of each ending with LEAST labelled URLs or more, one of either label added."""
        return {e: math.log((c[1] + 1) / (c[0] + 1)) for e, c in counts.items() if c.sum() >= LEAST}

    def features(self, urls: list[str | None]) -> np.ndarray:
        return np.array([lexical(u, self.odds) for u in urls], float).reshape(len(urls), -1)

    def _grow(self, x, g, h, rows, depth):
        gs, hs = g[rows].sum(), h[rows].sum()
        leaf = -RATE * gs / (hs + 1.0)
        if not depth or len(rows) < 2 * LEAST:
            return leaf
        best = (1e-6, None, None)
        for k in range(x.shape[1]):
            b = x[rows, k]
            n = len(self.edges[k]) + 1
            if n < 2:
                continue
            gl, hl, c = (np.cumsum(np.bincount(b, w, n))[:-1] for w in (g[rows], h[rows], None))
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            gain[(c < LEAST) | (len(rows) - c < LEAST)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], k, at)
        _, k, at = best
        if k is None:
            return leaf
        low = x[rows, k] <= at
        return k, at, self._grow(x, g, h, rows[low], depth - 1), self._grow(x, g, h, rows[~low], depth - 1)

    def _walk(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        k, at, left, right = tree
        return np.where(x[:, k] <= at, self._walk(left, x), self._walk(right, x))

    def score(self, urls: list[str | None]) -> np.ndarray:
        """Probability that each URL is to be blocked."""
        if not self.trees:
            return np.zeros(len(urls))
        x = self.features(urls)
        binned = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(self.edges, x.T, strict=True)], axis=1)
        return 1 / (1 + np.exp(-(self.base + sum(self._walk(t, binned) for t in self.trees))))


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            for b in range(0, batch.num_rows, 4096):
                part = batch.slice(b, 4096)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(trees.score(part.column(1).to_pylist()), pa.float64())], names=["id", "url", "block_score"])

    return run


def fit(labelled: DataFrame | list[tuple[str, int]]) -> Trees:
    """Trees from labelled URLs: a list, or a table of url and label (1: block), of whose distinct rows the MAX_LABELLED of least hash take part.

    An estimate of the number of distinct ones gives a bound of the hash below which
    somewhat more than MAX_LABELLED are expected: only these are shuffled and sent to
    the driver, however many there are. Null URLs and other labels are ignored.
    """
    if isinstance(labelled, DataFrame):
        given = labelled.select("url", F.col("label").cast("int").alias("label"), F.xxhash64("url").alias("hash")).where("url is not null and label in (0, 1)")
        bound = 1.1 * MAX_LABELLED / max(given.agg(F.approx_count_distinct("hash", 0.01)).first()[0], 1)
        if bound < 1:
            given = given.where(F.col("hash") < int((bound - 0.5) * 2**64))
        labelled = [r[1:] for r in sorted((r.hash, r.url, r.label) for r in given.distinct().collect())[:MAX_LABELLED]]
    return Trees([u for u, _ in labelled], np.array([y for _, y in labelled], float))


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] | None = None, labelled: DataFrame | list[tuple[str, int]] | None = None) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict (allow or block), block_score.

    A rule fits its host and all subdomains if the path starts with the rule's. Where
    none fits, the trees decide: block from a score of 0.5. A null URL, or one without
    "://", has an empty host and path, fits no rule and is judged by the trees as it
    is. Repeated rows and null ids give a row each; other columns are ignored; an
    empty table gives an empty result. labelled: see fit(); without any label the trees
    allow everything.
    """
    bound_batches(pages.sparkSession)
    rules = RULES if rules is None else rules
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    model = pages.sparkSession.sparkContext.broadcast(fit(seed_labels() if labelled is None else labelled))
    kind = urls.schema["id"].dataType.simpleString()
    host, path = parts(F.col("url"))
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    out = urls.mapInArrow(_scored(model), f"id {kind}, url string, block_score double").select("id", host.alias("host"), path.alias("path"), "block_score")
    return out.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "block_score")
