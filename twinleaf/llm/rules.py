"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule rejects a document whose feature exceeds a cutoff. The cutoffs are chosen
per stratum (by default: language) on labelled documents: of a fixed ladder of
cutoffs, a rule takes the strictest one whose false rejections among the good
documents of the stratum have an exact binomial (Clopper-Pearson) upper bound of at
most `risk`, at a confidence that is corrected for every bound that is looked at
(Bonferroni: delta / (strata * rules * cutoffs)) and with the risk split evenly over
the rules, so that with probability 1 - delta no stratum loses more than `risk` of its
good documents. A stratum with too few labelled documents to give such a bound
gets no cutoff and keeps what passes the base rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinleaf.storage import cut

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Rule features as shares; the ladder of cutoffs of each, strictest first.
LADDER = [0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5]
RULES = ["symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share"]
RISK, DELTA = 0.05, 0.05


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x evaluated once: named as a lambda's variable, it can't be copied into every step of a loop over it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def with_base(df: DataFrame, text: Column) -> DataFrame:
    """Add the base columns, computed once each, to df.

    A repeated window is found by 64-bit hashes; only documents in which some hash
    occurs twice pay for the sort that finds their places.
    """
    df = df.withColumn("_text", F.coalesce(text, F.lit("")))
    trimmed = F.btrim("_text", F.lit(BLANKS))
    df = df.withColumn("_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+")))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    without = F.col("_text")
    for c in SYMBOLS:
        without = F.replace(without, F.lit(c), F.lit(""))
    df = df.withColumn("n_symbols", (F.length("_text") - F.length(without)).cast("long"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    df = df.withColumn("_lines", lines)
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    last = F.greatest(F.col("n_words").cast("int") - WINDOW + 1, F.lit(1))
    windows = let(F.transform("_words", lambda w: F.xxhash64(w)), lambda h: F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    df = df.withColumn("_windows", F.when(F.col("n_words") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_repeats", F.size("_windows") > F.size(F.array_distinct("_windows")))
    # (hash, place) sorted: equal hashes are neighbours; the places of the repeated ones, sorted, cover min(step, WINDOW) words each
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    places = let(F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))), lambda o: F.transform(F.filter(o, lambda x, k: same(F.get(o, k - 1), x) | same(F.get(o, k + 1), x)), lambda x: x["i"]))
    covered = F.aggregate(F.array_sort(places), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), lambda a, p: F.struct((a["n"] + F.least(p - a["last"], F.lit(WINDOW))).alias("n"), p.alias("last")))
    covered = F.when(F.col("_repeats"), covered)
    df = df.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    # further features of the method
    df = df.withColumn("_upper", F.length("_text") - F.length(F.translate("_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")))
    df = df.withColumn("_bangs", F.length("_text") - F.length(F.replace("_text", F.lit("!"), F.lit(""))))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    df = df.withColumns({
        "symbol_share": share(F.col("n_symbols"), F.col("word_chars")),
        "dup_line_share": share(F.col("n_dup_lines"), F.size("_lines")),
        "repeat_share": share(F.col("n_repeat_words"), F.col("n_words")),
        "upper_share": share(F.col("_upper"), F.col("word_chars")),
        "bang_share": share(F.col("_bangs"), F.col("word_chars")),
    })
    return df


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 8; the error is below 1e-11."""
    z = x + 8
    series = (z - 0.5) * F.ln(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    product = F.lit(0.0)
    for k in range(8):
        product = product + F.ln(x + k)
    return series - product


def tail(x: Column, n: Column, p: Column) -> Column:
    """P(Binomial(n, p) <= x), from the term at x downwards (each is the one above it times a ratio); for x below n * p.

    i steps down, a term is at most exp(-i * i / (2 * n * p + i)) of the first: beyond
    10 * sqrt(n * p) + 100 steps all of them together are less than a rounding error.
    """
    top = F.exp(log_gamma(n + 1.0) - log_gamma(x + 1.0) - log_gamma(n - x + 1.0) + x * F.ln(p) + (n - x) * F.ln(1 - p))
    count = F.least(x, 10 * F.sqrt(n * p) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    # k = x - i: the ratio of the term at k - 1 to that at k
    ratio = lambda k: k / (n - k + 1.0) * (1 - p) / p
    step = lambda a, i: F.struct((a["term"] * ratio(x - i)).alias("term"), (a["sum"] + a["term"] * ratio(x - i)).alias("sum"))
    summed = F.aggregate(F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>")), start, step)
    return top * summed["sum"]


def cutoffs(features: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, one column per rule) from good labelled rows with columns stratum and RULES; a null cutoff rejects nothing."""
    counted = features.groupBy("stratum").agg(F.count("*").cast("double").alias("n"), *[F.count_if(F.col(r) > c).cast("double").alias(f"{r}_{k}") for r in RULES for k, c in enumerate(LADDER)])
    counted = counted.withColumn("strata", F.count("*").over(Window.partitionBy(F.lit(0))))  # one row per stratum
    looked_at = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{r}_{k}").alias("x")) for r in RULES for k, c in enumerate(LADDER)]))
    options = counted.select("stratum", "strata", "n", looked_at.alias("o")).select("stratum", "strata", "n", "o.rule", "o.cutoff", "o.x")
    allowed = F.lit(risk / len(RULES))
    # the bound is at most `allowed` just when so few rejections would be this unlikely under it
    options = options.where(F.col("x") < F.col("n") * allowed).withColumn("tail", tail(F.col("x"), F.col("n"), allowed)).where(F.col("tail") <= F.lit(delta) / (F.col("strata") * len(RULES) * len(LADDER)))
    return options.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_id: str = "doc_id", label_col: str = "quality", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and the shares the rules look at.

    kept is false if base_failed or if a rule's share exceeds its stratum's cutoff.
    A null text has no words and fails the base rules; a null stratum is a stratum of
    its own. Labels of 1 mark the good documents that choose the cutoffs; null ids
    and labels of ids that do not occur are ignored, an id labelled twice counts once
    per labelled row set (good if any of its labels is 1). Without good labels, or
    with too few, only the base rules reject. Repeated rows give a row each; columns
    other than the named ones are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("\x00")).alias("stratum"))
    good = labels.where(F.col(label_col) == 1).where(F.col(label_id).isNotNull()).select(F.col(label_id).alias("id")).distinct()
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    # measured once, in numbers: neither the labels' join nor the verdicts need a text
    measured = cut(with_base(docs, F.col("text")).select("id", "stratum", *base, *RULES))
    chosen = cutoffs(measured.where("not base_failed").select("id", "stratum", *RULES).join(good, "id", "left_semi"), risk, delta)
    judged = measured.join(chosen, "stratum", "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    return judged.select(F.col("id").alias(id_col), *base, (~F.col("base_failed") & ~rejected).alias("kept"), *RULES)
