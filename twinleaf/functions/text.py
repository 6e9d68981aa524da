"""Text functions over columns: trimming, paths, tokens, lemmas, normalised text."""

from __future__ import annotations

import hashlib
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinleaf.functions.lexicon import Lexicon, fold_yo

#: What a trim removes: Unicode white space and the separators U+001C to U+001F.
BLANK = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"
TOKEN = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"
#: Tokens that are all digits, superscripts and subscripts included (but no fractions).
DIGITS = r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉]+$"


def trimmed(x: Column) -> Column:
    """Null counts as empty; white space goes from both ends."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), f"^{BLANK}+", ""), f"{BLANK}+$", "")


def path_segments(section: Column, sep: str) -> Column:
    """Parts between literal separators, trimmed, without empty ones."""
    literal = "".join(c if c.isalnum() or c == " " else "\\" + c for c in sep)
    return F.filter(F.transform(F.split(F.coalesce(section, F.lit("")), literal), trimmed), lambda x: x != "")


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits with inner hyphens, in order."""
    return F.regexp_extract_all(fold_yo(F.lower(F.coalesce(text, F.lit("")))), F.lit(TOKEN), F.lit(0))


def _kept(words: Column, lexicon: Lexicon) -> Column:
    stop = F.array(*map(F.lit, sorted(lexicon.stopwords))) if lexicon.stopwords else F.array().cast("array<string>")
    return F.filter(words, lambda x: ~F.array_contains(stop, x) & (F.length(x) >= 2))


def content_tokens(text: Column, lexicon: Lexicon) -> Column:
    """Tokens without stopwords, numbers and single characters."""
    return F.filter(_kept(tokens(text), lexicon), lambda x: ~F.rlike(x, F.lit(DIGITS)))


class Lemmatizer(Protocol):
    """Maps tokens to lemmas; context-free, identity for what it does not know."""

    def apply(self, df: DataFrame, column: str) -> DataFrame:
        """df with the array column's tokens replaced by their lemmas, order and repeats kept."""


    def digest(self) -> str:
        """Of what the lemmas depend on; part of the stages' cache keys."""


class Identity:
    def apply(self, df: DataFrame, column: str) -> DataFrame:
        return df

    def digest(self) -> str:
        return "identity"


class Dictionary:
    """Lemmas from a table (token, lemma).

    Distinct tokens meet the table once; the pairs found come back to the rows as a
    map. The plan is joins only, so the table may be of any size.
    """

    def __init__(self, table: DataFrame, key: str = "id"):
        self.table, self.key = table.select("token", "lemma").dropDuplicates(["token"]), key

    def apply(self, df: DataFrame, column: str) -> DataFrame:
        words = df.select(self.key, F.explode(F.array_distinct(column)).alias("token"))
        found = words.join(self.table, "token").groupBy(self.key).agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_lemma_of"))
        return df.join(found, self.key, "left").withColumn(column, F.transform(column, lambda x: F.coalesce(F.try_element_at("_lemma_of", x), x))).drop("_lemma_of")

    def digest(self) -> str:
        row = self.table.agg(F.count("*"), F.sum(F.xxhash64("token", "lemma").cast("decimal(38,0)"))).first()
        return f"table-{row[0]}-{row[1]}"


class Literal:
    """Lemmas from a small Python dictionary, compiled into the plan."""

    def __init__(self, lemmas: dict[str, str]):
        self.lemmas = lemmas

    def apply(self, df: DataFrame, column: str) -> DataFrame:
        if not self.lemmas:
            return df
        table = F.create_map(*[F.lit(x) for pair in sorted(self.lemmas.items()) for x in pair])
        return df.withColumn(column, F.transform(column, lambda x: F.coalesce(F.try_element_at(table, x), x)))

    def digest(self) -> str:
        return "literal-" + hashlib.sha256(repr(sorted(self.lemmas.items())).encode()).hexdigest()[:16]


def with_lemmas(df: DataFrame, text: str, out: str, lexicon: Lexicon, lemmatizer: Lemmatizer | None = None) -> DataFrame:
    """Add `out`: the text's lemmas; stopwords and single characters are dropped before and again after lemmatising."""
    df = df.withColumn(out, content_tokens(F.col(text), lexicon))
    return (lemmatizer or Identity()).apply(df, out).withColumn(out, _kept(F.col(out), lexicon))


def matching_text(lemmas: Column) -> Column:
    return F.array_join(lemmas, " ")


def secondary_key(segments: Column) -> Column:
    """The last path segment, lower-cased; empty without one."""
    return F.lower(F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit("")))


def short_hash(text: Column) -> Column:
    """The first 16 hex digits of SHA-256."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 16)


def cleaned_labels(values: Column) -> Column:
    """Lower-cased, trimmed, non-empty, distinct, sorted labels; null gives none."""
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(F.transform(values, lambda x: trimmed(F.lower(x))), lambda x: x != ""))), F.array().cast("array<string>"))
