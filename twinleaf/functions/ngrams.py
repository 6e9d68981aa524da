"""Character and word n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def char_grams(text: Column, low: int = 3, high: int = 5) -> Column:
    """All substrings of low to high characters of each white-space word with a blank on both sides; lower-cased, repeats kept."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda w: w != "")

    def of_word(w: Column) -> Column:
        padded, size = F.concat(F.lit(" "), w, F.lit(" ")), F.length(w) + 2
        return F.flatten(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), size)), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(padded, i, n))))

    return F.flatten(F.transform(words, of_word))


def word_grams(text: Column) -> Column:
    """Word tokens and pairs of neighbours; lower-cased, repeats kept."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0))
    pairs = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(F.get(words, i), F.lit(" "), w))
    return F.concat(words, pairs)
