"""Lemmas from an outside analyser, remembered in a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinleaf.functions.text import Dictionary
from twinleaf.sources.exchange import read_lemmas, write_lemmas
from twinleaf.storage import cut


def analysed(tokens: DataFrame, analyse: Callable[[str], str | None]) -> DataFrame:
    """(token, lemma) of a table of tokens, in batches; a token that the analyser does not know is its own lemma."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"token": batch["token"], "lemma": [analyse(t) or t for t in batch["token"]]})

    return tokens.select("token").mapInPandas(run, "token string, lemma string")


class Remembered:
    """A lemmatiser that asks the analyser once for every token, ever: the table at `path` grows by those it does not hold."""

    def __init__(self, spark: SparkSession, path: str, analyse: Callable[[str], str | None], key: str = "id", name: str = "analyser"):
        self.spark, self.path, self.analyse, self.key, self.name = spark, path, analyse, key, name

    def apply(self, df: DataFrame, column: str) -> DataFrame:
        held = read_lemmas(self.spark, self.path)
        asked = cut(df.select(F.explode(column).alias("token")).distinct().join(held, "token", "left_anti"))
        if not asked.isEmpty():
            write_lemmas(cut(held.unionByName(analysed(asked, self.analyse))), self.path)
        return Dictionary(read_lemmas(self.spark, self.path), self.key).apply(df, column)

    def digest(self) -> str:
        return f"remembered-{self.name}"
