"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license templates.

A block is any stretch of consecutive words, up to SPREAD times as many as a template
has. It matches the template if it holds at least THRESHOLD of the template's distinct
words, among them those without which the text names another license (needs), and none
that tell a license of like wording (bars). All words are ordered by their document
frequency over the whole corpus, rarest first; what reaches the threshold must hold one
of the template's first |T| - ceil(THRESHOLD * |T|) + 1 words (prefix), at least
ceil(THRESHOLD * |T|) of its words (length), and from a shared prefix word on enough
words must be left on both sides (position). Around the prefix words of a text that
passes, all blocks are counted by a sliding window, so no match is missed.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches, frugal, raw, steps

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # of UTF-8 with A-Z lower-cased: bytes from 0x80 are word characters
# Fixed phrases and their labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
THRESHOLD, SPREAD = Fraction(4, 5), Fraction(3, 2)


class Template(NamedTuple):
    label: str
    text: str
    needs: frozenset[str] = frozenset()
    bars: frozenset[str] = frozenset()


def _template(label: str, text: str, needs: str = "", bars: str = "") -> Template:
    return Template(label, text, frozenset(needs.split()), frozenset(bars.split()))


_GPL = "you can redistribute it and or modify it under the terms of the gnu"
_BY = "the free software foundation either version"
#: Notices by which licenses are commonly referred to, and the opening sentences of their texts.
TEMPLATES = [
    _template("mit", "released under the mit license", "mit"),
    _template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "granted", "organization"),
    _template("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "included"),
    _template("apache-2", "licensed under the apache license version 2.0", "apache 2"),
    _template("apache-2", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "compliance"),
    _template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "applicable"),
    _template("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general 3", "lesser affero apache"),
    _template("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general 2", "lesser affero apache"),
    _template("gpl", f"this program is free software {_GPL} general public license", "gnu general", "lesser affero library"),
    _template("gpl-3", f"this program is free software {_GPL} general public license as published by {_BY} 3 of the license or at your option any later version", "gnu general 3", "lesser affero library apache"),
    _template("gpl-2", f"this program is free software {_GPL} general public license as published by {_BY} 2 of the license or at your option any later version", "gnu general 2", "lesser affero library apache"),
    _template("lgpl", "this library is free software under the terms of the gnu lesser general public license", "gnu lesser"),
    _template("lgpl", f"this library is free software {_GPL} lesser general public license", "gnu lesser"),
    _template("agpl", f"this program is free software {_GPL} affero general public license", "gnu affero"),
    _template("bsd", "released under the bsd license", "bsd"),
    _template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "permitted"),
    _template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "retain"),
    _template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "fee"),
    _template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "arising"),
    _template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2.0", "mozilla"),
    _template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse"),
    _template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    _template("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "organization"),
    _template("cc-by-nc", "licensed under cc by nc 4.0", "nc", "sa nd"),
    _template("cc-by", "this work is licensed under a creative commons attribution 4.0 international license", "attribution", "sharealike noncommercial noderivatives noderivs"),
    _template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4.0 international license", "sharealike", "noncommercial"),
    _template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4.0 international license", "noncommercial", "sharealike noderivatives noderivs"),
    _template("cc0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide", "dedicated"),
    _template("all-rights-reserved", "copyright all rights reserved no part of this may be reproduced without permission", "reserved"),
]


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class Join:
    """The templates, indexed by the prefix words of the given order (word: document frequency)."""

    def __init__(self, templates: list[Template], frequency: dict[bytes, int], threshold: Fraction = THRESHOLD):
        self.labels, self.sets, self.need, self.width, self.needs, self.bars = [], [], [], [], [], []
        self.prefix: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.rank = {w: k for k, w in enumerate(sorted({w for t in templates for w in words_of(t.text.encode())}, key=lambda w: (frequency.get(w, 0), w)))}  # rarest first, ties by the word
        for n, t in enumerate(templates):
            words = words_of(t.text.encode())
            ordered = sorted(set(words), key=self.rank.__getitem__)
            need = math.ceil(threshold * len(ordered))
            self.labels.append(t.label)
            self.sets.append(frozenset(ordered))
            self.need.append(need)
            self.width.append(math.ceil(SPREAD * len(words)))
            self.needs.append(frozenset(w.encode() for w in t.needs))
            self.bars.append(frozenset(w.encode() for w in t.bars))
            for i, w in enumerate(ordered[: len(ordered) - need + 1]):
                self.prefix[w].append((n, i))

    def candidates(self, words: set[bytes]) -> set[int]:
        """Templates that a block of these words may reach, by the prefix, length and position filters."""
        hits = self.prefix.keys() & words
        if not hits:
            return set()
        known = sorted(self.rank.keys() & words, key=self.rank.__getitem__)
        at = {w: k for k, w in enumerate(known)}
        out = set()
        for w in hits:
            for n, i in self.prefix[w]:
                # at most so many words are shared before the prefix word, and from it on
                if len(known) >= self.need[n] and min(i, at[w]) + min(len(self.sets[n]) - i, len(known) - at[w]) >= self.need[n] and self.needs[n] <= words:
                    out.add(n)
        return out

    def best(self, n: int, words: list[bytes], begin: int, end: int) -> int:
        """The most of the template's words that a block within words[begin:end] holds with all it needs and none it bars."""
        wanted, needs, bars, width = self.sets[n], self.needs[n], self.bars[n], self.width[n]
        held: deque[int] = deque()
        counts: Counter[bytes] = Counter()
        most = 0
        for k in range(begin, end):
            w = words[k]
            if w in bars:
                held.clear()
                counts.clear()
            elif w in wanted:
                held.append(k)
                counts[w] += 1
                while held[0] <= k - width:
                    gone = words[held.popleft()]
                    counts[gone] -= 1
                    if not counts[gone]:
                        del counts[gone]
                if len(counts) > most and needs <= counts.keys():
                    most = len(counts)
        return most

    def scan(self, words: list[bytes]) -> tuple[set[str], float]:
        """Labels of the templates that some block reaches, and the greatest containment (0 without a match)."""
        labels, score = set(), 0.0
        maybe = self.candidates(set(words))
        if not maybe:
            return labels, score
        places: dict[int, list[int]] = defaultdict(list)
        for k, w in enumerate(words):
            for n, _ in self.prefix.get(w, ()):
                if n in maybe:
                    places[n].append(k)
        for n, found in places.items():
            width, begin = self.width[n], 0
            for k in range(len(found)):  # a block holds a prefix word, so it lies around one: places near each other are taken together
                if k + 1 < len(found) and found[k + 1] - found[k] < 2 * width:
                    continue
                both = self.best(n, words, max(0, found[begin] - width + 1), min(len(words), found[k] + width))
                begin = k + 1
                if both >= self.need[n]:
                    labels.add(self.labels[n])
                    score = max(score, both / len(self.sets[n]))
        return labels, score


_FIRST = [(p.encode().split(), label) for p, label in PHRASES]


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word's number, label) of each place where a phrase stands."""
    out = []
    present = set(words)
    for phrase, label in _FIRST:
        if not present.issuperset(phrase):
            continue
        k = -1
        while True:
            try:
                k = words.index(phrase[0], k + 1)
            except ValueError:
                break
            if words[k : k + len(phrase)] == phrase:
                out.append((k, label))
    return out


def _frequencies(vocabulary: frozenset[bytes]):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in steps(batches, "text"):
            for text in raw(batch.column(0)):
                counts.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    return run


def _scanned(join):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            cols: list[list] = [[] for _ in range(7)]
            for text in raw(batch.column(1)):
                words = words_of(text)
                places = phrase_places(words)
                base = {label for _, label in places}
                more, score = join.value.scan(words)
                row = (len(words), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else score)
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def license_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[Template] | None = None) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base: places of the fixed phrases. labels adds those of all templates that some block
    contains to THRESHOLD, with the words it needs and none it bars; score is 1 with a base
    phrase, else the greatest containment.
    A null or empty text has no words, no labels and score 0. Repeated rows and null
    ids give a row each; other columns are ignored; an empty table gives an empty
    result.
    """
    bound_batches(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    vocabulary = frozenset(w for t in templates for w in words_of(t.text.encode()))
    counted = docs.select("text").mapInArrow(_frequencies(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {r[0].encode(): r[1] for r in counted.collect()}  # the templates' words only
    join = docs.sparkSession.sparkContext.broadcast(Join(templates, frequency))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_scanned(join), f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double").withColumnRenamed("id", id_col)
