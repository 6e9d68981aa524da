"""Byte-level BPE encoding and decoding with a minimal acyclic transducer lexicon.

The corpus's frequent words (pieces of the splitting pattern) are compiled into a
minimal acyclic automaton: equal suffixes share states, and outputs on the edges add
up to the word's number, under which its token ids stand. The automaton is a few flat
arrays in one file of bounded size: Spark hands it to each executor once, and all
workers there memory-map the same copy. A batch's new words walk the automaton
together, one byte a step; words that it does not hold are merged exactly, lowest rank
first.

Texts are first cut at blanks (see runs), since the splitting pattern never joins across
these: each distinct run is split and looked up once for as long as it is remembered.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import mmap
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches, frugal, plain, steps
from twinleaf.storage import cut, put, remove

#: Most words of a lexicon: it bounds the file (some MB) and what the driver collects.
LEXICON_WORDS = 131_072
#: Bytes of words, and of runs, whose ids a task remembers; beyond that it starts anew.
REMEMBERED = 128 << 20
#: Bytes of text that are encoded at a time; of a word, beyond which it is merged by itself.
STEP, LONG = 2 << 20, 256
#: Runs, and bytes of text, that a task counts before it passes the counts on.
COUNTED, COUNTED_BYTES = 300_000, 64 << 20
#: White space as Unicode has it (Python's own class has more).
_S = r"\t-\r \x85\xa0  -     　"
_SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BLANK = regex.compile(f" (?=[^{_S}])")
_SPACE = regex.compile(f"[{_S}]")
_PRINTED = frozenset(map(chr, range(0x21, 0x7F)))


def runs(text: str) -> list[str]:
    """The text without some of its blanks: the pieces of the first run, and of a blank with each other run, are the text's.

    A blank before anything but white space always begins a piece, and white space
    before it is split as at a text's end.
    """
    out = text.split(" ")
    if "" in out or any(map(_SPACE.match, {x[0] for x in out} - _PRINTED)):
        return _BLANK.split(text)
    return out


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable Latin-1, else the next from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Ids, merges and bytes of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], _byte_letters()
        ids = model["vocab"]
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.tokens[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.first = [ids[c] for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = rank, ids[a + b]
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.pair_ranks, self.pair_ids = np.array(list(self.merges.values()), np.int64).reshape(-1, 2)[order].T

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, where each word's begin, and the end): merge(), for all words at once.

        Each round merges every word's pair of least rank wherever it stands, leftmost
        first where it overlaps itself; pairs with the new token have greater ranks.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        ids = np.array(self.first, np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words, none = [], [], 1 << 40
        while len(ids):
            key = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank = np.where((self.pairs[at] == key) & (word[:-1] == word[1:]), self.pair_ranks[at], none)
            rank, at = np.append(rank, none), np.append(at, 0)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.append(starts, len(ids)))
            least = np.minimum.reduceat(rank, starts)
            open_ = np.repeat(least < none, lengths)
            done_ids.append(ids[~open_])
            done_words.append(word[~open_])
            hit = open_ & (rank == np.repeat(least, lengths))
            places = np.flatnonzero(hit)
            # of neighbouring hits (a token paired with itself) every other one counts, from the first on
            first = np.flatnonzero(np.r_[True, np.diff(places) != 1][: len(places)])
            in_run = np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
            places = places[in_run % 2 == 0]
            ids[places] = self.pair_ids[at[places]]
            open_[places + 1] = False
            ids, word = ids[open_], word[open_]
        flat, owner = np.concatenate([np.empty(0, np.int64), *done_ids]), np.concatenate([np.empty(0, np.int64), *done_words])
        order = np.argsort(owner, kind="stable")
        return flat[order], np.concatenate([[0], np.bincount(owner, minlength=len(words)).cumsum()])

    def merge(self, word: bytes) -> list[int]:
        """The word's ids: merge the pair of least rank, leftmost first, until none is left."""
        ids = [self.first[b] for b in word]
        if len(ids) > 48:
            return self._merge_long(ids)
        get, none = self.merges.get, (1 << 30, 0)
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is none or best[0] == none[0]:
                break
            k = ranks.index(best)
            ids[k : k + 2] = [best[1]]
            del ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), none)
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, in n log n steps for words of any length."""
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(m[0], k, ids[k], ids[k + 1], m[1]) for k in range(n - 1) if (m := self.merges.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            j = after[k]
            if not alive[k] or j >= n or ids[k] != a or ids[j] != b:
                continue
            ids[k], alive[j] = new, False
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right < n and (m := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (m[0], left, ids[left], ids[right], m[1]))
        return [i for i, live in zip(ids, alive, strict=True) if live]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The file's vocabulary, read once by each worker."""
    return Vocabulary(path)


def compile_lexicon(words: Iterable[bytes], known: Vocabulary) -> bytes:
    """A minimal acyclic transducer of distinct words, as bytes (see Lexicon)."""
    words = sorted(set(words))
    register: dict[tuple, int] = {}
    made: list[tuple[bool, list[tuple[int, int]]]] = []  # final, edges (byte, target); targets come first

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(made)
            made.append((node[0], node[1]))
        return register[key]

    path: list[list] = [[False, []]]  # open states along the last word; equal finished states become one
    last = b""
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            done = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = settle(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    root = settle(path[0])

    below = []  # words that end in or after a state
    keys, targets, outputs = [], [], []
    for state, (final, edges) in enumerate(made):
        count = int(final)
        for byte, to in edges:
            keys.append(state << 8 | byte)
            targets.append(to)
            outputs.append(count)
            count += below[to]
        below.append(count)
    ids, starts = known.merge_all(words)
    parts = [np.array(x, t) for x, t in ((keys, np.uint64), (targets, np.uint32), (outputs, np.uint32), ([f for f, _ in made], np.uint32), (starts, np.uint32), (ids, np.uint32))]
    head = np.array([root, *map(len, parts)], np.uint64)
    return b"".join(x.tobytes() for x in (head, *parts))


class Lexicon:
    """The compiled transducer in a file, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(self.map, np.uint64, 7)
        self.root, at, parts = int(head[0]), 56, []
        for n, kind in zip(head[1:].tolist(), (np.uint64, np.uint32, np.uint32, np.uint32, np.uint32, np.uint32), strict=True):
            parts.append(np.frombuffer(self.map, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.keys, self.targets, self.outputs, self.final, self.starts, self.ids = parts

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where the lexicon does not hold it; all words take a step together."""
        found = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return found
        lengths = np.array([len(w) for w in words])
        order = np.argsort(-lengths, kind="stable")
        starts = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"".join(words), np.uint8)
        active, state, total = order, np.full(len(words), self.root, np.uint64), np.zeros(len(words), np.int64)
        depth = 0
        while len(active):
            ended = active[lengths[active] == depth]
            good = ended[self.final[state[ended].astype(np.int64)] == 1]
            found[good] = total[good]
            active = active[lengths[active] > depth]
            key = state[active] << np.uint64(8) | text[starts[active] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            active, at = active[ok], at[ok]
            state[active] = self.targets[at]
            total[active] += self.outputs[at]
            depth += 1
        return found


def _pasted(sizes: np.ndarray, starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Where the elements of strips laid one after the other come from: strip k is `sizes[k]` long and begins at `starts[k]`; `which` names them in turn."""
    n = sizes[which]
    ends = n.cumsum()
    return np.repeat(starts[which] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


class Strips:
    """Byte strings numbered from 0, to be joined in any order many at a time."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = self.sizes.cumsum() - self.sizes

    def join(self, which: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The strings that `which` names, joined from each of `ends` to the next."""
        joined = self.data[_pasted(self.sizes, self.starts, which)].tobytes()
        at = np.concatenate([[0], self.sizes[which].cumsum()])[ends].tolist()
        return [joined[b:e] for b, e in zip(at, at[1:])]


class Encoder:
    """Encodes and decodes whole texts; remembers words and runs of bounded size."""

    def __init__(self, known: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = known, lexicon
        self.words: dict[str, tuple[int, ...]] = {}  # words that no blank begins
        self.runs: dict[str, tuple[int, ...]] = {}  # what follows a blank: words, and runs of several words
        self.held = 0
        self.numbers = list(range(len(known.tokens)))  # one object for each id
        self.tokens = Strips(known.tokens)
        self.decimals = Strips([b"%d," % i for i in self.numbers])
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(known.special, key=len, reverse=True)) + ")") if known.special else None

    def known(self, word: str) -> tuple[int, ...] | None:
        return self.runs.get(word[1:]) if word[0] == " " else self.words.get(word)

    def remember(self, word: str, ids: tuple[int, ...]) -> None:
        if word[0] == " ":
            self.runs[word[1:]] = ids
        else:
            self.words[word] = ids
        self.held += len(word) + 8 * len(ids) + 150

    def learn(self, words: set[str]) -> None:
        """Ids of words not yet known: special, from the lexicon, or merged."""
        new = [w for w in words if self.known(w) is None]
        raw = [w.encode() for w in new]
        found = self.lexicon.numbers(raw)
        shared = self.numbers.__getitem__
        held = np.flatnonzero(found >= 0)
        starts = self.lexicon.starts
        begins, ends = starts[found[held]].astype(np.int64), starts[found[held] + 1].astype(np.int64)
        self._remember_all([new[k] for k in held.tolist()], self.lexicon.ids[_pasted(ends - begins, begins, np.arange(len(held)))], ends - begins)
        rare = [k for k in np.flatnonzero(found < 0).tolist() if new[k] not in self.vocabulary.special]
        for k in rare:
            if len(raw[k]) > LONG:
                self.remember(new[k], tuple(map(shared, self.vocabulary.merge(raw[k]))))
        rare = [k for k in rare if len(raw[k]) <= LONG]
        merged, at = self.vocabulary.merge_all([raw[k] for k in rare])
        self._remember_all([new[k] for k in rare], merged, np.diff(at))
        for word in self.vocabulary.special.keys() & new:
            self.words[word] = (self.vocabulary.special[word],)

    def _remember_all(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        shared, at = list(map(self.numbers.__getitem__, ids.tolist())), 0
        for word, n in zip(words, sizes.tolist(), strict=True):
            self.remember(word, tuple(shared[at : at + n]))
            at += n

    def learn_runs(self, found: Iterable[str], words: Iterable[str]) -> None:
        """Ids of the runs, as they are after a blank, and of the words."""
        new = {run: [" " + run] if run.isalpha() else _SPLIT.findall(" " + run) for run in found if run not in self.runs}
        self.learn(set(chain.from_iterable(new.values())).union(words))
        for run, words in new.items():
            if len(words) > 1:
                self.remember(" " + run, tuple(chain.from_iterable(map(self.known, words))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin, and the end); null counts as empty."""
        if self.held > REMEMBERED:
            self.words.clear()
            self.runs.clear()
            self.held = 0
        texts = texts.fill_null("")
        n = len(texts)
        lists = pa.compute.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        code, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        text_of = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
        after = np.ones(len(code), bool)  # a blank
        after[first] = False
        # texts in which white space follows a blank, or that name a special token, are cut with more care
        odd = np.zeros(n, bool)
        odd[text_of[np.array([not x or (x[0] not in _PRINTED and _SPACE.match(x) is not None) for x in names], bool)[code] & after]] = True
        for name in self.vocabulary.special:
            odd |= pa.compute.match_substring(texts, name).to_numpy(zero_copy_only=False)
        even = ~odd[text_of]
        used = np.unique(code[even & after]).tolist()
        heads = [[] if o else _SPLIT.findall(names[c]) for o, c in zip(odd.tolist(), code[first].tolist(), strict=True)]
        for k in np.flatnonzero(odd).tolist():
            heads[k] = self._words(texts[k].as_py())
        self.learn_runs([names[c] for c in used], set().union(*heads))
        # strips: the runs used, then a text's first run, or all of an odd text
        strips = [self.runs[names[c]] for c in used] + [tuple(chain.from_iterable(map(self.known, h))) for h in heads]
        number = np.zeros(len(names), np.int64)
        number[used] = np.arange(len(used))
        which = np.where(after, number[code], len(used) + text_of)[even | ~after]
        sizes = np.array([len(x) for x in strips], np.int64)
        flat = np.fromiter(chain.from_iterable(strips), np.int32, int(sizes.sum()))
        ids = flat[_pasted(sizes, sizes.cumsum() - sizes, which)]
        per_text = np.bincount(text_of[even | ~after], sizes[which], n).astype(np.int64)
        return ids, np.concatenate([[0], per_text.cumsum()])

    def _words(self, text: str) -> list[str]:
        """The text's words in order; a special token's string is one."""
        out: list[str] = []
        for k, part in enumerate([text] if self.cut is None else self.cut.split(text)):
            out += [part] if k % 2 else _SPLIT.findall(part)
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of the ids from each of `ends` to the next."""
        return [x.decode("utf-8", "replace") for x in self.tokens.join(ids, ends)]


@frugal
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    firsts: Counter[str] = Counter()
    others: Counter[str] = Counter()
    held = 0

    def flush() -> pa.RecordBatch:
        counts: Counter[str] = Counter()
        for found, blank in ((firsts, ""), (others, " ")):
            for run, n in found.items():
                for word in [blank + run] if run.isalpha() else _SPLIT.findall(blank + run):
                    if len(word) <= 64:
                        counts[word] += n
            found.clear()
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for batch in steps(batches, "text", STEP):
        for text in plain(batch.column(0)):
            found = runs(text)
            firsts[found[0]] += 1
            del found[0]
            others.update(found)
            held += len(text)
            if len(others) + len(firsts) > COUNTED or held > COUNTED_BYTES:
                yield flush()
                held = 0
    yield flush()


def _rounded(n: Column) -> Column:
    """n with its twelve leading binary digits, the others 0: some 100,000 values at most."""
    places = F.greatest(F.length(F.bin(n)) - 12, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", n, places), places)


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The corpus's most frequent words of up to 64 characters, counted over all of it.

    Counts are compared rounded; words of one rounded count are taken together or not
    at all, so up to `most` words come to the driver, and nothing else but a histogram.
    """
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_counted, "word string, n long")
    counted = cut(counted.groupBy("word").agg(F.sum("n").alias("n")).withColumn("n", _rounded(F.col("n"))))
    least, total = None, 0
    for n, words in sorted((tuple(r) for r in counted.groupBy("n").count().collect()), reverse=True):
        total += words
        if total > most:
            break
        least = n
    words = [] if least is None else [r[0] for r in counted.where(F.col("n") >= least).select("word").collect()]
    remove(docs.sparkSession, counted)
    return words


def _digests(path: str, lexicon: str):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path), Lexicon(SparkFiles.get(lexicon)))
        for batch in steps(batches, "text", STEP):
            ids, ends = encoder.encode(batch.column(1))
            ids_sha = [hashlib.sha256(x[:-1]).hexdigest() for x in encoder.decimals.join(ids, ends)]
            text_sha = [hashlib.sha256(x.encode()).hexdigest() for x in encoder.decode(ids, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encoded(path: str, lexicon: str):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path), Lexicon(SparkFiles.get(lexicon)))
        for batch in steps(batches, "text", STEP):
            ids, ends = encoder.encode(batch.column(1))
            same = [x == y for x, y in zip(plain(batch.column(1)), encoder.decode(ids, ends), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), lists, pa.array(same, pa.bool_()), *batch.columns[2:]], names=["id", "n_tokens", "ids", "round_trip", *batch.schema.names[2:]])

    return run


def _lexicon(docs: DataFrame, path: str, text_col: str, words: list[str] | None) -> str:
    """The name under which every executor has the compiled lexicon's file."""
    spark = docs.sparkSession
    bound_batches(spark)
    words = frequent_words(docs, text_col) if words is None else words
    name = f"lexicon-{uuid.uuid4().hex}"
    spark.sparkContext.addFile(put(spark, name, compile_lexicon((w.encode() for w in words), vocabulary(path))))
    return name


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", words: list[str] | None = None) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (text decoded from the ids).

    words: the lexicon's words; by default the corpus's frequent ones. They change
    the time, not the result. A null text counts as empty: no tokens, digests of the
    empty string. Repeated rows and null ids give a row each; other columns are
    ignored; an empty table gives an empty result.
    """
    packed = _lexicon(docs, tokenizer_path, text_col, words)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_digests(tokenizer_path, packed), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", words: list[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per input row: id, n_tokens, ids array<int>, round_trip (decoding the ids gave the text), and the columns of `keep`.

    Nulls, repeated rows, other columns and an empty table are as encode_digests has them.
    """
    name = _lexicon(docs, tokenizer_path, text_col, words)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    kinds = {c: docs.schema[c].dataType.simpleString() for c in docs.columns}
    made = docs.mapInArrow(_encoded(tokenizer_path, name), ", ".join([f"id {kinds['id']}, n_tokens long, ids array<int>, round_trip boolean", *(f"k{i} {kinds[f'k{i}']}" for i in range(len(keep)))]))
    return made.withColumnsRenamed({"id": id_col} | {f"k{i}": c for i, c in enumerate(keep)})
