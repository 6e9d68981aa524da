"""Secret scans: fixed patterns, and probabilistic automata inferred from labelled credentials.

For each known credential format an automaton is inferred (ALERGIA): a prefix tree of
labelled examples, in which states whose outgoing frequencies agree within Hoeffding's
bound are merged, recursively. Another is inferred from labelled ordinary tokens.
Characters after a literal prefix are read by class (lower, upper, digit, hex letter,
each mark), with the class's size in the likelihood.

A format is read from every place where its literal prefix stands, whatever is before
it, and may end at each place where its automaton can. It is a secret if at one of them,
from LEAST characters on, the format beats the ordinary tokens' automaton by MARGIN nats;
it then reaches to the last of them, so that no end of a credential stays. Formats
without a literal prefix are runs of hex digits, which the fixed pattern takes whole.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches, frugal, plain, steps

# Fixed patterns: (kind, pattern, group whose length counts, least length).
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run from its first character on, as `[0-9a-f]+` with 16 characters or more
EXAMPLES, SEED, ALPHA, PREFIX, MARGIN, LEAST = 240, 7, 0.05, 4, 10.0, 16

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALNUM = _LOWER + _UPPER + _DIGIT
#: Public shapes of credentials: literal parts and (alphabet, least, most) parts.
FORMATS: dict[str, list] = {
    "aws_access": ["AKIA", (_UPPER + "234567", 16, 16)],
    "hex_digest": [("0123456789abcdef", 32, 40)],
    "github": ["ghp_", (_ALNUM, 36, 36)],
    "gitlab": ["glpat-", (_ALNUM + "_-", 20, 20)],
    "slack": ["xoxb-", (_DIGIT, 11, 13), "-", (_DIGIT, 11, 13), "-", (_ALNUM, 24, 24)],
    "google": ["AIza", (_ALNUM + "_-", 35, 35)],
    "stripe": ["sk_live_", (_ALNUM, 24, 32)],
    "npm": ["npm_", (_ALNUM, 36, 36)],
    "digitalocean": ["dop_v1_", ("0123456789abcdef", 64, 64)],
    "huggingface": ["hf_", (_LOWER + _UPPER, 34, 34)],
}


def labelled_credentials() -> dict[str, list[str]]:
    """EXAMPLES per format, drawn with a fixed seed."""
    rng = random.Random(SEED)
    return {name: ["".join(p if isinstance(p, str) else "".join(rng.choices(p[0], k=rng.randint(p[1], p[2]))) for p in parts) for _ in range(EXAMPLES)] for name, parts in FORMATS.items()}


def labelled_ordinary() -> list[str]:
    """Tokens that are no credentials: words, numbers, hosts, paths, file names, dates, versions, identifiers."""
    rng = random.Random(SEED + 1)
    word = lambda: "".join(rng.choices("etaoinshrdlucmfwypvbgk", k=rng.randint(3, 12)))
    number = lambda a, b: str(rng.randint(10**a, 10**b))
    makers = [
        lambda: word() + word() + number(0, 4), lambda: number(9, 17), lambda: f"www.{word()}.example.com/{word()}/{number(2, 5)}.html", lambda: f"{word()}_{word()}_{number(0, 4)}.txt",
        lambda: f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}.{rng.randint(0, 59):02}", lambda: f"{word()}-{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}-{word()}",
        lambda: f"{word()}/{word()}/{word()}-{number(0, 3)}", lambda: f"{word().title()}{word().title()}{number(0, 3)}", lambda: f"{word().upper()}-{number(1, 5)}-{word().upper()}", lambda: f"{word()}={number(0, 6)}={word()}",
        lambda: f"+{number(0, 2)}-{number(2, 3)}-{number(2, 3)}-{number(3, 4)}", lambda: f"{word()}.{word()}.{number(0, 4)}.{word()}",
    ]
    return [rng.choice(makers)() for _ in range(12 * EXAMPLES)]


_CLASS = {c: "d" if c in _DIGIT else "h" if c in "abcdef" else "l" if c in _LOWER else "U" for c in _ALNUM}


def symbols(token: str, prefix: int = PREFIX) -> list[str]:
    """The token as an automaton reads it: literal characters first, classes after that."""
    return [*token[:prefix], *(_CLASS.get(c, c) for c in token[prefix:])]


_SIZE = {"d": 10, "h": 6, "l": 20, "U": 26}


class Automaton:
    """A deterministic probabilistic automaton."""

    def __init__(self, tokens: list[str], prefix: int = PREFIX, alpha: float = ALPHA):
        self.prefix = prefix
        self.next: list[dict[str, list]] = [{}]  # symbol: [state, count]
        self.ends = [0]
        self.seen = [0]
        for token in tokens:
            state = 0
            self.seen[0] += 1
            for s in symbols(token, prefix):
                step = self.next[state].setdefault(s, [len(self.next), 0])
                if step[0] == len(self.next):
                    self.next.append({})
                    self.ends.append(0)
                    self.seen.append(0)
                step[1] += 1
                state = step[0]
                self.seen[state] += 1
            self.ends[state] += 1
        self.spread = math.sqrt(0.5 * math.log(2 / alpha))
        self._infer()

    def _close(self, a: int, na: int, b: int, nb: int) -> bool:
        return abs(a / na - b / nb) < self.spread * (1 / math.sqrt(na) + 1 / math.sqrt(nb))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            if not self._close(self.ends[p], self.seen[p], self.ends[q], self.seen[q]):
                return False
            for s in self.next[p].keys() | self.next[q].keys():
                a, b = self.next[p].get(s), self.next[q].get(s)
                if not self._close(a[1] if a else 0, self.seen[p], b[1] if b else 0, self.seen[q]):
                    return False
                if a and b:
                    todo.append((a[0], b[0]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Add the tree below q to p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            if p == q:
                continue
            self.ends[p] += self.ends[q]
            self.seen[p] += self.seen[q]
            for s, (to, n) in list(self.next[q].items()):
                mine = self.next[p].get(s)
                if mine:
                    mine[1] += n
                    todo.append((mine[0], to))
                else:
                    self.next[p][s] = [to, n]

    def _infer(self) -> None:
        red = [0]
        while True:
            blue = [(self.seen[step[0]], p, s) for p in red for s, step in self.next[p].items() if step[0] not in red]
            if not blue:
                break
            _, p, s = max(blue)
            q = self.next[p][s][0]
            options = [r for r in red if self._compatible(r, q)]
            if options:
                to = min(options, key=lambda r: abs(r - q))
                self.next[p][s][0] = to
                self._fold(to, q)
            else:
                red.append(q)
            if len(red) > 400:
                raise RuntimeError("the automaton does not generalise: give it more examples")

        number = {state: k for k, state in enumerate(red)}
        self.next = [{s: [number[to], n] for s, (to, n) in self.next[state].items()} for state in red]
        self.ends, self.seen = [self.ends[x] for x in red], [self.seen[x] for x in red]

    def step(self, state: int, k: int, c: str) -> tuple[int, float] | None:
        """The state after the k-th character, and what it adds to ln P; None if there is no such path."""
        s = c if k < self.prefix else _CLASS.get(c, c)
        step = self.next[state].get(s)
        return step and (step[0], math.log(step[1] / self.seen[state]) - (math.log(_SIZE.get(s, 1)) if k >= self.prefix else 0))

    def end(self, state: int) -> float:
        """What ending here adds to ln P."""
        return math.log(self.ends[state] / self.seen[state]) if self.ends[state] else -math.inf

    def likelihood(self, token: str) -> float:
        """ln P(token); -inf if the automaton has no such path."""
        state, total = 0, 0.0
        for k, c in enumerate(token):
            step = self.step(state, k, c)
            if not step:
                return -math.inf
            state, total = step[0], total + step[1]
        return total + self.end(state)


class Scanner:
    """All secrets of a text as (start, end, kind number); the last kind is the automata's."""

    def __init__(self):
        # formats without a literal prefix are read by class from the start
        self.formats = {name: Automaton(tokens, min(PREFIX, len(FORMATS[name][0])) if isinstance(FORMATS[name][0], str) else 0) for name, tokens in labelled_credentials().items()}
        self.ordinary = Automaton(labelled_ordinary(), 0)
        self.begins = [(parts[0][:PREFIX], self.formats[name]) for name, parts in FORMATS.items() if isinstance(parts[0], str)]

    def margin(self, token: str) -> float:
        """How much better the best format explains the token than ordinary tokens do, in nats."""
        best = max(a.likelihood(token) for a in self.formats.values())
        if best == -math.inf:
            return best
        plain_ = max(self.ordinary.likelihood(token), -math.log(64) * len(token))
        return best - plain_

    def base(self, text: str) -> list[tuple[int, int, int]]:
        found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
        return found + [(m.start(), m.end(), 2) for m in HEX.finditer(text)]

    def reach(self, format_: Automaton, text: str, begin: int, known: dict[int, int]) -> tuple[int, dict[int, int]]:
        """Where the credential that begins here ends (0: there is none), and the state after each place read.

        known is such states of an earlier credential: once both are in one state, this one lies in that one.
        """
        state, total, other, ordinary = 0, 0.0, 0, 0.0
        last, found, passed = 0, False, {}
        for k in range(len(text) - begin):
            at, c = begin + k, text[begin + k]
            step = format_.step(state, k, c)
            if not step:
                break
            state, total = step[0], total + step[1]
            if known.get(at) == state:
                return 0, passed
            passed[at] = state
            step = self.ordinary.step(other, k, c) if ordinary > -math.inf else None
            other, ordinary = (step[0], ordinary + step[1]) if step else (0, -math.inf)
            if format_.ends[state]:
                last = at + 1
                if not found and k + 1 >= LEAST:
                    found = total + format_.end(state) - max(ordinary + self.ordinary.end(other), -math.log(64) * (k + 1)) >= MARGIN
        return last if found else 0, passed

    def more(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        found = []
        for literal, format_ in self.begins:
            known: dict[int, int] = {}
            at = text.find(literal)
            while at >= 0:
                end, passed = self.reach(format_, text, at, known)
                if end:
                    found.append((at, end, 3))
                    known = passed
                at = text.find(literal, at + 1)
        out: list[tuple[int, int, int]] = []
        for b, e, k in sorted(found, key=lambda x: (x[0], -x[1])):  # one that lies in another, or in a fixed pattern's, says nothing new
            if not (out and e <= out[-1][1]) and not any(x <= b and e <= y for x, y, _ in base):
                out.append((b, e, k))
        return out

    def __call__(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(base spans, all spans), each sorted by start, then kind."""
        base = self.base(text)
        key = lambda x: (x[0], x[2], x[1])
        return sorted(base, key=key), sorted(base + self.more(text, base), key=key)


NAMES = [*KINDS, "format"]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{NAMES[k]}:{b}:{e}" for b, e, k in spans)


def _scanned(scanner):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner.value
        for batch in steps(batches, "text"):
            cols: list[list] = [[], [], [], [], []]
            for text in plain(batch.column(1)):
                base, spans = scan(text)
                for k in range(3):
                    cols[k].append(sum(x[2] == k for x in base))
                cols[3].append(hashlib.sha256(written(base).encode()).hexdigest())
                cols[4].append(written(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def _learnt(docs: DataFrame):
    """The automata, inferred once on the driver from the fixed examples: some hundred states."""
    bound_batches(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast(Scanner())


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans ("kind:start:end" in code points, end exclusive).

    A null text counts as empty: no spans, the digest of the empty string. Equal
    starts go in the order assign, access, hex, format. Repeated rows and null ids
    give a row each; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_scanned(_learnt(docs)), f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string").withColumnRenamed("id", id_col)


def _masked(scanner, text_col: str, mask: str):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner.value
        for batch in steps(batches, text_col):
            i = batch.schema.get_field_index(text_col)
            out = []
            for text in batch.column(i).to_pylist():
                if text:
                    at, kept = 0, []
                    for b, e, _ in scan(text)[1]:
                        if b >= at:
                            kept += [text[at:b], mask]
                        at = max(at, e)
                    text = "".join([*kept, text[at:]]) if at else text
                out.append(text)
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))

    return run


def masked(docs: DataFrame, text_col: str = "text", mask: str = "<secret>") -> DataFrame:
    """All rows and columns of docs, with every secret in the text replaced by the mask.

    Secrets that overlap are replaced as one. Null texts stay null and empty ones empty;
    null ids and repeated rows are rows like any other; columns of whatever names go
    along; an empty table gives an empty result.
    """
    return docs.mapInArrow(_masked(_learnt(docs), text_col, mask), docs.schema)
