"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinleaf.llm.common import bound_batches, frugal, quiet_threads, raw, steps

#: Bytes that one call of the library takes.
CALL_BYTES = 1 << 20
#: Bytes of pieces whose lengths a task remembers; beyond that it starts anew.
REMEMBERED = 96 << 20


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The file's tokenizer, read once by each worker."""
    quiet_threads()
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


def _counter(path: str, limit: int):
    """Texts are split at every ASCII blank (0x20, 0x09-0x0D).

    That is safe for a tokenizer that drops white space: it never joins across a
    blank, Unicode composition doesn't reach over one, and no special token's string
    holds one. So a text's length is the sum over its pieces, and the library is
    called, in batches of about equal bytes, for the distinct pieces not met before.
    """

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        known: dict[bytes, int] = {}
        remembered = 0

        def learn(pieces: list[bytes]) -> None:
            for piece, e in zip(pieces, tokenizer.encode_batch_fast([x.decode() for x in pieces], add_special_tokens=False), strict=True):
                known[piece] = len(e)

        for batch in steps(batches, "text", 4 * CALL_BYTES):
            texts = raw(batch.column(1))
            split = [t.split() for t in texts]
            new = set().union(*split).difference(known)
            if remembered > REMEMBERED:
                known.clear()
                new = set().union(*split)
                remembered = 0
            remembered += sum(map(len, new)) + 120 * len(new)
            call, held = [], 0
            for piece in new:
                call.append(piece)
                held += len(piece) + 16
                if held >= CALL_BYTES:
                    learn(call)
                    call, held = [], 0
            if call:
                learn(call)
            counts = [sum(map(known.__getitem__, words)) for words in split]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())], names=["id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Whole texts are counted without begin, end or padding tokens; a special token's
    string inside a text counts as the library has it. A null text counts as empty:
    0 and 0. Repeated rows and null ids give a row each; other columns are ignored;
    an empty table gives an empty result. The tokenizer must drop white space (see
    _counter); its path is read on every executor.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(_counter(tokenizer_path, limit), f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
