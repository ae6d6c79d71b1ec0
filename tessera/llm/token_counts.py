"""Token counts by prefix dynamic programming.

For every document the exact token count of *every* prefix is built up from
left to right: the count at a position is the count at the start of its piece
plus the count of the piece's own prefix (:mod:`tessera.llm.tokens`; pieces
longer than a cached unit use the last-token recurrence, linear in their
length).  The counts are stored as compressed steps, so "how many tokens do
the first n characters take" and "how much of this text fits a budget" are
array look-ups and never encode the text again.

A map over the input: no shuffle, one document in memory at a time.

Defined cases: a null text counts as empty (0 tokens, empty counts); a null id
stays null; repeated rows are counted each; an empty table gives an empty
result; other columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import tokens
from tessera.llm.common import id_text


def pack_counts(counts: np.ndarray) -> bytes:
    """Prefix counts as compressed steps; the first byte says how wide a step is."""
    steps = np.diff(counts, prepend=0)
    wide = bool(len(steps)) and (steps.min() < -128 or steps.max() > 127)
    return (b"\4" if wide else b"\1") + zstandard.compress(steps.astype("<i4" if wide else "i1").tobytes(), 1)


def unpack_counts(packed: bytes) -> np.ndarray:
    kind = "<i4" if packed[:1] == b"\4" else "i1"
    return np.cumsum(np.frombuffer(zstandard.decompress(packed[1:]), kind), dtype=np.int64)


def tokens_at(counts: np.ndarray, n_chars: int) -> int:
    """Tokens of the first n_chars characters."""
    return int(counts[n_chars - 1]) if n_chars > 0 else 0


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_token_counts(docs: DataFrame, tokenizer: str, budgets: tuple[int, ...] = (), id_col: str = "doc_id",
                        text_col: str = "text", store: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens, fit (for each budget the characters of
    the longest prefix within it) and, with `store`, the packed prefix_counts."""
    fields = [pa.field("doc_id", pa.int64()), pa.field("n_bytes", pa.int64()), pa.field("n_chars", pa.int64()),
              pa.field("n_tokens", pa.int64()), pa.field("fit", pa.list_(pa.int64()))]
    fields += [pa.field("prefix_counts", pa.binary())] if store else []
    schema = pa.schema(fields)
    ddl = "doc_id long, n_bytes long, n_chars long, n_tokens long, fit array<long>" + (", prefix_counts binary" if store else "")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokens.load(tokenizer)
        for batch in batches:
            n_bytes, n_chars, n_tokens, fit, packed = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                counts = bpe.prefix_counts(text)
                n_bytes.append(len(text.encode()))
                n_chars.append(len(text))
                n_tokens.append(tokens_at(counts, len(text)))
                fit.append([len(text) if n_tokens[-1] <= b and not len(text) else longest_prefix(counts, b) for b in budgets])
                if store:
                    packed.append(pack_counts(counts))
            columns = [batch.column("doc_id"), n_bytes, n_chars, n_tokens, fit] + ([packed] if store else [])
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(count, ddl)


@F.udf(T.LongType(), useArrow=True)
def _tokens_at(packed, n_chars):
    return None if packed is None or n_chars is None else tokens_at(unpack_counts(packed), n_chars)


@F.udf(T.LongType(), useArrow=True)
def _longest_prefix(packed, budget):
    return None if packed is None or budget is None else longest_prefix(unpack_counts(packed), budget)


def tokens_of_prefix(prefix_counts: Column, n_chars: Column) -> Column:
    """Column form of :func:`tokens_at`, over stored counts."""
    return _tokens_at(prefix_counts, n_chars)


def prefix_within(prefix_counts: Column, budget: Column) -> Column:
    """Column form of :func:`longest_prefix`, over stored counts."""
    return _longest_prefix(prefix_counts, budget)
