"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of the benchmark items (n consecutive normalised words; a shorter
item is one window) are the patterns of an automaton; every document is
normalised to its words joined by single spaces and scanned once.  Matches are
mapped to document words and, on request, to character spans of the original
text.

The benchmark is a stated query set.  It is read once to the driver behind a
check of its size (`max_benchmark_chars`, an error beyond: split the benchmark
and combine the results) and sent to the tasks as text; automata are built in
the tasks from blocks of at most `block_chars` pattern characters, so memory is
bounded whatever the benchmark's size.  With one block (the usual case) there is
one automaton and one scan.

A map over the documents: no shuffle.

Defined cases: a null text has no words (nothing hit, not contaminated); null or
wordless items give no window; an item with a null id marks words but is not
named; items with the same window are all named; repeated ids are named once;
repeated document rows are scanned each; empty tables give empty results or
nothing hit; other columns of the input are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import ALNUM_LOWER, id_text

WINDOW = 10


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(ALNUM_LOWER).split()


def _windows(items: list[tuple[int | None, bytes]], n: int) -> dict[bytes, list[int | None]]:
    """Window text (with a space at either end) -> ids of the items it is from."""
    out: dict[bytes, list] = {}
    for item, raw in items:
        words = normal_words(raw)
        for i in range(max(1, len(words) - n + 1) if words else 0):
            ids = out.setdefault(b" " + b" ".join(words[i:i + n]) + b" ", [])
            if item not in ids:
                ids.append(item)
    return out


class _Scanner:
    """Automata over blocks of patterns; the last one used is kept."""

    def __init__(self, patterns: list[tuple[bytes, list]], block_chars: int):
        self.blocks: list[list] = [[]]
        size = 0
        for pattern in sorted(patterns):
            if size and size + len(pattern[0]) > block_chars:
                self.blocks.append([])
                size = 0
            self.blocks[-1].append(pattern)
            size += len(pattern[0])
        self.at = -1
        self.automaton = None

    def matches(self, block: int, text: str) -> list[tuple[int, tuple[int, list]]]:
        import ahocorasick

        if not self.blocks[block]:
            return []
        if self.at != block:
            self.automaton = ahocorasick.Automaton()
            for window, ids in self.blocks[block]:
                word = window.decode("utf-8", "surrogateescape")
                self.automaton.add_word(word, (len(word), ids))
            self.automaton.make_automaton()
            self.at = block
        return list(self.automaton.iter(text))


def _spans(raw: bytes, words: np.ndarray) -> list[dict]:
    """Character spans of runs of hit words in the original text."""
    buf = np.frombuffer(b" " + raw.translate(ALNUM_LOWER) + b" ", np.uint8) != 0x20
    edges = np.flatnonzero(buf[1:] != buf[:-1])
    starts, ends = edges[::2], edges[1::2]
    chars = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # characters up to and with each byte
    breaks = np.flatnonzero(np.diff(words) > 1)
    first, last = words[np.r_[0, breaks + 1]], words[np.r_[breaks, len(words) - 1]]
    return [{"start": int(chars[starts[a]] - 1), "end": int(chars[ends[b] - 1])} for a, b in zip(first, last)]


def _shared_patterns(docs: DataFrame, benchmark: DataFrame, window: int, item_col: str, item_text_col: str, max_benchmark_chars: int):
    """The benchmark's windows as a broadcast of checked size."""
    items = id_text(benchmark, item_col, item_text_col).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if size > max_benchmark_chars:
        raise ValueError(f"benchmark of {size} characters; the bound is {max_benchmark_chars}")
    patterns = sorted(_windows([(r.doc_id, r.text.encode()) for r in items.collect()], window).items())
    return docs.sparkSession.sparkContext.broadcast(patterns)


def _line(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogateescape")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", block_chars: int = 4_000_000, max_benchmark_chars: int = 256_000_000) -> DataFrame:
    """The rows of `docs`, all columns, without any benchmark window."""
    shared = _shared_patterns(docs, benchmark, window, item_col, item_text_col, max_benchmark_chars)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[text_col].cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(shared.value, block_chars)
        for batch in batches:
            lines = [_line(normal_words(raw or b"")) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
            clean = list(range(len(lines)))
            for block in range(len(scanner.blocks)):
                clean = [k for k in clean if not scanner.matches(block, lines[k])]
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(clean, pa.int64()))], names=["row"])

    return rows.mapInArrow(scan, T.StructType([rows.schema["row"]])).select("row.*")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   spans: bool = True, block_chars: int = 4_000_000, max_benchmark_chars: int = 256_000_000) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, item_ids (sorted as
    strings), items_sha256 and, with `spans`, the [start, end) character spans
    of the original text that are hit."""
    shared = _shared_patterns(docs, benchmark, window, item_col, item_text_col, max_benchmark_chars)
    fields = [pa.field("doc_id", pa.int64()), pa.field("n_words", pa.int64()), pa.field("n_hit", pa.int64()),
              pa.field("item_ids", pa.list_(pa.int64())), pa.field("items_sha256", pa.string())]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    fields += [pa.field("spans", span)] if spans else []
    schema = pa.schema(fields)
    ddl = "doc_id long, n_words long, n_hit long, item_ids array<long>, items_sha256 string" + (
        ", spans array<struct<start: long, end: long>>" if spans else "")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(shared.value, block_chars)
        for batch in batches:
            raws = batch.column("text").cast(pa.binary()).to_pylist()
            words = [normal_words(r or b"") for r in raws]
            found: dict[int, tuple[set, list]] = {}
            for block in range(len(scanner.blocks)):
                for k, ws in enumerate(words):
                    if not ws:
                        continue
                    line = _line(ws)
                    matches = scanner.matches(block, line)
                    if matches:
                        ids, hit = found.setdefault(k, (set(), []))
                        starts = np.flatnonzero(np.array(list(line), "U1") == " ")  # the space before word i stands at starts[i]
                        for end, (length, items_of) in matches:
                            ids.update(items_of)
                            hit.append((int(np.searchsorted(starts, end - length + 1)), int(np.searchsorted(starts, end))))
            n_hit, item_ids, digests, where = [], [], [], []
            for k, ws in enumerate(words):
                if k not in found:
                    n_hit.append(0), item_ids.append([]), digests.append(_NO_ITEMS), where.append([])
                    continue
                ids, hit = found[k]
                edge = np.zeros(len(ws) + 1, np.int64)
                np.add.at(edge, [a for a, _ in hit], 1)
                np.add.at(edge, [b for _, b in hit], -1)
                marked = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                named = sorted((i for i in ids if i is not None), key=str)
                n_hit.append(len(marked))
                item_ids.append(named)
                digests.append(hashlib.sha256(",".join(map(str, named)).encode()).hexdigest())
                where.append(_spans(raws[k], marked) if spans else [])
            columns = [list(map(len, words)), n_hit, item_ids, digests] + ([where] if spans else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, fields[1:]))], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(scan, ddl)


_NO_ITEMS = hashlib.sha256(b"").hexdigest()
