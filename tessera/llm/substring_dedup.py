"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

1. Map: each task takes its documents in chunks of about a million words, hashes
   every window of `window` consecutive words (polynomial over 64-bit word
   hashes, modulo 2^64) and sorts the hashes.  Of a hash's occurrences in the
   chunk only those of its smallest document are left to count, dealt by hash
   range and packed (hash steps and positions in byte planes), about nine bytes a
   window; the others repeat already, and go to their documents' group (step 3) at
   once.  So a hot passage costs its hash range one entry for each chunk, however
   many documents hold it.
2. Count: one task for each hash range finds the hashes that start in several
   documents and reports every occurrence outside the smallest document.  With more
   than FAN ranges the entries are dealt twice, to FAN coarse ranges first, where those of
   many chunks are packed together, so that a row never shrinks to a few windows.
3. The positions come back packed by groups of documents, where overlapping
   windows merge into maximal removal intervals, one row a document; joined with
   their document, the covered words are removed.

Ranges are sized from the corpus (about two million windows each) and get no more than one
entry a chunk for each hash, groups of documents likewise, so a task's memory does not grow
with the data.  Two different windows share a hash with
probability 2^-64 a pair; matches are not compared word by word again.

Defined cases: a null text has no words; a document shorter than the window
loses nothing; a row with a null id neither removes nor is removed; rows with
the same id count as one document (they never remove each other's words) and
each keeps its own words; an empty table gives an empty result; other columns
of the input are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_text, tasks

WINDOW = 50
_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2^64
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_WORDS_CACHED = 300_000


class WordHashes(dict):
    """64-bit hash of a word, remembered; cleared when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_CACHED:
            self.clear()
        got = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = got
        return got

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Hash of words[i:i + window] for every i, over an array of word hashes."""
    n = len(words)
    up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
    up[:1], down[:1] = 1, 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    h = (sums[window:] - sums[:n + 1 - window]) * down[:max(0, n + 1 - window)]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h


def _planes(values: np.ndarray) -> bytes:
    """Little-endian bytes, one plane after the other (high planes are mostly zero), compressed."""
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def _unplanes(packed: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def _pack(hashes: np.ndarray, at: np.ndarray, docs: np.ndarray, tags: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """hashes ascending, with their word numbers `at` in a run of documents that start at `starts`."""
    used = np.unique(np.searchsorted(starts, at, side="right") - 1)
    return [_planes(np.diff(hashes, prepend=np.uint64(0))), _planes(at), _planes(docs[used]), _planes(tags[used]), _planes(starts[used])]


def _by_part(docs: np.ndarray, tags: np.ndarray, refs: np.ndarray, at: np.ndarray, parts: int) -> list[tuple]:
    """(part, docs, tags, counts, at) for each group of documents: repeated window positions `at` of the documents `refs`."""
    part = ((docs.view(np.uint64) * _MIX ^ tags.view(np.uint64)) % np.uint64(parts)).astype(np.int32)[refs]
    order = np.lexsort((at, refs, part))
    at, refs, part = at[order].astype(np.uint32), refs[order], part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else np.zeros(0, np.int64)
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        used, counts = np.unique(refs[a:b], return_counts=True)
        rows.append((int(part[a]), _planes(docs[used]), _planes(tags[used]), _planes(counts.astype(np.uint32)), _planes(at[a:b])))
    return rows


def _cut(hashes: np.ndarray, first: int, last: int, ranges: int) -> np.ndarray:
    """Places in ascending hashes where the ranges first .. last - 1 of `ranges` begin, and the end."""
    edges = np.array([(b << 64) // ranges for b in range(first, last)], np.uint64)
    return np.r_[np.searchsorted(hashes, edges), len(hashes)]


#: Ranges that entries are dealt to at a time.
FAN = 1024
#: From this number on, a bucket is a group of documents, whose rows need no counting.
_DIRECT = 1 << 30
_PARTS = ("h", "at", "docs", "tags", "starts")
_ENTRIES = "bucket int, h binary, at binary, docs binary, tags binary, starts binary"
_ENTRY_SCHEMA = pa.schema([("bucket", pa.int32()), *((p, pa.binary()) for p in _PARTS)])


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(_ENTRY_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRY_SCHEMA)], schema=_ENTRY_SCHEMA)


def _map_chunks(window: int, buckets: int, parts_of_docs: int, chunk_words: int):
    """Entries of the hash ranges 0 .. buckets - 1, and positions known to repeat for the groups of documents."""

    def chunk(parts: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        docs = np.array([d for d, _, _ in parts], np.int64)
        tags = np.array([t for _, t, _ in parts], np.int64)
        lengths = np.array([len(w) for _, _, w in parts], np.int64)
        starts = (np.cumsum(lengths) - lengths).astype(np.uint32)
        hashes = window_hashes(np.concatenate([w for _, _, w in parts]), window)
        rank = np.unique(docs, return_inverse=True)[1].astype(np.uint32)
        # windows that stay within one document
        at = np.concatenate([np.arange(s, s + n - window + 1, dtype=np.uint32) for s, n in zip(starts, lengths)])
        owner = np.repeat(rank, lengths - window + 1)
        hashes = hashes[at]
        order = np.argsort(hashes)
        hashes, at, owner = hashes[order], at[order], owner[order]
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        smallest = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.r_[first, len(hashes)]))
        keep = owner == smallest
        kept_h, kept_at, known_at = hashes[keep], at[keep], at[~keep]
        cut = _cut(kept_h, 0, buckets, buckets)
        rows = [(b, *_pack(kept_h[cut[b]:cut[b + 1]], kept_at[cut[b]:cut[b + 1]], docs, tags, starts)) for b in range(buckets) if cut[b] < cut[b + 1]]
        refs = np.searchsorted(starts, known_at, side="right") - 1
        rows += [(_DIRECT + part, b"", where, d, t, counts) for part, d, t, counts, where in _by_part(docs, tags, refs, known_at - starts[refs], parts_of_docs)]
        return _entry_batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, parts, held = WordHashes(), [], 0
        for batch in batches:
            for doc, tag, raw in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(),
                                     batch.column("text").cast(pa.binary()).to_pylist()):
                words = raw.split()
                if len(words) < window:
                    continue
                parts.append((doc, tag, cache.array(words)))
                held += len(words)
                if held >= chunk_words:
                    yield chunk(parts)
                    parts, held = [], 0
        if parts:
            yield chunk(parts)

    return run


def _entries_of(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, document reference and position of all windows of packed rows, and the documents' ids and tags."""
    hashes, refs, at, docs, tags, base = [], [], [], [], [], 0
    for h, packed_at, ids, marks, starts in rows:
        ids, starts, where = _unplanes(ids, np.int64), _unplanes(starts, np.uint32), _unplanes(packed_at, np.uint32)
        doc = np.searchsorted(starts, where, side="right") - 1
        hashes.append(np.cumsum(_unplanes(h, np.uint64), dtype=np.uint64))
        at.append(where - starts[doc])
        refs.append((doc + base).astype(np.int32))
        docs.append(ids)
        tags.append(_unplanes(marks, np.int64))
        base += len(ids)
    return tuple(map(np.concatenate, (hashes, refs, at, docs, tags)))


def _resplit(coarse: int, per: int, chunk_words: int):
    """Entries of coarse ranges as entries of `per` times as many ranges, those of many chunks in one row."""

    def flush(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
        h, refs, at, docs, tags = _entries_of(rows)
        order = np.argsort(h, kind="stable")
        h, refs, at = h[order], refs[order], at[order]
        longest = np.zeros(len(docs), np.int64)
        np.maximum.at(longest, refs, at.astype(np.int64) + 1)
        starts = np.cumsum(longest) - longest  # the documents one after the other, each as long as its last window's place
        where, starts = (starts[refs] + at).astype(np.uint32), starts.astype(np.uint32)
        cut = _cut(h, bucket * per, (bucket + 1) * per, coarse * per)
        return _entry_batch([(bucket * per + b, *_pack(h[cut[b]:cut[b + 1]], where[cut[b]:cut[b + 1]], docs, tags, starts))
                             for b in range(per) if cut[b] < cut[b + 1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            direct = []
            for bucket, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket >= _DIRECT:
                    direct.append((bucket, *parts))
                    continue
                held.setdefault(bucket, []).append(tuple(parts))
                sizes[bucket] = sizes.get(bucket, 0) + len(parts[0]) + len(parts[1])
                if sizes[bucket] >= 4 * chunk_words:  # some bytes a window
                    yield flush(bucket, held.pop(bucket))
                    sizes[bucket] = 0
            if direct:
                yield _entry_batch(direct)
        for bucket, rows in held.items():
            yield flush(bucket, rows)

    return run


def _count_range(entries: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Occurrences, in one hash range, of windows that also start in a smaller document: one row for each of
    `parts` groups of documents.  Rows that are for a group already pass through."""
    columns = ["part", "docs", "tags", "counts", "at"]
    bucket = int(entries["bucket"].iloc[0])
    if bucket >= _DIRECT:
        return pd.DataFrame({"part": bucket - _DIRECT, "docs": entries["docs"], "tags": entries["tags"], "counts": entries["starts"], "at": entries["at"]})[columns]
    h, refs, at, docs, tags = _entries_of(zip(*(entries[c] for c in _PARTS)))
    order = np.argsort(h)
    h, owner = h[order], docs[refs[order]]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    again = owner > np.repeat(np.minimum.reduceat(owner, first), np.diff(np.r_[first, len(h)]))
    hit = order[again]
    return pd.DataFrame(_by_part(docs, tags, refs[hit], at[hit], parts), columns=columns)


def _merge_part(window: int):
    """Maximal removal intervals of a group's documents, one row a document."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        docs, tags, at = [], [], []
        for row in rows.itertuples(index=False):
            counts = _unplanes(row.counts, np.uint32)
            docs.append(np.repeat(_unplanes(row.docs, np.int64), counts))
            tags.append(np.repeat(_unplanes(row.tags, np.int64), counts))
            at.append(_unplanes(row.at, np.uint32))
        docs, tags, at = map(np.concatenate, (docs, tags, at))
        order = np.lexsort((at, tags, docs))
        docs, tags, at = docs[order], tags[order], at[order]
        first = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (tags[1:] != tags[:-1])])
        spans = [intervals(at[a:b], window) for a, b in zip(first, np.r_[first[1:], len(at)])]
        return pd.DataFrame({"doc_id": docs[first], "tag": tags[first], "begins": [a for a, _ in spans], "ends": [b for _, b in spans]})

    return run


def intervals(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal [begin, end) word intervals covered by windows at these starts."""
    starts = np.unique(starts).astype(np.int64)
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(starts[1:] > starts[:-1] + window)
    return starts[np.r_[0, gap + 1]], starts[np.r_[gap, len(starts) - 1]] + window


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   chunk_words: int = 1_000_000, texts: bool = True) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, removed (maximal
    [begin, end) word intervals), kept_sha256 and, with `texts`, kept_text (the
    words that stay, joined by one space)."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    ranges = max(tasks(spark), size // 12_000_000)  # some six characters a word
    coarse = min(ranges, FAN)
    per = -(-ranges // coarse)
    buckets = coarse * per
    repeated_ids = not rows.groupBy("doc_id").count().where("count > 1 and doc_id is not null").isEmpty()
    # tells rows with the same id apart
    rows = rows.withColumn("tag", F.xxhash64("text") if repeated_ids else F.lit(0).cast("long"))
    entries = rows.where("doc_id is not null and text is not null").mapInArrow(_map_chunks(window, coarse, buckets, chunk_words), _ENTRIES)
    if per > 1:
        entries = entries.repartition(2 * coarse, "bucket").mapInArrow(_resplit(coarse, per, chunk_words), _ENTRIES)
    found = (entries.repartition(buckets, "bucket").groupBy("bucket")
             .applyInPandas(lambda rows: _count_range(rows, buckets), "part int, docs binary, tags binary, counts binary, at binary"))
    found = (found.repartition(buckets, "part").groupBy("part")
             .applyInPandas(_merge_part(window), "doc_id long, tag long, begins array<long>, ends array<long>"))
    fields = [pa.field("doc_id", pa.int64()), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()),
              pa.field("removed", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
              pa.field("kept_sha256", pa.string())] + ([pa.field("kept_text", pa.string())] if texts else [])
    schema = pa.schema(fields)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in fields[1:]]
            columns = (batch.column("text").cast(pa.binary()), batch.column("begins"), batch.column("ends"))
            for raw, begins, ends in zip(*(c.to_pylist() for c in columns)):
                words, begins, ends = (raw or b"").split(), begins or (), ends or ()
                kept, at = [], 0
                for a, b in zip(begins, ends):
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                line = b" ".join(kept)
                for column, value in zip(out, (len(words), len(words) - len(kept), [{"begin": a, "end": b} for a, b in zip(begins, ends)],
                                               hashlib.sha256(line).hexdigest(), line.decode())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(out, fields[1:]))], schema=schema)

    ddl = "doc_id long, n_words long, n_removed long, removed array<struct<begin: long, end: long>>, kept_sha256 string" + (", kept_text string" if texts else "")
    return rows.join(found, ["doc_id", "tag"], "left").select("doc_id", "text", "begins", "ends").mapInArrow(finish, ddl)
