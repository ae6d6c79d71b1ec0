"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A is a byte-level BPE file of the `tokenizers` library, read over space + text;
tokenizer B is a `sentencepiece` model, read over the text, to which it adds the space itself.

1. Spans.  The character offsets of A and the proto spans of B are the coarse cuts.  A token
   whose span is not exactly its own bytes (part of a multibyte character, a byte-fallback
   piece, a span without its space) ends where its decoded bytes end.  A text whose joined
   bytes are not space + text on both sides has no tokens.
2. Groups.  Byte offsets where a token of A and one of B both end cut the two sequences into
   groups; the two tokens that end there are linked.
3. Corpus counts.  Documents are read in chunks of bounded text.  A chunk gives each distinct
   pair of linked ids once, with its count; counts are summed by pair over the corpus, and the
   best count of each B id is marked.  The pairs go back to the chunks that hold them, where
   the documents' links are looked up.  What is shuffled is a chunk's distinct pairs and the
   packed ids (under 2 bytes a token), and nothing is held by vocabulary or for the whole corpus.

A single space or line end between two other characters ends a token in both tokenizers (no
piece of B may hold one inside, which is checked when the model is loaded), so the words of a
text are read one by one, and a bounded cache of words answers most of them.

Defined cases: a null or empty text, and one that does not come back, has zeros and ''; a
null id stays null; rows with the same id are counted and returned each; an empty table gives
an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, id_text
from tessera.llm.tokens import _byte_alphabet

#: Text bytes of a chunk: what one task holds of the corpus at a time.
CHUNK_BYTES = 4 << 20
#: Words and tokens after which the cache begins a new generation.
_CACHE_UNITS, _CACHE_TOKENS = 350_000, 4_000_000
_SHIFT = 32

# Python's white space holds that of both tokenizers, so these cuts are cuts in both.
_odd_space = re.compile(r"^\s|\s\s|\s\Z").search
_single_space = re.compile(r"(?<=\S) (?=\S)")


@contextmanager
def _uncollected():
    """No search for reference cycles meanwhile: words, tokens and spans make none, and each search walks all of them."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def refined_widths(begins: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes that each token of a run of text covers.

    A coarse span that begins where the tokens before end, and is as long as the token's decoded bytes, is
    taken as it is; any other token (a piece of a character, a span without its space) covers its decoded bytes."""
    at = np.cumsum(lengths) - lengths
    exact = (begins == at) & (ends - begins == lengths)
    return np.where(exact, ends - begins, lengths)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    upto = np.cumsum(sizes)
    return np.repeat(starts - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)


class _Words:
    """Aligned words by their key: for each the ids and byte widths of both sides, in pools."""

    def __init__(self):
        self.index: dict = {}
        self.tokens = 0
        self._parts: list[tuple] = []

    def add(self, keys: list, sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]], ok: np.ndarray) -> None:
        """sides: (tokens of each word, ids, widths) of A and of B."""
        base = len(self.index)
        self.index.update(zip(keys, range(base, base + len(keys))))
        self.tokens += sum(len(ids) for _, ids, _ in sides)
        self._parts.append((ok, *sides[0], *sides[1]))

    def pools(self) -> list[np.ndarray]:
        """ok, and of each side tokens of each word, ids, widths and first token of each word."""
        if len(self._parts) > 1:
            self._parts = [tuple(map(np.concatenate, zip(*self._parts)))]
        ok, n_a, a, w_a, n_b, b, w_b = self._parts[0] if self._parts else (np.zeros(0, bool), *[np.zeros(0, np.int64)] * 6)
        return [ok, (n_a, a, w_a, np.cumsum(n_a) - n_a), (n_b, b, w_b, np.cumsum(n_b) - n_b)]

    def take(self, at: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """ok, and (tokens of each word, ids, widths) of each side, of the words with these numbers."""
        ok, *sides = self.pools()
        out = []
        for n, ids, widths, first in sides:
            where = ragged(first[at], n[at])
            out.append((n[at], ids[where], widths[where]))
        return ok[at], out


class Aligner:
    """Two loaded tokenizers, and a bounded cache of aligned words.

    A word's key is the word itself if a space leads it, "\\n" and the word if a line end does, and a tuple for
    the beginning of a text that begins with white space."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings inside a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        raw = _byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        plain = set(json.loads(self.a.to_str())["model"]["vocab"])
        self.bytes_a = {i: bytes(raw[c] for c in t) if t in plain and all(c in raw for c in t) else t.encode() for t, i in vocab.items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = {i: bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.by_line = self.by_word and not any("\n" in p for p in pieces)
        self.space_b = self.b.piece_to_id("▁")
        self.kind = np.dtype("<u2" if max([*self.bytes_a, *self.bytes_b]) < 1 << 16 else "<u4")
        self.length_a, self.length_b = (np.array([len(t.get(i, b"")) for i in range(max(t) + 1)], np.int64) for t in (self.bytes_a, self.bytes_b))
        # digits of an id, and what follows it in the text of the groups
        self._told = [f"{i}{mark}".encode() for marks, t in ((",|", self.length_a), (",;", self.length_b)) for i in range(len(t)) for mark in marks]
        self._recent, self._before = _Words(), _Words()
        self._compress, self._decompress = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress

    # ---- words ----------------------------------------------------------------
    def keys(self, text: str) -> list:
        if not self.by_word:
            return [(text,)]
        if _odd_space(text):
            words = _single_space.split(text)
            return [(words[0],), *words[1:]] if words[0][:1].isspace() else words
        if "\n" in text and self.by_line:  # no blank lines here
            return text.replace("\n", " \n").split(" ")
        return text.split(" ")

    def _spans(self, keys: list) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """(tokens of each word, ids, byte widths) of A and of B, and whether each word comes back on both sides."""
        texts = [k[0] if isinstance(k, tuple) else k for k in keys]
        lines = [isinstance(k, str) and k[:1] == "\n" for k in keys]
        raws = [t if line else " " + t for t, line in zip(texts, lines)]
        # A: character offsets, to bytes of all words one after the other
        encoded = self.a.encode_batch(raws, add_special_tokens=False)
        code = np.frombuffer("".join(raws).encode("utf-32-le"), "<u4")
        at_byte = np.r_[0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), dtype=np.int64)]
        n_chars = np.fromiter(map(len, raws), np.int64, len(raws))
        begin_char = np.cumsum(n_chars) - n_chars
        n_a = np.fromiter(map(len, encoded), np.int64, len(raws))
        a = np.fromiter(chain.from_iterable(e.ids for e in encoded), np.int64, n_a.sum())
        offsets = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in encoded)), np.int64, 2 * n_a.sum()).reshape(-1, 2) + np.repeat(begin_char, n_a)[:, None]
        widths_a = refined_widths(at_byte[offsets[:, 0]], at_byte[offsets[:, 1]], self.length_a[a])
        # B: byte spans of the word without the added space, which stands in its first piece
        protos = self.b.encode(texts, return_type="proto", num_threads=1)
        pieces = [[(p.id, p.begin, p.end) for p in proto.pieces] for proto in protos]
        begin_byte = at_byte[begin_char].tolist()
        flat, n_b = [], np.zeros(len(keys), np.int64)
        for k, (found, line, base) in enumerate(zip(pieces, lines, begin_byte)):
            if line:  # the space that B adds before a line end is not in the text
                found = found[1:] if found and found[0][0] == self.space_b else []
                flat += [(i, base + s, base + e) for i, s, e in found]
            else:
                flat += [(i, base + 1 + s if j else base, base + 1 + e) for j, (i, s, e) in enumerate(found)]
            n_b[k] = len(found)
        spans = np.array(flat, np.int64).reshape(-1, 3)
        b = spans[:, 0]
        widths_b = refined_widths(spans[:, 1], spans[:, 2], self.length_b[b])
        # words that come back: all at once, else one by one
        whole = "".join(raws).encode()
        n_bytes = at_byte[begin_char + n_chars] - at_byte[begin_char]
        ok = np.ones(len(keys), bool)
        for ids, n, table, lengths in ((a, n_a, self.bytes_a, self.length_a), (b, n_b, self.bytes_b, self.length_b)):
            found = [table[i] for i in ids.tolist()]
            upto = np.r_[0, np.cumsum(lengths[ids])]
            ends = np.cumsum(n)
            if b"".join(found) != whole or (upto[ends] - upto[ends - n] != n_bytes).any():
                for k, (end, size) in enumerate(zip(ends.tolist(), n.tolist())):
                    ok[k] &= b"".join(found[end - size:end]) == raws[k].encode()
        if not ok.all():  # widths were refined against the words before; words that do not come back have no tokens
            good_a, good_b = np.repeat(ok, n_a), np.repeat(ok, n_b)
            a, b, n_a, n_b = a[good_a], b[good_b], np.where(ok, n_a, 0), np.where(ok, n_b, 0)
            widths_a, widths_b = self.length_a[a], self.length_b[b]
        return [(n_a, a.astype(self.kind), widths_a.astype(np.int32)), (n_b, b.astype(self.kind), widths_b.astype(np.int32))], ok

    def _known(self, keys: list) -> None:
        """Put the words of `keys` into the cache."""
        if len(self._recent.index) > _CACHE_UNITS or self._recent.tokens > _CACHE_TOKENS:
            self._before, self._recent = self._recent, _Words()  # words not met since the last change go
        recent, before = self._recent.index, self._before.index
        new = [k for k in dict.fromkeys(keys) if k not in recent]
        again = [k for k in new if k in before]
        if again:
            ok, sides = self._before.take(np.fromiter(map(before.__getitem__, again), np.int64, len(again)))
            self._recent.add(again, sides, ok)
        missing = [k for k in new if k not in before] if before else new
        for start in range(0, len(missing), 20_000):
            part = missing[start:start + 20_000]
            sides, ok = self._spans(part)
            self._recent.add(part, sides, ok)

    # ---- texts ----------------------------------------------------------------
    def aligned(self, texts: list[str | None]) -> Alignment:
        """The alignment of whole texts, one after the other; a text that does not come back has no tokens."""
        keys = [self.keys(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(keys))
        with _uncollected():
            self._known(flat)
        words = np.fromiter(map(self._recent.index.__getitem__, flat), np.int64, len(flat))
        owner = np.repeat(np.arange(len(texts)), [len(k) for k in keys])
        bad = np.zeros(len(texts), bool)
        bad[owner[~self._recent.pools()[0][words]]] = True
        words, owner = words[~bad[owner]], owner[~bad[owner]]
        _, ((n_a, a, w_a), (n_b, b, w_b)) = self._recent.take(words)
        counts = [np.bincount(owner, n, len(texts)).astype(np.int64) for n in (n_a, n_b)]
        return Alignment(a, b, *links(w_a, w_b), *counts)

    def groups_text(self, found: Alignment) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        n_a, n_b, upto = len(found.a), len(found.b), np.cumsum(found.n_a + found.n_b)
        codes = np.empty(n_a + n_b, np.int64)
        last_a, last_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        last_a[found.at_a], last_b[found.at_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        # a token stands after the other side's tokens of the groups before it, of B's also after those of its own
        codes[np.arange(n_a) + np.r_[0, found.at_b + 1][group_a]] = 2 * found.a.astype(np.int64) + last_a
        codes[np.arange(n_b) + (found.at_a + 1)[group_b]] = 2 * (len(self.length_a) + found.b.astype(np.int64)) + last_b
        told = self._told
        items = [told[c] for c in codes.tolist()]
        return [b"".join(items[begin:end])[:-1] for begin, end in zip(np.r_[0, upto[:-1]].tolist(), upto.tolist())]

    def packed(self, ids: np.ndarray) -> bytes:
        """Ids as compressed byte planes (the high bytes repeat)."""
        planes = np.ascontiguousarray(ids.astype(self.kind).view(np.uint8).reshape(-1, self.kind.itemsize).T)
        return self._compress(planes.tobytes()) if len(ids) else b""

    def unpacked(self, packed: bytes) -> np.ndarray:
        if not packed:
            return np.zeros(0, np.int64)
        planes = np.frombuffer(self._decompress(packed), np.uint8).reshape(self.kind.itemsize, -1)
        return np.ascontiguousarray(planes.T).view(self.kind).ravel().astype(np.int64)

    def groups(self, a: bytes, b: bytes) -> list[tuple[int, int, list[int], list[int]]]:
        """(first byte, byte after the last, ids of A, ids of B) of each group of a packed alignment; bytes are those of space + text."""
        ids_a, ids_b = self.unpacked(a), self.unpacked(b)
        ends = np.cumsum(self.length_a[ids_a])
        out, i, j, at = [], 0, 0, 0
        for last_a, last_b in zip(*links(self.length_a[ids_a], self.length_b[ids_b])):
            out.append((at, int(ends[last_a]), ids_a[i:last_a + 1].tolist(), ids_b[j:last_b + 1].tolist()))
            i, j, at = last_a + 1, last_b + 1, int(ends[last_a])
        return out


@dataclass(frozen=True)
class Alignment:
    """Ids of A and B of texts one after the other, places of the tokens that end groups, and tokens of each text."""

    a: np.ndarray
    b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray

    def pairs(self) -> np.ndarray:
        """The linked ids as one number each."""
        return self.a[self.at_a].astype(np.int64) << _SHIFT | self.b[self.at_b].astype(np.int64)

    def each(self, side: str) -> list[np.ndarray]:
        """Each text's ids."""
        ids, sizes = (self.a, self.n_a) if side == "a" else (self.b, self.n_b)
        return np.split(ids, np.cumsum(sizes)[:-1])


def links(widths_a: np.ndarray, widths_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and B (of one text, or of whole texts one after the other) of the tokens whose bytes end together."""
    ends_a, ends_b = np.cumsum(widths_a, dtype=np.int64), np.cumsum(widths_b, dtype=np.int64)
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    in_a, in_b = np.zeros(ends_a[-1] + 1, bool), np.zeros(ends_a[-1] + 1, bool)
    in_a[ends_a], in_b[ends_b] = True, True
    return np.flatnonzero(in_b[ends_a]), np.flatnonzero(in_a[ends_b])


_LOADED: dict[tuple[str, str], Aligner] = {}


def load(path_a: str, path_b: str) -> Aligner:
    """One instance per Python worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


_ALIGNED = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("groups_sha256", pa.string()), ("a_ids", pa.binary()), ("b_ids", pa.binary()), ("pairs", pa.list_(pa.int64())), ("pair_counts", pa.list_(pa.int64())),
])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, groups_sha256, a_ids and b_ids (packed; `Aligner.groups` gives the byte
    spans), and the chunk it was read in; the first row of a chunk holds the chunk's distinct pairs and their counts."""

    def chunk_rows(aligner: Aligner, number: int, ids: list, texts: list[str | None]) -> pa.RecordBatch:
        found = aligner.aligned(texts)
        groups = aligner.groups_text(found)
        pairs, counts = np.unique(found.pairs(), return_counts=True)
        rest = [None] * (len(ids) - 1)
        values = [[number] * len(ids), ids, found.n_a, found.n_b, [g.count(b";") + 1 if g else 0 for g in groups],
                  [hashlib.sha256(g).hexdigest() if g else "" for g in groups], [aligner.packed(x) for x in found.each("a")], [aligner.packed(x) for x in found.each("b")], [pairs, *rest], [counts, *rest]]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _ALIGNED)], schema=_ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, sizes = batch.column("doc_id").to_pylist(), batch.column("size").to_pylist()
            start, held = 0, 0
            for i, n in enumerate(sizes):
                held += n
                if held >= CHUNK_BYTES or i == len(sizes) - 1:
                    texts = batch.column("text").slice(start, i + 1 - start).to_pylist()
                    yield chunk_rows(aligner, number, ids[start:i + 1], texts)
                    number, start, held = number + 1, i + 1, 0

    rows = id_text(docs, id_col, text_col)
    rows = rows.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return rows.mapInArrow(run, "chunk long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a_ids binary, b_ids binary, "
                                "pairs array<long>, pair_counts array<long>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, links, best): how many links of the corpus hold the pair, and whether no pair of its B id has more."""
    of_chunks = aligned.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("x"))
    totals = of_chunks.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.pair_counts").alias("links"))
    totals = totals.select("pair", F.shiftright("pair", _SHIFT).alias("a_id"), F.col("pair").bitwiseAND((1 << _SHIFT) - 1).alias("b_id"), "links")
    highest = totals.groupBy("b_id").agg(F.max("links").alias("highest"))
    return totals.join(highest, "b_id").select("pair", "a_id", "b_id", "links", (F.col("links") == F.col("highest")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of `aligned` with n_links, n_best and count_sum in place of the chunk's columns."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a_ids", "b_ids"]

    def run(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        aligner = load(path_a, path_b)
        pairs = pairs.sort_values("pair")
        known, n_links, best = pairs["pair"].to_numpy(), pairs["links"].to_numpy(), pairs["best"].to_numpy()
        a, b = (np.concatenate([aligner.unpacked(x) for x in docs[c]]) for c in ("a_ids", "b_ids"))
        at_a, at_b = links(aligner.length_a[a], aligner.length_b[b])
        at = np.searchsorted(known, a[at_a] << _SHIFT | b[at_b])
        upto = np.searchsorted(at_a, np.cumsum(docs["n_a"].to_numpy()))  # links up to the end of each document
        total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[upto], prepend=0)
        out = docs[names].copy()
        out["n_links"], out["n_best"], out["count_sum"] = np.diff(upto, prepend=0), total(best[at]), total(n_links[at])
        return out

    held = aligned.where("pairs is not null").select(F.col("chunk").alias("held_by"), F.explode("pairs").alias("pair")).join(counts.select("pair", "links", "best"), "pair")
    return aligned.select("chunk", *names).groupBy("chunk").cogroup(held.groupBy("held_by")).applyInPandas(
        run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a_ids binary, b_ids binary, n_links long, n_best long, count_sum long")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, a_ids, b_ids."""
    aligned = checkpoint(align(docs, path_a, path_b, id_col, text_col))
    return link_scores(aligned, pair_counts(aligned), path_a, path_b)
