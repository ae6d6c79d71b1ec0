"""MinHash near-dedup with sequential Bayesian verification.

1. Sketch: one map computes each document's distinct word shingles (64-bit
   hashes), a 128-bit fingerprint of the set and 128 min-hashes.  Documents with
   the same fingerprint are one class from here on, so thousands of copies cost
   one row.
2. Bands of min-hashes deal the classes into buckets.  Each member of a bucket is
   paired with the bucket's smallest member: linear in the bucket, however large.
3. Sequential Bayesian test: signatures are compared in batches; a pair is dropped
   as soon as the posterior probability that its similarity reaches the threshold
   (uniform prior) falls under `miss`.
4. Exact verification: survivors are confirmed on full shingle sets.  Of the
   survivors that still join two components, each class first verifies its most
   similar one, so most redundant pairs are never touched; what is left is verified
   in later rounds.
5. Buckets whose members still are in several components have all their
   cross-component pairs tested and verified in the same way, in blocks of bounded
   size against each other inside the tasks, each pair in the first band it shares;
   only links come out.  No pair that shares a band and is not known to be
   connected is left out, and no group is ever expanded into rows for all its pairs.

A pair at the threshold shares no band with probability (1 - t^4)^32 = 5e-6 at
0.75, less above it.

Defined cases: a document without words (or text) is linked with nothing; one with
fewer words than a shingle has its whole sequence as its only shingle; rows with a
null id are linked with nothing (component_id null, kept); rows with the same id
are one document, linked through each of its texts; an empty table gives an empty
result; other columns of the input are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, forget, id_text
from tessera.llm.components import components
from tessera.llm.substring_dedup import WordHashes, window_hashes

SHINGLE, THRESHOLD = 5, 0.75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
MISS = 1e-6
_BATCH = 16
_BLOCK = 256
#: Pairs up to this many are sent to all tasks (16 bytes each) instead of shuffling every text to them.
SMALL_PAIRS = 100_000

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_RNG = np.random.default_rng(20240607)
_FLIPS = _RNG.integers(0, 1 << 64, HASHES, np.uint64)
_FACTORS = _RNG.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)


def shingles(raw: bytes, cache: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = raw.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(cache.array(words), min(size, len(words))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """uint32 min-hashes, one row of HASHES for each (non-empty) set."""
    out = np.empty((len(sets), HASHES), np.uint32)
    lengths = np.array([len(s) for s in sets])
    first, every = np.cumsum(lengths) - lengths, np.concatenate(sets)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(((every ^ _FLIPS[k]) * _FACTORS[k]) >> np.uint64(32), first)
    return out


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, matches needed): with fewer, P(similarity >= threshold) < miss.

    With a uniform prior the posterior after m matches of n is Beta(m + 1, n - m + 1),
    whose upper tail at t is the probability of at most m successes in n + 1 trials of t."""
    out = []
    for n in range(_BATCH, HASHES + 1, _BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def bayes_filter(left: np.ndarray, right: np.ndarray, needed: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two signature arrays that survive every batch, and their matches."""
    alive, matches, at = np.arange(len(left)), np.zeros(len(left), np.int32), 0
    for n, least in needed:
        matches = matches + (left[alive, at:n] == right[alive, at:n]).sum(1, dtype=np.int32)
        ok = matches >= least
        alive, matches, at = alive[ok], matches[ok], n
    return alive, matches


def sketch(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, f1, f2 (fingerprint) and sig (empty without shingles)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            sets = [shingles(raw or b"", cache, size) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
            prints = np.array([divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            sigs = [b""] * len(sets)
            part: list[int] = []
            held = 0
            for i, s in enumerate(sets):
                if len(s):
                    part.append(i)
                    held += len(s)
                if part and (held >= 32_768 or i == len(sets) - 1):  # chunks that stay in the processor's cache
                    for j, sig in zip(part, signatures([sets[j] for j in part])):
                        sigs[j] = sig.tobytes()
                    part, held = [], 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0]),
                                              pa.array(prints[:, 1]), pa.array(sigs, pa.binary())], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, sig binary")


def _sig_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, HASHES)


def _band_keys(sig: Column) -> Column:
    width = 4 * ROWS
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(sig, b * width + 1, F.lit(width))))


def _survivors(pairs: DataFrame, classes: DataFrame, needed: list[tuple[int, int]], threshold: float) -> DataFrame:
    """(a, b, matches) of the pairs that pass the sequential test."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("matches", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (_sig_array(batch.column(c).to_pylist()) for c in ("sig_a", "sig_b"))
            alive, matches = bayes_filter(a, b, needed)
            alive = pa.array(alive)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(alive), batch.column("b").take(alive), pa.array(matches, pa.int32())], schema=schema)

    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b"))
    joined = pairs.join(left, "a").join(right, "b").where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, matches int").groupBy("a", "b").agg(F.max("matches").alias("matches"))


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int, few: bool) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold; `few`: their ids are broadcast to find the texts."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            texts = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
            linked, last, left = [], None, None
            for i, (raw_a, raw_b) in enumerate(zip(*texts)):
                if raw_a != last:
                    last, left = raw_a, shingles(raw_a or b"", cache, size)
                right = shingles(raw_b or b"", cache, size)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if shared and 100 * shared >= percent * (len(left) + len(right) - shared):
                    linked.append(i)
            at = pa.array(linked, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], schema=schema)

    if few:
        ids = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "doc_id")
        docs = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    joined = (pairs.select("a", "b").join(docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
              .join(docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the components ca and cb of their ends."""
    return (pairs.join(labels.select(F.col("v").alias("a"), F.col("c").alias("ca")), "a", "left")
            .join(labels.select(F.col("v").alias("b"), F.col("c").alias("cb")), "b", "left")
            .withColumn("ca", F.coalesce("ca", "a")).withColumn("cb", F.coalesce("cb", "b")))


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (v, c) after the links (a, b) are added."""
    if labels is None:
        return components(links)
    merged = components(_labelled(links, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    ends = links.select("a").union(links.select("b")).distinct().toDF("v")
    every = labels.join(ends, "v", "full").select("v", F.coalesce("c", "v").alias("c"))
    renamed = every.join(merged.select(F.col("v").alias("c"), F.col("c").alias("to")), "c", "left")
    return checkpoint(renamed.select("v", F.coalesce("to", "c").alias("c")))


def _link(pairs: DataFrame, labels: DataFrame | None, docs: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Labels after every pair (a, b, matches) that joins two components was verified (None: nothing linked yet)."""
    rest = pairs
    del pairs
    for attempt in range(2):
        if labels is not None:
            rest = checkpoint(_labelled(rest.select("a", "b", "matches"), labels).where("ca <> cb").select("a", "b", "matches"))
        open_pairs = rest.count()
        if not open_pairs:
            break
        chosen = rest.select("a", "b")
        if attempt == 0:  # the most similar pair of each class; one verified link makes most others needless
            pair = F.struct("matches", "a", "b").alias("pair")
            ends = rest.select(F.col("a").alias("v"), pair).union(rest.select(F.col("b").alias("v"), pair))
            chosen = checkpoint(ends.groupBy("v").agg(F.max("pair").alias("pair")).select("pair.a", "pair.b").distinct())
        links = checkpoint(_verified(chosen, docs, size, percent, open_pairs <= SMALL_PAIRS))
        rest = rest.join(chosen, ["a", "b"], "left_anti")
        if not links.isEmpty():
            labels = _joined(labels, links)
        del links, chosen
        forget(docs.sparkSession)
    return labels


def _cross_links(needed: list[tuple[int, int]], threshold: float, size: int, percent: int):
    """Verified links of a group (key, p, q) between members of blocks p and q whose components differ.

    Each pair is looked at in the first band that it shares only, and no more once the group's links join its ends."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        p, q, band, pivot = (rows[c].iloc[0] for c in ("p", "q", "band", "pivot"))
        block, rep, comp, n = (rows[c].to_numpy() for c in ("block", "rep", "comp", "n"))
        comp = comp.copy()
        sig = _sig_array(rows["sig"])
        texts, cache, sets = rows["text"].to_list(), WordHashes(), {}
        left, right = np.flatnonzero((block == p) & (rep != pivot)), np.flatnonzero((block == q) & (rep != pivot))
        links = []
        for i in left:
            others = right[rep[right] > rep[i]] if p == q else right
            others = others[(comp[others] != comp[i]) & (np.minimum(n[others], n[i]) >= threshold * np.maximum(n[others], n[i]))]
            if not len(others):
                continue
            alive, _ = bayes_filter(np.broadcast_to(sig[i], (len(others), HASHES)), sig[others], needed)
            earlier = (sig[others[alive], :ROWS * band] == sig[i, :ROWS * band]).reshape(len(alive), band, ROWS).all(2).any(1)
            for j in others[alive[~earlier]]:
                if comp[j] == comp[i]:
                    continue
                for t in (i, j):
                    if t not in sets:
                        sets[t] = shingles((texts[t] or "").encode(), cache, size)
                x, y = sets[i], sets[j]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    links.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                    comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return run


def _block_pairs(opened: DataFrame) -> DataFrame:
    """Members of split buckets with every pair (p, q) of blocks that they are compared in.

    A bucket's largest component is not compared with itself: its members go once to each block of the others
    (usually one), and the others to each block of it and of each other."""
    sizes = opened.groupBy("key", "comp").agg(F.count("*").alias("n"))
    per_key = sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("held"))
    per_key = per_key.select("key", F.col("top.comp").alias("top"), F.ceil(F.col("top.n") / _BLOCK).cast("int").alias("n_top"),
                             F.ceil((F.col("held") - F.col("top.n")) / _BLOCK).cast("int").alias("n_rest"))
    rows = opened.drop("held").join(per_key, "key").withColumn("in_top", F.col("comp") == F.col("top"))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("in_top"), F.col("n_top")).otherwise(F.col("n_rest"))).cast("int")
    rows = rows.withColumn("block", F.when(F.col("in_top"), F.col("n_rest") + own).otherwise(own))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    pair = lambda p, q: F.struct(p.alias("p"), q.alias("q"))
    with_rest = F.transform(upto("n_rest"), lambda i: pair(F.least(F.col("block"), i), F.greatest(F.col("block"), i)))
    with_top = F.transform(upto("n_top"), lambda j: pair(F.col("block"), F.col("n_rest") + j))
    rows = rows.withColumn("pair", F.explode(F.when(F.col("in_top"), with_rest).otherwise(F.concat(with_rest, with_top))))
    return rows.select("key", "pair.p", "pair.q", "band", "pivot", "block", "rep", "comp")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, miss: float = MISS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id, kept."""
    percent, needed = round(100 * threshold), least_matches(threshold, miss)
    docs = id_text(docs, id_col, text_col)
    rows = checkpoint(sketch(docs, size))
    full = rows.where("doc_id is not null and n_shingles > 0")
    classes = checkpoint(full.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.min("sig").alias("sig")))
    texts = docs.where("doc_id is not null")

    members = full.select("doc_id", "f1", "f2").join(classes.select("f1", "f2", "rep"), ["f1", "f2"]).select("doc_id", "rep")
    members = checkpoint(members.distinct())
    # ids that stand in several rows: their classes are one document
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    labels = None
    if not several.isEmpty():
        labels = components(members.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).where("a <> b"))

    bands = classes.select("rep", F.posexplode(_band_keys(F.col("sig"))).alias("band", "key"))
    buckets = checkpoint(bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last"), F.count("*").alias("held")).where("pivot <> last"))
    star = bands.join(buckets.select("key", "pivot"), "key").where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    labels = _link(checkpoint(_survivors(star, classes, needed, threshold)), labels, texts, size, percent)
    del star
    forget(docs.sparkSession)
    if labels is None:
        labels = members.select(F.col("rep").alias("v"), F.col("rep").alias("c")).distinct()

    larger = buckets.where("held > 2")
    inside = bands.join(larger.select("key", "pivot", "held"), "key").join(labels.select(F.col("v").alias("rep"), "c"), "rep", "left")
    inside = checkpoint(inside.select("key", "band", "pivot", "held", "rep", F.coalesce("c", "rep").alias("comp")))
    split = inside.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    opened = checkpoint(inside.join(split.select("key"), "key"))
    del bands, buckets, larger, inside, split
    forget(docs.sparkSession)
    if not opened.isEmpty():
        few = opened.select(F.col("rep").alias("doc_id")).distinct()
        members_of = (texts.join(F.broadcast(few), "doc_id", "left_semi") if few.count() <= 2 * SMALL_PAIRS
                      else texts).select(F.col("doc_id").alias("rep"), "text")
        blocks = _block_pairs(opened)
        full_rows = blocks.join(classes.select("rep", "n", "sig"), "rep").join(members_of, "rep")
        links = checkpoint(full_rows.groupBy("key", "p", "q").applyInPandas(_cross_links(needed, threshold, size, percent), "a long, b long").distinct())
        del few, members_of, blocks, full_rows
        if not links.isEmpty():
            labels = _joined(labels, links)
        del links
    del opened, classes
    forget(docs.sparkSession)

    named = members.join(labels.select(F.col("v").alias("rep"), "c"), "rep", "left").select("doc_id", F.coalesce("c", "rep").alias("c"))
    named = checkpoint(named.groupBy("doc_id").agg(F.min("c").alias("component_id")))
    out = rows.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
