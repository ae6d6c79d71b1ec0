"""Toxicity scores from a factorization machine over hashed terms.

Terms are the lower-cased words of a text and their first letters (so inflected
and compounded forms share weight), hashed; a term's value grows with its count
up to three.  A factorization machine gives a document a linear score plus the
products of the term factors, so combinations (an insult with its target, an
insult in a long or in a short text) weigh differently from their parts.

Training reads a bounded sample: the `max_rows` labelled rows with the smallest
hash of their id (all of them if there are fewer).  Their terms are counted in
Spark; terms in fewer than `min_rows` of the rows, or whose toxic share is within
`min_surprise` standard errors of the sample's, get no weight.  The rows come to
the driver as the few term ids that are left, and the fitted weights go to the
tasks; both are bounded by the sample.  Scoring is a map over whole texts: no
shuffle.

Labels are read only for training rows; labels, language, source and id are
never inputs of a score.

Defined cases: a null or empty text has no terms and scores like any text
without known terms; rows with a null id are scored but never trained on;
repeated rows are scored each (a repeated id trains with each of its rows); null
labels are not trained on; without any labelled row of both classes every score
is the share of toxic labels (0 without labels); other columns of the input are
ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import checkpoint, id_text

_WORDS = re.compile(r"[^\W\d_]+")
_SPACE = 1 << 22
_PREFIXES = (3, 5, 7)
_LENGTH_TERMS = 32
_CACHED = 200_000
SAMPLE_ROWS = 12_000


def _terms(word: str) -> list[int]:
    """Hashed terms of a word; the lowest ids are kept for text lengths."""
    names = {"w" + word, *("p" + word[:n] for n in _PREFIXES if len(word) >= n)}
    return sorted({_LENGTH_TERMS + xxhash.xxh3_64_intdigest(t) % (_SPACE - _LENGTH_TERMS) for t in names})


class _Terms(dict):
    """int32 term ids of a word as bytes; `known` translates hashed ids to model rows."""

    def __init__(self, known: np.ndarray | None = None):
        super().__init__()
        self.known = known

    def lookup(self, ids) -> np.ndarray:
        ids = np.asarray(ids, np.int32)
        if self.known is None:
            return ids
        at = np.minimum(np.searchsorted(self.known, ids), len(self.known) - 1)
        return at[self.known[at] == ids].astype(np.int32)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _CACHED:
            self.clear()
        got = self.lookup(_terms(word)).tobytes()
        if len(word) <= 48:
            self[word] = got
        return got

    def row(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct term ids of a text and their values."""
        words = _WORDS.findall((text or "").lower())
        ids = np.frombuffer(b"".join(map(self.__getitem__, words)), np.int32)
        ids, counts = np.unique(np.concatenate([ids, self.lookup([min(len(words).bit_length(), _LENGTH_TERMS - 1)])]), return_counts=True)
        return ids, np.log2(1 + np.minimum(counts, 3)).astype(np.float32) / 2


@dataclass
class FactorizationMachine:
    terms: np.ndarray    # hashed ids with weights, ascending
    bias: float
    weights: np.ndarray  # float32, one a term
    factors: np.ndarray  # float32, terms x k

    def raw(self, ids: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Scores before the logistic function, of rows that begin at `first` (none of them empty)."""
        scaled = self.factors[ids] * values[:, None]
        pairs = np.add.reduceat(scaled, first) ** 2 - np.add.reduceat(scaled * scaled, first)
        return self.bias + np.add.reduceat(self.weights[ids] * values, first) + pairs.sum(1) / 2


def fit(terms: np.ndarray, ends: np.ndarray, ids: np.ndarray, values: np.ndarray, labels: np.ndarray, rank: int = 4,
        steps: int = 1500, batch: int = 400, rate: float = 0.1, decay: float = 2e-4, seed: int = 11) -> FactorizationMachine:
    """Logistic loss by adaptive gradient steps over mini-batches.  Row i holds the term places
    ids[ends[i - 1]:ends[i]] (into `terms`) with their values."""
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1 or not len(ids):
        odds = float(np.log(share / (1 - share))) if 0 < share < 1 else np.inf if share else -np.inf
        return FactorizationMachine(np.zeros(1, np.int32), odds, np.zeros(1, np.float32), np.zeros((1, rank), np.float32))
    rng = np.random.default_rng(seed)
    model = FactorizationMachine(terms.astype(np.int32), float(np.log(share / (1 - share))), np.zeros(len(terms), np.float32),
                                 rng.normal(0, 0.02, (len(terms), rank)).astype(np.float32))
    begins = np.r_[0, ends[:-1]]
    steps_w, steps_v, step_b = np.full(len(terms), 1e-2), np.full((len(terms), rank), 1e-2), 1e-2
    filled = np.flatnonzero(ends > begins)
    done = 0
    while done < steps:
        order = rng.permutation(filled)
        for begin in range(0, len(order), batch):
            pace, done = rate * max(0.0, 1 - done / steps), done + 1
            part = order[begin:begin + batch]
            lengths = ends[part] - begins[part]
            first, row = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(part)), lengths)
            at = np.arange(len(row)) + np.repeat(begins[part] - first, lengths)
            x, place = values[at], ids[at]
            slope = 1 / (1 + np.exp(-np.clip(model.raw(place, x, first), -30, 30))) - labels[part]
            scaled = model.factors[place] * x[:, None]
            total = np.add.reduceat(scaled, first)
            push = slope[row] * x
            used, where = np.unique(place, return_inverse=True)
            g_w = np.bincount(where, push) / len(part) * 10 + decay * model.weights[used]
            g_v = np.stack([np.bincount(where, push * (total[row, k] - scaled[:, k])) for k in range(rank)], 1) / len(part) * 10 + decay * model.factors[used]
            steps_w[used] += g_w ** 2
            steps_v[used] += g_v ** 2
            model.weights[used] -= (pace * g_w / np.sqrt(steps_w[used])).astype(np.float32)
            model.factors[used] -= (pace / 4 * g_v / np.sqrt(steps_v[used])).astype(np.float32)
            step_b += slope.mean() ** 2
            model.bias -= pace * slope.mean() / np.sqrt(step_b)
    return model


def is_held_out(doc_id: Column) -> Column:
    """Rows that are never trained on: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_texts(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> DataFrame:
    """(text, label) of the sample: the labelled rows, not held out, with the smallest id hashes."""
    chosen = (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("doc_id")))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows))
    # at most max_rows pairs of (id, label): a proven bound for the broadcast
    return id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("text", "label")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, rows, toxic): the batch's rows with a term, and the toxic ones among them."""
    terms = _Terms()
    for batch in batches:
        rows = [terms.row(t)[0] for t in batch.column("text").to_pylist()]
        if rows:
            labels = np.repeat(batch.column("label").to_numpy(), list(map(len, rows)))
            seen, where, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
            toxic = np.bincount(where, labels).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"term": seen, "rows": counts, "toxic": toxic})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS, min_rows: int = 4, min_surprise: float = 3.0, **names) -> FactorizationMachine:
    """Counts the sample's terms in Spark, keeps those that tell the classes apart, and fits them on the driver."""
    sample = checkpoint(training_texts(docs, labels, max_rows, **names))
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = toxic / n if n else 0.0
    known = np.arange(_LENGTH_TERMS)
    if 0 < share < 1:
        counts = sample.mapInArrow(_term_counts, "term int, rows long, toxic long").groupBy("term").agg(F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic"))
        surprise = F.abs(F.col("toxic") - share * F.col("rows")) / F.sqrt(F.col("rows") * share * (1 - share))
        told = counts.where((F.col("rows") >= min_rows) & (surprise >= min_surprise)).select("term").toArrow()["term"].to_numpy()
        known = np.union1d(known, told)
    schema = pa.schema([("ids", pa.list_(pa.int32())), ("values", pa.list_(pa.float32())), ("label", pa.int32()), ("place", pa.int64())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms(known.astype(np.int32))
        for batch in batches:
            rows = [terms.row(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], schema[0].type), pa.array([r[1] for r in rows], schema[1].type),
                                              batch.column("label"), batch.column("place")], schema=schema)

    placed = sample.withColumn("place", F.xxhash64("text", "label"))
    rows = placed.mapInArrow(hashed, "ids array<int>, values array<float>, label int, place long").toArrow().sort_by("place").combine_chunks()
    if not rows.num_rows:
        return fit(known, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0))
    ids, values = (pa.concat_arrays(rows[c].chunks) for c in ("ids", "values"))
    ends = np.cumsum(np.diff(ids.offsets.to_numpy()))
    return fit(known, ends, ids.flatten().to_numpy(), values.flatten().to_numpy(), rows["label"].to_numpy().astype(float))


def score(docs: DataFrame, model: FactorizationMachine, text_col: str = "text", into: str = "score") -> DataFrame:
    """`docs` with the toxicity score (0 to 1) of its whole text as one more column, which replaces one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != into]
    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        terms = _Terms(model.terms)
        for batch in batches:
            rows = [terms.row(t) for t in batch.column("text").to_pylist()]
            out = np.full(len(rows), model.bias)
            full = np.flatnonzero([len(r[0]) for r in rows])
            if len(full):
                lengths = np.array([len(rows[i][0]) for i in full])
                out[full] = model.raw(np.concatenate([rows[i][0] for i in full]), np.concatenate([rows[i][1] for i in full]),
                                      np.cumsum(lengths) - lengths)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(1 / (1 + np.exp(-np.clip(out, -700, 700))))], names=["row", "score"])

    return rows.mapInArrow(run, schema).select("row.*", F.col("score").alias(into))
