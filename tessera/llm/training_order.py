"""Training-order materialisation of token ids.

Documents are tokenized and cut into sequences of a fixed number of tokens (the
last one of a document is padded).  Sequences are numbered 0 .. N-1, and a keyed
Feistel permutation with cycle-walking gives each number a global slot of the
same range: a random order that any reader can recompute, and invert, from the
key alone.  Slots are dealt by range: shard s holds the slots from s * stride
on, in order, as records of equal width, so slot -> (shard, row, byte offset) is
arithmetic, reads are sequential, and a reader resumes at any slot.

Token ids are written once, compressed, to the checkpoint folder, which also
cuts the lineage; numbering needs only a count for each task.  The shuffle is by
shard number, all shards are of the same size, and no key of the data deals rows.

Defined cases: a null or empty text gives no sequence; a null id stays null;
repeated rows give sequences each; without sequences the result is empty; other
columns of the input are ignored.  Numbers follow the order of the input's
partitions; any numbering gives a permutation of the same records.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import checkpoint, id_text

SEQUENCE_TOKENS = 1024
STRIDE = 4096
_ROUNDS = 6


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class FeistelPermutation:
    """A keyed permutation of 0 .. n-1.

    A balanced network permutes the smallest even-bit range that holds n; numbers
    that fall outside 0 .. n-1 walk on through the permutation until they fall
    inside, which keeps it one to one."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = _mixed(np.arange(1, _ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 64)))

    def _once(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys[::-1] if inverse else self.keys:
            if inverse:
                left, right = right ^ (_mixed(left ^ k) & self.mask), left
            else:
                left, right = right, left ^ (_mixed(right ^ k) & self.mask)
        return (left << self.half) | right

    def _walk(self, numbers, inverse: bool) -> np.ndarray:
        out = self._once(np.asarray(numbers, np.uint64), inverse)
        while (outside := np.flatnonzero(out >= self.n)).size:
            out[outside] = self._once(out[outside], inverse)
        return out.astype(np.int64)

    def slots(self, numbers) -> np.ndarray:
        return self._walk(numbers, False)

    def numbers(self, slots) -> np.ndarray:
        return self._walk(slots, True)


def _tokenized(docs: DataFrame, tokenizer: str, width: str, sequence_tokens: int) -> DataFrame:
    """(task, first, doc_id, n_tokens, ids): `first` numbers a document's first sequence within its task."""
    schema = pa.schema([("task", pa.int32()), ("first", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, first = tokens.load(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array(bpe.ids(text or ""), width)
                if len(ids):
                    rows.append((task, first, doc, len(ids), zstandard.compress(ids.tobytes(), 1)))
                    first += -(-len(ids) // sequence_tokens)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return docs.mapInArrow(run, "task int, first long, doc_id long, n_tokens long, ids binary")


def training_order(docs: DataFrame, tokenizer: str, key: int, sequence_tokens: int = SEQUENCE_TOKENS, stride: int = STRIDE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sequences in training order, one partition for each shard: slot, shard, row, doc_id, seq_no, n_tokens, record.

    A record is sequence_tokens little-endian ids (two bytes each, four for large vocabularies), zeros after n_tokens."""
    width = "<u2" if tokens.load(tokenizer).vocab_size <= 1 << 16 else "<u4"
    staged = checkpoint(_tokenized(id_text(docs, id_col, text_col), tokenizer, width, sequence_tokens))
    per_task = (staged.groupBy("task").agg(F.max(F.col("first") + F.ceil(F.col("n_tokens") / sequence_tokens)).alias("n"))
                .orderBy("task").collect())  # one row a task
    ends = np.cumsum([r.n for r in per_task])
    total = int(ends[-1]) if len(ends) else 0
    base = {r.task: int(end - r.n) for r, end in zip(per_task, ends)}
    shards = max(1, -(-total // stride))
    schema = pa.schema([("slot", pa.int64()), ("shard", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("seq_no", pa.int64()),
                        ("n_tokens", pa.int64()), ("record", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = FeistelPermutation(total, key)
        bytes_each = sequence_tokens * np.dtype(width).itemsize
        for batch in batches:
            rows = []
            for task, first, doc, n, packed in zip(*(c.to_pylist() for c in batch.columns)):
                raw = zstandard.decompress(packed)
                for i in range(0, n, sequence_tokens):
                    at = i * np.dtype(width).itemsize
                    rows.append((base[task] + first + i // sequence_tokens, doc, i // sequence_tokens, min(sequence_tokens, n - i),
                                 raw[at:at + bytes_each].ljust(bytes_each, b"\0")))
            slots = order.slots([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array((slots // stride).astype(np.int32)), pa.array(slots % stride),
                                              *(pa.array([r[i] for r in rows], f.type) for i, f in zip(range(1, 5), list(schema)[3:]))], schema=schema)

    ordered = staged.mapInArrow(cut, "slot long, shard int, row long, doc_id long, seq_no long, n_tokens long, record binary")
    return ordered.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")


def write_shards(ordered: DataFrame, path: str) -> None:
    """One Parquet file for each shard under path/shard=<number>, records in slot order."""
    ordered.write.partitionBy("shard").parquet(path)


def read_slots(spark: SparkSession, path: str, start: int, count: int | None = None, stride: int = STRIDE) -> DataFrame:
    """The records from slot `start` on, in order; opens only the shards that hold them."""
    rows = spark.read.parquet(path).where((F.col("shard") >= start // stride) & (F.col("slot") >= start))
    if count is not None:
        rows = rows.where((F.col("shard") <= (start + count - 1) // stride) & (F.col("slot") < start + count))
    return rows.orderBy("slot")


def shard_payloads(ordered: DataFrame) -> DataFrame:
    """Each shard as one binary value, record after record (row r of a shard stands at byte r * record width):
    shard, n_records, payload.  `ordered` is what training_order returns."""
    schema = pa.schema([("shard", pa.int32()), ("n_records", pa.int64()), ("payload", pa.binary())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in batches:
            for number, record in zip(batch.column("shard").to_pylist(), batch.column("record").to_pylist()):
                if number != shard and parts:
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, len(parts), b"".join(parts)), schema)], schema=schema)
                    parts = []
                shard = number
                parts.append(record)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, len(parts), b"".join(parts)), schema)], schema=schema)

    return ordered.select("shard", "record").mapInArrow(join, "shard int, n_records long, payload binary")


def write_stride_files(ordered: DataFrame, path: str) -> None:
    """One plain file for each shard under path/records/shard=<number>: records one after the other, a line end after each, so
    row r of a shard stands at byte r * (record width + 1); and the records' places (slot, shard, row, doc_id, seq_no, n_tokens)
    as a table under path/places.  `ordered` is what training_order returns."""
    by_place = ordered.sortWithinPartitions("shard", "slot")  # the write's own sort by shard would not keep the order of slots
    by_place.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").text(f"{path}/records")
    ordered.drop("record").write.parquet(f"{path}/places")


def read_stride_files(spark: SparkSession, path: str, start: int, count: int, width: int, stride: int = STRIDE) -> DataFrame:
    """(slot, record) of `count` slots from `start` on, cut from the shard files by arithmetic alone; opens only the shards that hold them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select("shard", "content")
    files = files.where((F.col("shard") >= start // stride) & (F.col("shard") <= (start + count - 1) // stride))
    first = F.greatest(F.lit(start) - F.col("shard") * stride, F.lit(0))
    last = F.least(F.lit(start + count) - F.col("shard") * stride, F.octet_length("content") / (width + 1)).cast("long") - 1
    rows = files.where(first <= last).select("shard", "content", F.explode(F.sequence(first.cast("long"), last)).alias("row"))
    return rows.select((F.col("shard") * stride + F.col("row")).alias("slot"),
                       F.substring("content", (F.col("row") * (width + 1) + 1).cast("int"), F.lit(width)).alias("record"))
