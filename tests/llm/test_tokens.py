import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import queries
from tessera.llm import token_counts as C
from tessera.llm import tokens
from tessera.llm import training_order as O

TEXTS = ["", "a", "a  b", "a\n\nb", " x", "x ", "  ", "don't 're 'l 'll", "a <|endoftext|> b<|endoftext|>", "日本語 テキスト 1２3 ½", "x" * 300,
         "ab" * 200 + " c", "a \n b\t\tc   d  e  f", "'s 's''s", " 'll", "<|endoftext|", "é" * 90, "\x1c\x1d a\x85b", "one two\nthree four, five."]


@pytest.fixture(scope="module")
def library(bpe):
    return Tokenizer.from_file(bpe)


def _library_ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_every_prefix_count_as_the_library_gives_them(bpe, library, text):
    mine = tokens.load(bpe)
    assert mine.ids(text) == _library_ids(library, text)
    assert mine.prefix_counts(text).tolist() == [len(_library_ids(library, text[:k])) for k in range(1, len(text) + 1)]


def test_random_texts(bpe, library):
    rng = random.Random(5)
    parts = ["the", "Then", "'s", "'", " ", "  ", "\n", "12", "½", "é", "ñandú", "!!", "<|endoftext|>", "\t", "日", "x" * 60]
    for _ in range(60):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        counts = tokens.load(bpe).prefix_counts(text)
        assert counts.tolist() == [len(_library_ids(library, text[:k])) for k in range(1, len(text) + 1)], text


def test_token_count_rows(make_docs, awkward, bpe, library):
    rows = C.prefix_token_counts(make_docs(awkward), bpe, budgets=(5,)).collect()
    assert len(rows) == len(awkward)
    want = sorted((-1 if d is None else d, len((t or "").encode()), len(_library_ids(library, t or ""))) for d, t in awkward)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
    by_size = {r.n_bytes: r for r in rows}
    for _, text in awkward:
        text, row = text or "", by_size[len((text or "").encode())]
        counts = C.unpack_counts(row.prefix_counts)
        assert len(counts) == len(text) and (not text or counts[-1] == row.n_tokens)
        if 0 < len(text) < 600:
            assert len(_library_ids(library, text[:row.fit[0]])) <= 5
            assert all(len(_library_ids(library, text[:k])) > 5 for k in range(row.fit[0] + 1, len(text) + 1))


def test_stored_counts_answer_questions_in_columns(make_docs, bpe, library):
    from pyspark.sql import functions as F

    text = "Shall we count  the tokens of this sentence?"
    got = C.prefix_token_counts(make_docs([(1, text)]), bpe)
    row = got.select(C.tokens_of_prefix(F.col("prefix_counts"), F.lit(17)).alias("n"), C.prefix_within(F.col("prefix_counts"), F.lit(4)).alias("k")).first()
    assert row.n == len(_library_ids(library, text[:17])) and len(_library_ids(library, text[:row.k])) <= 4


def test_counts_of_empty_table(make_docs, bpe):
    assert C.prefix_token_counts(make_docs([]), bpe).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_feistel_is_a_keyed_permutation(n):
    order = O.FeistelPermutation(n, 99)
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.numbers(slots).tolist() == list(range(n))
    if n > 100:
        assert (slots != O.FeistelPermutation(n, 100).slots(np.arange(n))).mean() > 0.9


def test_training_order_round_trip(spark, make_docs, awkward, bpe, library, tmp_path):
    stride = 8
    docs = make_docs(awkward).repartition(3)
    ordered = O.training_order(docs, bpe, key=7, sequence_tokens=16, stride=stride)
    O.write_shards(ordered, str(tmp_path / "shards"))
    rows = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(r.shard == r.slot // stride and r.row == r.slot % stride and len(r.record) == 32 for r in rows)
    texts = sorted(tuple(_library_ids(library, t)) for _, t in awkward if t)
    numbers = O.FeistelPermutation(len(rows), 7).numbers([r.slot for r in rows])
    got, current = [], []
    for _, r in sorted(zip(numbers.tolist(), rows), key=lambda x: x[0]):  # numbers follow the documents
        if r.seq_no == 0 and current:
            got.append(tuple(current))
            current = []
        current += np.frombuffer(r.record, "<u2")[:r.n_tokens].tolist()
        assert not any(np.frombuffer(r.record, "<u2")[r.n_tokens:])
    assert sorted(got + [tuple(current)]) == texts
    # resume in the middle, across shards
    part = O.read_slots(spark, str(tmp_path / "shards"), 13, 10, stride).collect()
    assert [r.slot for r in part] == list(range(13, 23))
    payloads = O.shard_payloads(O.training_order(docs, bpe, key=7, sequence_tokens=16, stride=stride)).collect()
    assert sum(p.n_records for p in payloads) == len(rows) and all(len(p.payload) == 32 * p.n_records for p in payloads)


def test_stride_files_are_read_by_arithmetic(spark, make_docs, awkward, bpe, tmp_path):
    stride, width = 8, 32
    ordered = O.training_order(make_docs(awkward).repartition(3), bpe, key=7, sequence_tokens=16, stride=stride)
    O.write_stride_files(ordered, str(tmp_path / "f"))
    want = {r.slot: bytes(r.record) for r in ordered.collect()}
    places = spark.read.parquet(str(tmp_path / "f/places")).collect()
    assert sorted(p.slot for p in places) == sorted(want) and all(p.shard == p.slot // stride and p.row == p.slot % stride for p in places)
    for shard in range(-(-len(want) // stride)):  # any reader can do it: one file a shard, fixed strides
        file, = (tmp_path / f"f/records/shard={shard}").glob("part-*")
        raw = file.read_bytes()
        assert len(raw) % (width + 1) == 0
        assert all(raw[r * (width + 1):r * (width + 1) + width] == want[shard * stride + r] for r in range(len(raw) // (width + 1)))
    for start, count in ((0, 5), (13, 10), (len(want) - 3, 50), (len(want) + 9, 4)):
        got = {r.slot: bytes(r.record) for r in O.read_stride_files(spark, str(tmp_path / "f"), start, count, width, stride).collect()}
        assert got == {s: r for s, r in want.items() if start <= s < start + count}


def test_registered_order_holds_every_token(spark, library):
    """The registered query's rows: slots without gaps, and records whose tokens are the documents'."""
    sf = "/root/testdata/sf0.001"
    got = queries.op4_training_order(spark, sf)
    assert got.columns == ["slot", "shard", "row", "doc_id", "seq_no", "n_tokens", "record_sha256"]
    rows = got.collect()
    want = Counter()
    for d, t in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = _library_ids(library, t or "")
        for i in range(0, len(ids), O.SEQUENCE_TOKENS):
            part = ids[i:i + O.SEQUENCE_TOKENS]
            record = np.array(part, "<u2").tobytes().ljust(2 * O.SEQUENCE_TOKENS, b"\0")
            want[d, i // O.SEQUENCE_TOKENS, len(part), hashlib.sha256(record).hexdigest()] += 1
    assert Counter((r.doc_id, r.seq_no, r.n_tokens, r.record_sha256) for r in rows) == want
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and all(r.shard == r.slot // O.STRIDE and r.row == r.slot % O.STRIDE for r in rows)


def test_registered_counts_are_the_librarys(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op6_token_counts(spark, sf)
    assert got.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    for r in got.collect():
        n = len(_library_ids(library, texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
        assert r.stored_bytes > 1 and len(_library_ids(library, texts[r.doc_id][:r.chars_within_limit])) <= 1024


def test_training_order_of_nothing(make_docs, bpe):
    assert O.training_order(make_docs([]), bpe, 1).collect() == []
    assert O.training_order(make_docs([(1, None), (2, "")]), bpe, 1).collect() == []
