"""run() against a brute-force pipeline over the smallest tables."""
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import toxicity
from tessera.llm.queries import MIX_SEED, MIX_WEIGHTS, TOXIC_FROM

from .test_mixing_toxicity_pii import _poisson, _uniform
from .test_near_dedup import _brute
from .test_text_operators import _brute_hits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_run_matches_brute_force(spark, docs, bpe):
    scored = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    rows = [(r.doc_id, r.text, r.source) for r in scored if r.score < TOXIC_FROM]
    kept = {d for d, _, _, k in _brute([(d, t) for d, t, _ in rows]) if k}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if r[0] in kept and _brute_hits(r[1], items)[1] == 0]
    counts = Counter(s for _, _, s in rows)
    share = sum(MIX_WEIGHTS[s] for s in counts)
    library = Tokenizer.from_file(bpe)
    want = Counter()
    for d, t, s in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        for _ in range(_poisson(_uniform(MIX_SEED, d, 1), MIX_WEIGHTS[s] / share * len(rows) / counts[s])):
            want.update((d, i // 1024, tuple(ids[i:i + 1024])) for i in range(0, len(ids), 1024))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert Counter((r.doc_id, r.seq_no, tuple(np.frombuffer(r.record, "<u2")[:r.n_tokens].tolist())) for r in got) == want


def test_stages_keep_columns_and_take_awkward_rows(spark, docs, make_docs, awkward):
    passed = make_docs(awkward).select("doc_id", "text", F.lit(None).cast("string").alias("lang"), "source", F.lit(None).cast("long").alias("n_chars"))
    empty = passed.limit(0)
    assert passed.columns == docs.columns
    for frame in (passed, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns, name
            rows = out.collect()
            assert not rows or {(r.doc_id, r.text) for r in rows} <= set(awkward)
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() >= 0


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "training_order"]


def test_stages_keep_columns_named_as_the_operators_own(spark, docs):
    own = docs.limit(60).withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in ("copy", "copies", "shuffle_key", "toxicity_score", "score")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, own, SF)
        assert out.columns == own.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in own.columns[len(docs.columns):]), name
