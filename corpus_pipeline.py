"""A corpus pipeline from the training-data operators.

Each stage is a function (spark, docs, sf_dir) -> DataFrame whose result is
written and read again as the next one's docs.  All but the last return the
columns of documents.  Stages keep every column of a row they keep; rows with
null columns, empty texts and repeated rows pass through as each operator
defines them.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, mixing, near_dedup, toxicity, training_order
from tessera.llm.common import ensure_checkpoint_dir, table
from tessera.llm.queries import BYTE_BPE, MIX_SEED, MIX_WEIGHTS, ORDER_KEY, TOXIC_FROM


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; the model is trained on the labelled ones among them."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "toxicity_score")
    return toxicity.score(docs, model, into=score).where(F.col(score) < TOXIC_FROM).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near duplicates; rows with a null id stay."""
    dropped = near_dedup.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights of their sources, in a global random order."""
    names = {c: free_name(docs, f"kept_{c}") for c in docs.columns if c in mixing.ADDED}  # the operator's own names
    mixed = mixing.mix(docs.withColumnsRenamed(names), MIX_WEIGHTS, MIX_SEED, null_ids="row")
    return mixed.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def materialise_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, as fixed-stride records."""
    return training_order.training_order(docs, BYTE_BPE, ORDER_KEY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("training_order", materialise_order),
]

#: Model scores and token ids have no SQL form; tests hold run() against a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
