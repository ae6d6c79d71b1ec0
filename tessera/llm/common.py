"""Helpers shared by the training-data operators.

Every operator takes a DataFrame and the names of its id / text columns and
selects just those, under names of its own, so extra or clashing columns of
the input never matter.
"""
from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint, ensure_checkpoint_dir

__all__ = ["table", "id_text", "checkpoint", "ensure_checkpoint_dir", "forget", "tasks", "input_tasks",
           "ALNUM_LOWER", "WORD_BREAK_SQL", "ALNUM_BREAK_SQL", "segment_ids"]

#: Words of the "alphanumeric" kind are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F]
#: after A-Z were lower-cased: this byte table lower-cases A-Z and turns every
#: other ASCII non-alphanumeric byte into a space; bytes of multi-byte
#: characters stay, so it is safe on UTF-8.
ALNUM_LOWER = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)

#: The same two word classes as patterns for SQL oracles.
WORD_BREAK_SQL = r"[^\x20\x09-\x0D]+"
ALNUM_BREAK_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """The id (as long) and text (as string) columns under fixed names."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), *more)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_tasks(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def forget(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files (and, with spark.cleaner.referenceTracking.cleanCheckpoints, the
    checkpoints) of frames that nothing refers to any more; else they stay until the driver happens to
    collect its garbage, so that a job of many rounds would hold the files of all of them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def segment_ids(lengths: np.ndarray) -> np.ndarray:
    """0 repeated lengths[0] times, 1 repeated lengths[1] times, ..."""
    return np.repeat(np.arange(len(lengths)), lengths)
