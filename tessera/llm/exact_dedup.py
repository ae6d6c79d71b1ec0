"""Exact dedup by deterministic block naming (DataFrame operations only).

Every text is cut into fixed-size blocks of bytes.  Distinct blocks are sorted
into integer names; then adjacent pairs of names are sorted into names of their
own, and so on until each document has one name.  Documents that end on the same
level with the same name have equal texts, and no others do.

Blocks are compared in full exactly once: a distinct-aggregate over (key, block)
proves that each 128-bit key stands for one block (if not, the next salt is
tried), after which rows travel with keys instead of text.  Names of a level are
numbered by sorting within ranges of the key, so no task sees all of them.
Aggregates combine before they shuffle, and names come back over joins whose two
sides are plain shuffles, so a block or pair that a third of all documents share
is combined early and its partition can be split at run time.

Rows with a null text count as the empty text.  Of equal texts the row with the
largest id stays (null ids are smallest; of repeated rows with that id one row
stays).  Very long texts only add levels (the logarithm of their blocks).  An
empty table gives an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, id_text

BLOCK_BYTES = 1024


def block_key(block: Column, salt: int) -> Column:
    """128 bits that stand for a block."""
    return F.struct(F.xxhash64(F.lit(2 * salt), block).alias("k1"), F.xxhash64(F.lit(2 * salt + 1), block).alias("k2"))


def _blocks(raw: Column, size: int) -> Column:
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(raw) / size).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * size + 1, F.lit(size)))


def _numbered(distinct: DataFrame, a: str, b: str, spread: Column) -> DataFrame:
    """Distinct pairs (a, b) sorted into positive integer names: 4096 ranges of `spread`, sorted each."""
    in_range = Window.partitionBy("range").orderBy(a, b)
    return (distinct.withColumn("range", F.shiftrightunsigned(spread, 52))
            .withColumn("name", F.row_number().over(in_range) * F.lit(4096).cast("long") + F.col("range"))
            .drop("range"))


def name_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
               key: Callable[[Column, int], Column] = block_key, salts: int = 8) -> DataFrame:
    """One row for each document: rid (row number), doc_id, text_sha256, level and name; two texts are equal exactly
    if level and name are."""
    rows = id_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    rows = rows.withColumn("blocks", _blocks(F.col("raw"), block_bytes))
    for salt in range(salts):
        keys = checkpoint(rows.select(F.explode("blocks").alias("block")).select(key(F.col("block"), salt).alias("k"), "block")
                          .select("k.k1", "k.k2", "block").distinct()
                          .groupBy("k1", "k2").agg(F.count("*").alias("n")))
        if keys.where("n > 1").isEmpty():
            break
    else:
        raise ValueError(f"{salts} salts gave one key to different blocks")
    named = _numbered(keys.select("k1", "k2"), "k1", "k2", F.col("k1"))
    base = checkpoint(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.sha2("raw", 256).alias("text_sha256"),
                                  F.transform("blocks", lambda b: key(b, salt)).alias("keys")))
    spread = base.select("rid", F.size("keys").alias("n"), F.posexplode("keys").alias("i", "k")).select("rid", "n", "i", "k.k1", "k.k2")
    current = spread.join(named, ["k1", "k2"]).select("rid", "n", "i", "name")
    longest = base.agg(F.max(F.size("keys"))).first()[0] or 1
    done = []
    level = 0
    while True:
        done.append(current.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        if longest <= 1 << level:
            break
        pairs = checkpoint(current.where("n > 1").groupBy("rid", (F.col("i") / 2).cast("int").alias("j"), ((F.col("n") + 1) / 2).cast("int").alias("m"))
                           .agg(F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
                                F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(0)).alias("b")))
        named = _numbered(pairs.select("a", "b").distinct(), "a", "b", F.xxhash64("a", "b"))
        current = pairs.join(named, ["a", "b"]).select("rid", F.col("m").alias("n"), F.col("j").alias("i"), "name")
        level += 1
    names = done[0]
    for more in done[1:]:
        names = names.unionByName(more)
    return base.select("rid", "doc_id", "text_sha256").join(names, "rid")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = checkpoint(name_texts(docs, id_col, text_col, **options))
    groups = checkpoint(rows.groupBy("level", "name").agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size")))
    return (rows.join(groups, ["level", "name"])
            .select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256"))
