"""Approximate neighbours by locality-sensitive hashing, as an operator of its own.

``BucketedRandomProjectionLSH`` deals rows into buckets of width ``bucket_length`` along random
directions, one direction a hash table.  A query is compared with the points that share a bucket with
it in any table, so a true neighbour is missed if no table has it in the query's bucket: more tables and
wider buckets find more and compare more.  It never stands in for :func:`tessera.ml.knn.knn`, which is exact.

A bucket is split into blocks of bounded size that meet pairwise, so one that holds a third of all rows
is many tasks; each pair of blocks gives its k best only, and no bucket is expanded into rows for its pairs.
Blocks are as large as knn's tiles, since a row is shuffled once for each block of the other side.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.ml.knn import POINT_BLOCK, POINT_TILE, QUERY_BLOCK, QUERY_TILE, _best_of_block, _first, vector_parts


def _split(keyed: DataFrame, id_col: str, sizes: DataFrame, mine: str, other: str, block: int, other_block: int) -> DataFrame:
    """Rows of one side with their block in the bucket, once for each block of the other side."""
    rows = keyed.join(sizes, ["table", "bucket"])
    blocks = lambda n, size: F.greatest(F.ceil(F.col(n) / size), F.lit(1)).cast("int")
    rows = rows.withColumn(f"{mine}_block", F.pmod(F.xxhash64(id_col), blocks(f"n_{mine}", block)).cast("int"))
    return rows.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), blocks(f"n_{other}", other_block) - 1))).drop("n_q", "n_p")


def lsh_neighbours(queries: DataFrame, points: DataFrame, id_col: str, cols: Sequence[str] | str, k: int, bucket_length: float, tables: int = 8,
                   seed: int = 0, exclude_self: bool = True, query_block: int = QUERY_BLOCK * QUERY_TILE, point_block: int = POINT_BLOCK * POINT_TILE) -> DataFrame:
    """(qid, pid, dist2, rank) like ``knn``, among the points that share a bucket; a query may get fewer than k rows."""
    vector = cols if isinstance(cols, str) else "__vector"
    parts = ["i", "x"] if isinstance(cols, str) else ["v"]

    def vectors(df: DataFrame, name: str) -> DataFrame:
        if not isinstance(cols, str):
            df = VectorAssembler(inputCols=list(cols), outputCol=vector).transform(df)
        return df.select(F.col(id_col).cast("long").alias(name), vector, *vector_parts(cols))

    q, p = vectors(queries, "qid"), vectors(points, "pid")
    model = BucketedRandomProjectionLSH(inputCol=vector, outputCol="__hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed).fit(p)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        hashed = model.transform(df).select(name, *parts, F.posexplode("__hashes").alias("table", "hash"))
        return hashed.select(name, *parts, "table", vector_to_array("hash")[0].cast("long").alias("bucket"))

    q, p = keyed(q, "qid"), keyed(p, "pid")
    sizes = (q.groupBy("table", "bucket").agg(F.count("*").alias("n_q")).join(p.groupBy("table", "bucket").agg(F.count("*").alias("n_p")), ["table", "bucket"]))
    left = _split(q, "qid", sizes, "q", "p", query_block, point_block)
    right = _split(p, "pid", sizes, "p", "q", point_block, query_block).select(
        "pid", *parts, *[F.col(c).alias(f"{c}_") for c in ("table", "bucket", "q_block", "p_block")])
    key = ["table", "bucket", "q_block", "p_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*[f"{c}_" for c in key])).applyInPandas(_best_of_block(k, exclude_self), "qid long, pid long, dist2 double")
    return _first(found.distinct(), k)
