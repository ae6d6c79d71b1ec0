"""Mixing sources to target weights by Poisson replication (DataFrame operations only).

A source with n of the N weighted documents and share w of the target gets the
mean repetition rate w N / n.  Each document draws its number of copies by
inverting the Poisson distribution of that mean at a uniform number hashed from
its id, is exploded into that many copies, and all copies are ordered globally
by a hash: a range shuffle, sorted inside.  The draw depends on nothing but the
seed and the id, so it is the same for any partitioning, and a lost task gives
the same copies again.  The hot source needs no special care: no key is ever
grouped with its rows.

Rates are counted by one small aggregate (one row a weighted source comes back);
the distribution tables, as many as there are weights, are a bounded broadcast.
Means above 256 are drawn as sums of smaller ones, which is exact.

Defined cases: sources without a weight, and null sources, keep the mean rate 1;
weights of absent sources are spread over the present ones; null ids draw like the
text "null", all alike (so they are copied or dropped as one lump), or with
`null_ids="row"` from a hash of all columns of their row, at their source's rate, as
the registered query and the pipeline do; repeated rows draw the same number of copies each and their
copies are equal; empty and null texts are copied like any other; an empty table
gives an empty result; all columns of the input are kept, those named copy,
copies or shuffle_key are replaced.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LARGEST_MEAN = 256.0


def poisson_table(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... until it no longer grows."""
    term = total = math.exp(-mean)
    table = [total]
    while len(table) <= mean or total + term > total:
        term *= mean / len(table)
        total += term
        table.append(total)
    return table


def uniform(*parts: Column) -> Column:
    """52 hashed bits of the parts as a number from 0 to 1 (1 left out)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(16 ** 13))


def source_rates(docs: DataFrame, weights: dict[str, float], source_col: str = "source") -> dict[str, float]:
    """Mean repetition rate of each weighted source that is present."""
    listed = docs.where(docs[source_col].isin(list(weights))).groupBy(docs[source_col].alias("source")).count()
    counts = {r["source"]: r["count"] for r in listed.collect()}
    total, share = sum(counts.values()), sum(weights[s] for s in counts)
    return {s: weights[s] / share * total / n for s, n in counts.items()} if share > 0 else {}


#: Columns that mixing adds.
ADDED = ("copy", "copies", "shuffle_key")


def with_copies(docs: DataFrame, weights: dict[str, float], seed: int, id_col: str = "doc_id", source_col: str = "source",
                null_ids: str = "together") -> DataFrame:
    """`docs` with the drawn number of copies (0 too) as a column `copies`."""
    tables = []
    for source, mean in sorted(source_rates(docs, weights, source_col).items()):
        parts = max(1, math.ceil(mean / LARGEST_MEAN))
        tables.append((source, parts, poisson_table(mean / parts)))
    schema = T.StructType([T.StructField("__mix_source", T.StringType()), T.StructField("__mix_parts", T.IntegerType()),
                           T.StructField("__mix_table", T.ArrayType(T.DoubleType()))])
    means = F.broadcast(docs.sparkSession.createDataFrame(tables, schema))  # one row a weight
    docs = docs.select(*(docs[c] for c in docs.columns if c != "copies"))
    names = list(docs.columns)
    other = F.concat(F.lit("null:"), F.md5(F.to_json(F.struct(*(docs[c] for c in names))).cast("binary")))
    doc = F.coalesce(docs[id_col].cast("string"), other if null_ids == "row" else F.lit("null"))
    joined = docs.withColumn("__mix_doc", doc).join(means, docs[source_col] == means["__mix_source"], "left")
    table = F.coalesce("__mix_table", F.array(*map(F.lit, poisson_table(1.0))))
    draw = lambda part: F.size(F.filter(table, lambda p: p <= uniform(F.lit(str(seed)), F.col("__mix_doc"), part.cast("string"))))
    copies = F.aggregate(F.sequence(F.lit(1), F.coalesce("__mix_parts", F.lit(1))), F.lit(0), lambda n, part: n + draw(part))
    return joined.withColumn("copies", copies).select(*names, "copies", "__mix_doc")


def mix(docs: DataFrame, weights: dict[str, float], seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
        null_ids: str = "together") -> DataFrame:
    """Copies of the documents in their global order: all columns of `docs`, and copy (from 1), copies, shuffle_key."""
    docs = docs.select(*(docs[c] for c in docs.columns if c not in ADDED))
    drawn = with_copies(docs, weights, seed, id_col, source_col, null_ids).where("copies > 0")
    rows = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), "__mix_doc", F.col("copy").cast("string")).cast("binary")), 1, 15), 16, 10)
    rows = rows.withColumn("shuffle_key", key.cast("long")).drop("__mix_doc")
    return rows.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")
