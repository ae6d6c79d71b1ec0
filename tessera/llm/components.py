"""Connected components of a distributed edge list."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, forget

#: Rounds that name by the id itself; stars, whatever their centre, are gone after them.
_BY_ID = 2


def components(edges: DataFrame) -> DataFrame:
    """(v, c): every vertex of the edges (a, b) with the smallest vertex of its component.

    Contraction: each vertex takes the first of itself and its neighbours as its name, edges are
    renamed, and those whose ends now agree are dropped.  A vertex stays connected with its name by
    the renamed edges, so the rest has the same components.  The first rounds order vertices by id,
    the others by a hash of their own, under which a constant share of the vertices of any graph
    (a long chain of rising ids, too) is expected to go in each round.  Each round's names are joined to
    those found so far.  Nothing is collected per vertex or to the driver but a flag for each round,
    and what a round no longer needs is dropped before the next."""
    spark = edges.sparkSession
    rest = checkpoint(edges.select("a", "b").union(edges.select("b", "a")).toDF("v", "w").where("v <> w").distinct())
    labels, turn = None, 0
    while True:
        order = lambda v: F.struct((F.col(v) if turn < _BY_ID else F.xxhash64(v, F.lit(turn))).alias("key"), F.col(v).alias("v"))  # noqa: B023, E731
        names = checkpoint(rest.groupBy("v").agg(F.min(order("w")).alias("first")).select("v", _least("first", order("v")).alias("c")))
        if labels is None:
            labels = names
        else:
            labels = checkpoint(labels.join(names.select(F.col("v").alias("c"), F.col("c").alias("to")), "c", "left").select("v", F.coalesce("to", "c").alias("c")))
        renamed = rest.join(names, "v").select(F.col("c").alias("a"), "w").join(names.select(F.col("v").alias("w"), F.col("c").alias("b")), "w")
        rest = checkpoint(renamed.where("a <> b").select(F.col("a").alias("v"), F.col("b").alias("w")).distinct())
        del names, renamed
        forget(spark)
        turn += 1
        if rest.isEmpty():
            break
    if turn > _BY_ID:  # names by hash: to the smallest vertex
        smallest = labels.groupBy("c").agg(F.min("v").alias("smallest"))
        labels = checkpoint(labels.join(smallest, "c").select("v", F.col("smallest").alias("c")))
    return labels


def _least(first: str, own: Column) -> Column:
    """The vertex of the lesser of two (key, vertex) structs."""
    return F.least(F.col(first), own)["v"]
