"""The pivot index: exact with any pivots, and fewer block pairs on clustered rows; LSH recall and hot buckets."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.ml import knn as KN
from tessera.ml import lsh as LS
from tessera.ml.knn import knn
from tessera.ml.lsh import lsh_neighbours
from tessera.ml.onehot import sparse_frame


def clustered(spark, n=1200, d=6, centres=12, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d)) * 4
    x = middle[np.arange(n) % centres] + spread * rng.normal(size=(n, d))
    cols = [f"x{j}" for j in range(d)]
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols)), x, cols


def brute(x, k, ids=None):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    return {i: list(np.lexsort((np.arange(len(x)), d[i]))[:k]) for i in (range(len(x)) if ids is None else ids)}


def by_query(found):
    out = {}
    for r in found.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append(r.pid)
    return out


def test_clustered_rows_form_few_block_pairs(spark):
    df, x, cols = clustered(spark)
    stats = {}
    got = by_query(knn(df, df, "id", cols, 5, query_block=60, point_block=50, stats=stats))
    assert got == brute(x, 5)
    assert stats["pairs"] < stats["all_pairs"] / 2


@pytest.mark.parametrize("kind", ["uniform", "same", "few"])
def test_exact_without_clusters(spark, kind):
    rng = np.random.default_rng(3)
    x = {"uniform": rng.random((300, 4)), "same": np.ones((300, 4)), "few": rng.integers(0, 2, (300, 4)).astype(float)}[kind]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double, d double")
    stats = {}
    assert by_query(knn(df, df, "id", ["a", "b", "c", "d"], 7, query_block=40, point_block=37, stats=stats)) == brute(x, 7)
    assert stats["pairs"] <= stats["all_pairs"]


def test_queries_of_their_own_and_too_few_points(spark):
    df, x, cols = clustered(spark, n=240, centres=4)
    some = df.where("id % 10 = 0")
    assert by_query(knn(some, df, "id", cols, 3, query_block=8, point_block=30)) == brute(x, 3, range(0, 240, 10))
    few = df.where("id < 3")
    assert {len(v) for v in by_query(knn(df, few, "id", cols, 5, point_block=2)).values()} == {2, 3}


def test_pruned_search_on_sparse_vectors(spark):
    df = spark.range(400).select("id", F.concat(F.lit("c"), F.col("id") % 8).alias("c"), (F.col("id") % 8 * 50 + F.rand(1)).alias("x"))
    frame, _ = sparse_frame(df, ["x"], ["c"])
    stats = {}
    pruned = by_query(knn(frame, frame, "id", "features", 4, query_block=40, point_block=40, stats=stats))
    assert pruned == by_query(knn(frame, frame, "id", "features", 4)) and stats["pairs"] < stats["all_pairs"]


def recall(spark, df, x, cols, **kw):
    want, got = brute(x, 5), by_query(lsh_neighbours(df, df, "id", cols, 5, **kw))
    return sum(len(set(got.get(i, [])) & set(w)) for i, w in want.items()) / (5 * len(want))


def test_lsh_recall_is_at_least_nine_tenths(spark):
    df, x, cols = clustered(spark, n=900, spread=0.4)
    assert recall(spark, df, x, cols, bucket_length=1.5, tables=6) >= 0.9


def test_lsh_splits_a_hot_bucket_into_blocks(spark):
    x = np.vstack([np.zeros((300, 3)), np.random.default_rng(1).normal(size=(200, 3)) * 9])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double")
    whole = by_query(lsh_neighbours(df, df, "id", ["a", "b", "c"], 4, 1.0, 3))
    split = by_query(lsh_neighbours(df, df, "id", ["a", "b", "c"], 4, 1.0, 3, query_block=32, point_block=25))
    assert whole == split and all(len(whole[i]) == 4 for i in range(300))


def test_few_distances_are_computed_term_by_term(monkeypatch):
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"qid": np.arange(700), "pid": np.arange(700), "v": list(1e6 + rng.random((700, 16)))})
    exact, pairs = KN._Pair.exact, []
    monkeypatch.setattr(KN._Pair, "exact", lambda self, at, to: pairs.append(len(at)) or exact(self, at, to))
    got = KN._best_of_block(5, True)(rows, rows)
    want = KN.sq_distances(rows, rows)
    np.fill_diagonal(want, np.inf)
    best = np.argsort(want, axis=1, kind="stable")[:, :5]
    assert (got["pid"].to_numpy().reshape(700, 5) == best).all()
    assert (got["dist2"].to_numpy() == np.take_along_axis(want, best, 1).ravel()).all()  # to the bit
    assert 700 * 5 <= sum(pairs) < 700 * 10


@pytest.mark.parametrize("value", [float("nan"), float("inf"), None])
def test_a_row_without_a_distance_does_not_hide_its_block(spark, value):
    df, x, cols = clustered(spark, n=240, centres=4)
    odd = df.where("id % 60 = 7").select((F.col("id") + 1000).alias("id"), F.lit(value).cast("double").alias(cols[0]), *cols[1:])
    assert by_query(knn(df, df.unionByName(odd), "id", cols, 3, query_block=30, point_block=20)) == brute(x, 3)


def test_lsh_sends_a_row_once_for_a_bucket_of_thousands(spark, monkeypatch):
    df = spark.range(1500).select("id", (F.col("id") % 7 / 100).alias("a"), F.lit(0.0).alias("b"))
    real, sent = LS._split, []
    monkeypatch.setattr(LS, "_split", lambda *args: sent.append(real(*args)) or sent[-1])
    assert lsh_neighbours(df, df, "id", ["a", "b"], 3, 100.0, 1).count() == 4500
    buckets = sent[1].select("table", "bucket").distinct().count()
    assert [s.count() for s in sent] == [1500, 1500] and buckets <= 2


def test_many_blocks_are_held_in_few_tasks(spark):
    df, x, cols = clustered(spark, n=600)
    points = df.select(F.col("id").alias("pid"), *KN.vector_parts(cols))
    blocked = KN._blocked(points, "pid", KN.choose_pivots(points), 200)
    assert blocked.rdd.getNumPartitions() <= max(200 // KN.BLOCKS_PER_TASK, spark.sparkContext.defaultParallelism)
    sizes = {r["block"]: r["count"] for r in blocked.groupBy("block").count().collect()}
    assert sum(sizes.values()) == 600 and len(sizes) > 150 and max(sizes) < 200  # blocks stay what they were


def test_the_two_searches_of_adasyn_overlap(spark, monkeypatch):
    import threading

    from tessera.ml import adasyn as AD

    both = threading.Barrier(2, timeout=60)  # breaks when one search waits for the other

    def search(*args, **kw):
        both.wait()
        return knn(*args, **kw)

    monkeypatch.setattr(AD, "knn", search)
    rows = [(i, float(i % 7), float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    assert AD.adasyn_samples(df, "id", ["a", "b"], F.col("id") < 10, 3).count() > 0


def test_few_blocks_are_cut_into_tiles_for_all_cores(spark):
    tile, tasks = KN._tiling(54, 27, 12, 8)  # 27 000 queries, 108 000 points
    assert tile < KN.POINT_TILE and tasks >= 12 * KN.TILES_PER_CORE
    assert KN._tiling(4096, 4096, 12, 200) == (KN.POINT_TILE, 200)      # many tiles keep their size
    assert KN._tiling(1, 1, 12, 200) == (1, 1)
    df, _, cols = clustered(spark)
    q = df.select(F.col("id").alias("qid"), *KN.vector_parts(cols), (F.col("id") % 40).cast("int").alias("block"))
    p = df.select(F.col("id").alias("pid"), *KN.vector_parts(cols), (F.col("id") % 24).cast("int").alias("block"))
    pairs = spark.range(40 * 24).selectExpr("cast(id % 40 as int) AS qb", "cast(id div 40 as int) AS pb")
    tasks = KN._tiling(40, 24, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))[1]
    plan = KN._search(pairs, q, p, ["v"], 5, True, 40, 24)._jdf.queryExecution().optimizedPlan().toString()
    assert tasks > 1 and plan.count(f", {tasks}") >= 2  # both sides are dealt over as many tasks
