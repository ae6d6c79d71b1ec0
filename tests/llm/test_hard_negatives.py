"""Hard negatives against brute force, over awkward rows and tiles small enough to prune."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import hard_negatives as H

SCHEMA = T.StructType([T.StructField("rank", T.StringType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("vec_id", T.LongType()), T.StructField("tile", T.StringType()), T.StructField("label", T.IntegerType())])


def brute(rows, every, positives, negatives, low, high):
    once = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    dims = max((len(v) for *_, v in once), default=0)
    once = [(i, lab, v + (0,) * (dims - len(v))) for i, lab, v in once]
    out = []
    for a, lab, v in once:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in once if i != a)
        for s, p, _ in [x for x in scored if x[2] == lab][:positives]:
            hard = [x for x in scored if x[2] != lab and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a, p, n + 1, x[1], -s, -x[0]) for n, x in enumerate(hard)]
    return sorted(out)


def mined(spark, rows, every, tile_rows, **kw):
    df = spark.createDataFrame([("r", v, i, "t", lab) for i, v, lab in rows], SCHEMA)
    got = H.mine(df, lambda i: i % every == 0, tile_rows=tile_rows, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(i, (centres[i % 6] + 0.2 * rng.normal(size=dims)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("tile_rows", [40, 8192])
def test_equals_brute_force(spark, tile_rows):
    rows = clustered(400, 6, 1)
    rows += [(1000 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], 2) for i in range(60)]           # equal vectors
    rows += [(20, [0.1] * 6, 1), (20, [0.1] * 6, 1), (40, [9.0] * 6, 3)]                   # repeated rows, equal ids
    rows += [(60, None, 1), (80, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0], 1), (81, [float("inf")] * 6, 0), (None, [1.0] * 6, 0), (82, [None] * 6, 1),
             (83, [1.0] * 6, None), (2000, [], 0), (2020, [0.3], 1), (2040, [-0.3] * 6, 9)]
    assert mined(spark, rows, 20, tile_rows) == brute(rows, 20, 5, 10, 30, 90)


def test_other_parameters(spark):
    rows = clustered(120, 3, 2)
    assert mined(spark, rows, 10, 30, positives=2, negatives=3, low=-50, high=120) == brute(rows, 10, 2, 3, -50, 120)


def test_empty_table(spark):
    assert mined(spark, [], 10, 100) == []
    assert mined(spark, [(10, [1.0], None)], 10, 100) == []


def test_boxes_bound_scores_and_prune():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(-20, 20, (2048, 4)) + c for c in rng.integers(-3000, 3000, (8, 4))]).astype(np.int64)
    ids, labels = np.arange(len(points)), np.zeros(len(points), np.int64)
    at = H.str_order(points, ids, labels, [0, 1, 2, 3])
    assert sorted(at) == list(range(len(points)))
    tile = H.Tile(ids[at], labels[at], points[at])
    query = points[5].astype(float)
    up, down = np.maximum(query, 0), np.minimum(query, 0)
    upper, lower = tile.leaf_high @ up + tile.leaf_low @ down, tile.leaf_low @ up + tile.leaf_high @ down
    scores = (tile.points @ query).reshape(-1, H.LEAF)
    assert (scores.max(1) <= upper).all() and (scores.min(1) >= lower).all()
    kth = np.sort(scores.ravel())[-5]
    assert (upper >= kth).sum() < len(upper) / 4          # most leaves are never scored
    best = tile.search(query, -1, 0, True, np.array([H._ANY]), np.array([H._ANY[0]]), 5)[0]
    assert [s for s, _ in best] == sorted(scores.ravel().astype(int).tolist())[::-1][:5]


def test_tiles_are_bounded_with_equal_vectors(spark):
    df = spark.range(2000).select(F.col("id").alias("vec_id"), F.lit(1).cast("long").alias("label"), F.array(F.lit(7).cast("long"), F.lit(7).cast("long")).alias("v"))
    sizes = [r["count"] for r in H.tiled(df, 2000, [0, 1], 250).groupBy("tile").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 2 * 250
