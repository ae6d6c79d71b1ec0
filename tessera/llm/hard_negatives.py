"""Hard-negative mining with an STR-packed R-tree.

1. Packing.  Rows are cut into slabs by label, each slab by the coordinate that varies most, each
   of those by the next (sort-tile-recursive; the cuts are quantiles counted in Spark, and a hash of
   the id breaks ties, so that any number of equal vectors is cut as well).  Inside a tile a task
   goes on tiling until leaves of LEAF rows are left, and packs the tile: its rows, and the
   bounding box and labels of each leaf and of each node of FAN leaves.
2. Search.  The box of a node gives an interval for each coordinate's product with the query, and
   their sums bound the score of every row below it.  A queue takes nodes by their upper bound; a
   node is left out if its labels, its interval and the score windows rule it out, or if its upper
   bound is strictly below the k-th best score found in every window that it reaches (an equal one
   may hold a tie with a smaller id).
3. Two rounds over the tiles: each query first searches the tile with the highest upper bound; with
   the k-th scores found there, it goes only to the tiles that can still hold a result.  Queries meet
   the tiles' boxes in blocks, and a tile in blocks of queries, so neither is ever held whole.

Scores are exact integers: components are floor(scale * x), sums of products stay below 2^53 or
are taken in 64-bit integers.

Defined cases: rows with a null id, label or vector, or with a null, NaN or infinite component, or
one of 2^25 or more after scaling, take no part; vectors of different lengths are filled with zeros;
rows that repeat id, label and vector are one row, and rows with the anchor's id are never its
results; other rows with equal ids are rows each; an anchor without another row of its label has no
positives and gives no rows; a positive without a negative in its window gives none; an empty table
gives an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint

LEAF, FAN = 32, 32
#: Rows of a tile, tiles whose boxes a task holds, and queries that search a tile together.
TILE_ROWS, BOX_BLOCK, QUERY_BLOCK = 8192, 512, 256
_LEVELS = 3
_LARGEST = 1 << 25
_ANY = (-(1 << 62), 1 << 62)


# ---- rows -------------------------------------------------------------------
def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, v (array of long) of the rows that take part."""
    v = vectors
    x = F.transform(v[vector_col], lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    # NaN and infinity are not below the limit; a null makes the test null
    fit = F.forall(v[vector_col], lambda e: F.coalesce(F.abs(F.lit(float(scale)) * e.cast("double")) < float(_LARGEST), F.lit(False)))
    rows = v.select(v[id_col].cast("long").alias("vec_id"), v[label_col].cast("long").alias("label"), F.when(fit, x).alias("v"))
    return rows.where("vec_id is not null and label is not null and v is not null")


def _spread(rows: DataFrame, dims: int) -> list[int]:
    """Coordinates by falling variance (64-bit sums of a fixed number of columns come to the driver)."""
    if not dims:
        return []
    at = lambda i: F.coalesce(F.get("v", F.lit(i)), F.lit(0)).cast("double")
    found = rows.agg(*[F.var_pop(at(i)).alias(f"d{i}") for i in range(dims)]).first()
    return sorted(range(dims), key=lambda i: (-(found[i] or 0.0), i))


def tiled(rows: DataFrame, n: int, order: list[int], tile_rows: int) -> DataFrame:
    """Rows with the number of their tile: slabs by label, then by the coordinates that vary most."""
    tiles = math.ceil(n / tile_rows)
    out = rows.withColumn("tile", F.lit(0).cast("long"))
    levels = min(_LEVELS, 1 + len(order))
    slabs = max(1, math.ceil(tiles ** (1 / levels) - 1e-9))
    if slabs == 1:
        return out
    fractions = F.array(*[F.lit(i / slabs) for i in range(1, slabs)])
    for level in range(levels):
        # a fraction of 1 from the id orders equal values
        tie = F.pmod(F.xxhash64("vec_id", F.lit(level)), F.lit(1 << 20)) / float(1 << 20)
        value = F.col("label") if level == 0 else F.coalesce(F.get("v", F.lit(order[level - 1])), F.lit(0))
        out = out.withColumn("place", value.cast("double") + tie)
        quantiles = F.percentile_approx("place", fractions, F.lit(10_000)).alias("cuts")
        if level == 0:  # one tile still: its cuts are a few numbers
            out = out.withColumn("cuts", F.array(*[F.lit(c) for c in out.agg(quantiles).first()["cuts"]]))
        else:
            out = out.join(out.groupBy("tile").agg(quantiles), "tile")
        slab = F.aggregate("cuts", F.lit(0).cast("long"), lambda s, c: s + (F.col("place") > c).cast("long"))
        out = out.withColumn("tile", F.col("tile") * slabs + slab).drop("cuts", "place")
    return out


# ---- a packed tile ----------------------------------------------------------
def str_order(points: np.ndarray, ids: np.ndarray, labels: np.ndarray, order: list[int], leaf: int = LEAF) -> np.ndarray:
    """Row order whose runs of `leaf` rows are the leaves: each part of more than one leaf is halved
    (whole leaves on the left) by label, then by the next coordinate, and so on."""
    parts = [np.arange(len(points))]
    keys = [labels, *[points[:, d] for d in order]] or [labels]
    level = 0
    while any(len(p) > leaf for p in parts):
        key, out = keys[level % len(keys)], []
        for p in parts:
            leaves = -(-len(p) // leaf)
            if leaves == 1:
                out.append(p)
                continue
            p = p[np.lexsort((ids[p], key[p]))]
            cut = -(-leaves // 2) * leaf
            out += [p[:cut], p[cut:]]
        parts, level = out, level + 1
    return np.concatenate(parts)


def _boxes(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, len(values), size)
    return np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)


class Tile:
    """The nodes of one tile: rows in leaf order, and boxes of leaves and of nodes of FAN leaves.

    Only the last leaf is short, so leaves are found by position."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray):
        self.ids, self.labels, self.points = ids, labels, points.astype(np.float64)
        self.leaf_low, self.leaf_high = _boxes(self.points, LEAF)
        self.leaf_first, self.leaf_last = _boxes(labels, LEAF)
        (self.low, _), (_, self.high) = _boxes(self.leaf_low, FAN), _boxes(self.leaf_high, FAN)
        self.first, self.last = _boxes(labels, LEAF * FAN)
        self.largest = float(np.abs(self.points).max(initial=0.0))

    def search(self, query: np.ndarray, anchor: int, label: int, same: bool, windows: np.ndarray, least: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """The first k (score, id) of each window [low, high], scores under `least` left out; `same`: of the query's label, else of others."""
        up, down = np.maximum(query, 0.0), np.minimum(query, 0.0)
        least = np.maximum(least, windows[:, 0])
        best: list[list[tuple[int, int]]] = [[] for _ in windows]

        def reach(low, high, first, last):
            """Bounds of nodes, and whether labels and windows leave them in."""
            upper, lower = high @ up + low @ down, low @ up + high @ down
            fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            inside = (upper[:, None] >= least) & (lower[:, None] <= windows[:, 1])
            return upper, fits & inside.any(1)

        upper, ok = reach(self.low, self.high, self.first, self.last)
        queue = [(-upper[i], i) for i in np.flatnonzero(ok)]
        heapq.heapify(queue)
        wide = self.largest * float(np.abs(query).max(initial=0.0)) * len(query) >= 1 << 53
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least.min():
                break
            leaves = slice(node * FAN, (node + 1) * FAN)
            _, ok = reach(self.leaf_low[leaves], self.leaf_high[leaves], self.leaf_first[leaves], self.leaf_last[leaves])
            rows = (np.flatnonzero(ok)[:, None] * LEAF + np.arange(LEAF)).ravel() + node * FAN * LEAF
            rows = rows[rows < len(self.ids)]
            if not len(rows):
                continue
            points = self.points[rows]
            scores = points.astype(np.int64) @ query.astype(np.int64) if wide else (points @ query).astype(np.int64)
            mine = (self.labels[rows] == label) == same
            mine &= self.ids[rows] != anchor
            for w, (low, high) in enumerate(windows):
                hit = np.flatnonzero(mine & (scores >= least[w]) & (scores <= high))
                if not len(hit):
                    continue
                found = best[w] + [(-int(s), int(i)) for s, i in zip(scores[hit], self.ids[rows[hit]])] if len(hit) <= k else best[w] + _first(scores[hit], self.ids[rows[hit]], k)
                best[w] = sorted(found)[:k]
                if len(best[w]) == k:
                    least[w] = max(least[w], -best[w][-1][0])
        return [[(-s, i) for s, i in found] for found in best]


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    at = np.lexsort((ids, -scores))[:k]
    return [(-int(s), int(i)) for s, i in zip(scores[at], ids[at])]


_PACKED = ("tile long, n long, n_dims long, first long, last long, low binary, high binary, ids binary, labels binary, points binary")


def packed(rows: DataFrame, dims: int, order: list[int]) -> DataFrame:
    """One row a tile: its rows in leaf order, its box and labels."""

    def pack(held: pd.DataFrame) -> pd.DataFrame:
        points = np.zeros((len(held), dims), np.int64)
        for i, v in enumerate(held["v"]):
            points[i, :len(v)] = v
        ids, labels = held["vec_id"].to_numpy(np.int64), held["label"].to_numpy(np.int64)
        once = np.unique(np.column_stack([ids, labels, points]), axis=0)
        ids, labels, points = once[:, 0], once[:, 1], once[:, 2:]
        at = str_order(points, ids, labels, order)
        ids, labels, points = ids[at], labels[at], points[at].astype(np.int32)
        low, high = (points.min(0), points.max(0)) if dims else (np.zeros(0, np.int32),) * 2
        return pd.DataFrame([(held["tile"].iloc[0], len(ids), dims, labels.min(), labels.max(), low.astype("<i4").tobytes(), high.astype("<i4").tobytes(),
                              ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), points.astype("<i4").tobytes())],
                            columns=[c.split()[0] for c in _PACKED.split(", ")])

    return rows.groupBy("tile").applyInPandas(pack, _PACKED)


def _matrix(values: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<i4").reshape(len(values), dims).astype(np.float64)


def _vectors(column: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


# ---- two rounds of search ---------------------------------------------------
def _routes(queries: DataFrame, tiles: DataFrame, n_tiles: int, n_queries: int, dims: int, same: bool) -> DataFrame:
    """(qid, tile, upper) of the tiles that can hold results of a query, its `done` tile left out.

    Queries and boxes meet in blocks."""

    def meet(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": [], "tile": [], "upper": []}).astype({"qid": "int64", "tile": "int64", "upper": "float64"})
        if q.empty or t.empty:
            return empty
        vectors = _vectors(q["v"], dims)
        low, high = _matrix(t["low"].to_list(), dims), _matrix(t["high"].to_list(), dims)
        up, down = np.maximum(vectors, 0.0), np.minimum(vectors, 0.0)
        upper, lower = up @ high.T + down @ low.T, up @ low.T + down @ high.T
        label, first, last = q["label"].to_numpy()[:, None], t["first"].to_numpy(), t["last"].to_numpy()
        fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
        inside = np.zeros(fits.shape, bool)
        for i, (lows, highs) in enumerate(zip(q["least"], q["highs"])):
            inside[i] = ((upper[i][:, None] >= np.asarray(lows, float)) & (lower[i][:, None] <= np.asarray(highs, float))).any(1)
        at, to = np.nonzero(fits & inside & (t["tile"].to_numpy() != q["done"].to_numpy()[:, None]))
        return pd.DataFrame({"qid": q["qid"].to_numpy()[at], "tile": t["tile"].to_numpy()[to], "upper": upper[at, to]})

    box_blocks, query_blocks = max(1, math.ceil(n_tiles / BOX_BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))
    q = queries.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(query_blocks))).withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(box_blocks - 1))))
    t = tiles.select("tile", "first", "last", "low", "high", F.pmod(F.xxhash64("tile"), F.lit(box_blocks)).cast("int").alias("bb"))
    t = t.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))
    return q.groupBy("qb", "bb").cogroup(t.groupBy("qb", "bb")).applyInPandas(meet, "qid long, tile long, upper double")


def _visit(routes: DataFrame, queries: DataFrame, tiles: DataFrame, n_queries: int, dims: int, same: bool, k: int) -> DataFrame:
    """(qid, w, score, vec_id): the first k of each window that a routed tile holds."""

    def search(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        if len(q) and len(t):
            row = t.iloc[0]
            tile = Tile(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), np.frombuffer(row["points"], "<i4").reshape(row["n"], dims))
            for qid, anchor, label, vector, lows, highs, least in zip(q["qid"], q["anchor"], q["label"], _vectors(q["v"], dims), q["lows"], q["highs"], q["least"]):
                windows = np.column_stack([np.asarray(lows, np.int64), np.asarray(highs, np.int64)])
                for w, found in enumerate(tile.search(vector, anchor, label, same, windows, np.array(least, np.int64), k)):
                    out += [(qid, w, score, vec_id) for score, vec_id in found]
        return pd.DataFrame(out, columns=["qid", "w", "score", "vec_id"]).astype("int64")

    blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    routed = routes.select("qid", "tile").join(queries, "qid").withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(blocks)))
    wanted = routed.select(F.col("tile").alias("to"), F.col("qb").alias("block")).distinct()
    held = tiles.join(wanted, tiles["tile"] == wanted["to"]).select("tile", F.col("block").alias("qb"), "n", "ids", "labels", "points")
    return routed.groupBy("tile", "qb").cogroup(held.groupBy("tile", "qb")).applyInPandas(search, "qid long, w long, score long, vec_id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("qid", "w").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def search(queries: DataFrame, tiles: DataFrame, dims: int, same: bool, k: int) -> DataFrame:
    """(qid, w, rank, score, vec_id): the first k rows of each score window of each query.

    `queries`: qid, anchor, label, v, lows and highs (arrays of the windows' ends)."""
    n_queries, n_tiles = queries.count(), tiles.count()
    fresh = queries.withColumn("least", F.col("lows")).withColumn("done", F.lit(-1).cast("long"))
    routes = _routes(fresh, tiles, n_tiles, n_queries, dims, same)
    first = checkpoint(routes.groupBy("qid").agg(F.max_by("tile", F.struct("upper", -F.col("tile"))).alias("tile")))
    found = checkpoint(_visit(first, fresh, tiles, n_queries, dims, same, k))
    if n_tiles == 1:
        return _best(found, k)
    kth = found.groupBy("qid", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
    kth = kth.groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("kths"))
    known = queries.join(first.withColumnRenamed("tile", "done"), "qid").join(kth, "qid", "left")
    least = F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.element_at("kths", w.cast("long")), low)))
    known = checkpoint(known.withColumn("least", F.coalesce(least, F.col("lows"))).drop("kths"))
    rest = checkpoint(_routes(known, tiles, n_tiles, n_queries, dims, same))
    return _best(found.unionByName(_visit(rest, known, tiles, n_queries, dims, same, k)), k)


# ---- mining -----------------------------------------------------------------
def mine(vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256, label: Callable[[Column, Column], Column] | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", tile_rows: int = TILE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor` gets the id column; `label` gets id and label and gives the label to use.  A negative's score lies between
    `low` and `high` percent of the positive's; the bounds are compared as integers."""
    rows = quantised(vectors, scale, id_col, vector_col, label_col)
    if label is not None:
        rows = rows.withColumn("label", label(F.col("vec_id"), F.col("label")).cast("long")).where("label is not null")
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    dims = shape["dims"] or 0
    order = _spread(rows, dims)
    tiles = checkpoint(packed(tiled(rows, shape["n"], order, tile_rows), dims, order))

    anchors = rows.where(is_anchor(F.col("vec_id"))).dropDuplicates(["vec_id", "label", "v"])
    qid = F.xxhash64("vec_id", "label", "v")  # rows with equal ids are anchors each
    base = checkpoint(anchors.select(qid.alias("qid"), F.col("vec_id").alias("anchor"), "label", "v"))
    everything = base.withColumn("lows", F.array(F.lit(_ANY[0]))).withColumn("highs", F.array(F.lit(_ANY[1])))
    near = checkpoint(search(everything, tiles, dims, True, positives).select("qid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # equal positive scores share a window; scores are ordered, so windows are numbered by their place
    scores = near.groupBy("qid").agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))
    asked = base.join(scores, "qid").withColumn("lows", F.transform("scores", lambda p: -_hundredth(-p * low))).withColumn("highs", F.transform("scores", lambda p: _hundredth(p * high)))
    hard = search(asked.drop("scores"), tiles, dims, False, negatives)
    windows = scores.select("qid", F.posexplode("scores").alias("w", "positive_score"))
    hard = hard.join(windows.withColumn("w", F.col("w").cast("long")), ["qid", "w"]).select("qid", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = near.join(hard, ["qid", "positive_score"]).join(base.select("qid", "anchor"), "qid")
    return out.select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _hundredth(value: Column) -> Column:
    """The largest integer not above value / 100."""
    return F.call_function("div", value - F.pmod(value, F.lit(100).cast("long")), F.lit(100).cast("long"))
