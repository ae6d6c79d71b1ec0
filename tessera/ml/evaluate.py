"""Evaluation algebra over (truth, probability / prediction) tables.

Every metric is one conditional aggregate over the scored rows (one pass,
partial aggregation, no collect).  The threshold sweep scores once and
buckets each row by how many thresholds its probability exceeds, so the
sweep costs one aggregate into at most (len(thresholds)+1) x 2 groups,
instead of one refit -- or one copy of the data -- per threshold.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NEG, POS = "!pass", "pass"
# Fixed value: probabilities are clipped to [eps, 1 - eps] (float64 machine epsilon).
LOG_LOSS_EPS = 2.220446049250313e-16
# Fixed value: the reference sweeps thresholds 0.00, 0.05, ..., 1.00.
SWEEP_THRESHOLDS = [i / 100 for i in range(0, 105, 5)]


def predict_threshold(df: DataFrame, prob: str, threshold: float, out: str = "prediction") -> DataFrame:
    """P(pass) strictly above the threshold -> ``pass``; else ``!pass``."""
    return df.withColumn(out, threshold_label(F.col(prob), threshold))


def threshold_label(p: Column, threshold: float | Column) -> Column:
    t = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    return F.when(p > t, F.lit(POS)).otherwise(F.lit(NEG))


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def confusion_cells(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """One row: c00 (!pass,!pass), c01 (!pass,pass), c10 (pass,!pass), c11."""
    t, p = F.col(truth), F.col(pred)
    return df.agg(_cnt((t == NEG) & (p == NEG)).alias("c00"), _cnt((t == NEG) & (p == POS)).alias("c01"),
                  _cnt((t == POS) & (p == NEG)).alias("c10"), _cnt((t == POS) & (p == POS)).alias("c11"))


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """2x2 matrix as rows (truth, predicted, n); absent cells are 0."""
    cells = confusion_cells(df, truth, pred)
    return cells.selectExpr(
        f"stack(4, '{NEG}', '{NEG}', c00, '{NEG}', '{POS}', c01, '{POS}', '{NEG}', c10, '{POS}', '{POS}', c11)"
        " as (truth, predicted, n)")


def _precision_pair_cols(c00: Column, c01: Column, c10: Column, c11: Column) -> list[Column]:
    n = (c00 + c01 + c10 + c11).cast("double")
    den_neg, den_pos = c00 + c10, c01 + c11
    return [
        ((c00 + c11).cast("double") / n).alias("accuracy"),
        F.when(den_neg > 0, c00.cast("double") / den_neg.cast("double")).otherwise(F.lit(1.0)).alias("npass_precision"),
        F.when(den_pos > 0, c11.cast("double") / den_pos.cast("double")).otherwise(F.lit(1.0)).alias("pass_precision"),
    ]


def precision_pair(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Accuracy and the two class precisions; a class never predicted has
    precision 1 (the reference's confusion-matrix rule)."""
    cells = confusion_cells(df, truth, pred)
    return cells.select(*_precision_pair_cols(F.col("c00"), F.col("c01"), F.col("c10"), F.col("c11")))


def classification_report(df: DataFrame, truth: str, pred: str,
                          classes: Sequence[str] = (NEG, POS)) -> DataFrame:
    """Per-class precision / recall / F1 / support, then accuracy, macro and
    weighted averages.  Zero division gives 0 (the report's rule)."""
    t, p = F.col(truth), F.col(pred)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(classes):
        aggs += [_cnt((t == c) & (p == c)).alias(f"tp{i}"), _cnt(p == c).alias(f"pp{i}"),
                 _cnt(t == c).alias(f"sup{i}")]
    a = df.agg(*aggs)

    def safe(num: Column, den: Column) -> Column:
        return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))

    per = []
    for i, c in enumerate(classes):
        prec = safe(F.col(f"tp{i}"), F.col(f"pp{i}"))
        rec = safe(F.col(f"tp{i}"), F.col(f"sup{i}"))
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
        per.append((F.lit(c), prec, rec, f1, F.col(f"sup{i}")))
    k = float(len(classes))
    n = F.col("n").cast("double")
    acc = sum((F.col(f"tp{i}") for i in range(len(classes))), F.lit(0)).cast("double") / n
    macro = [sum((r[j] for r in per), F.lit(0.0)) / F.lit(k) for j in (1, 2, 3)]
    weighted = [sum((r[j] * r[4].cast("double") for r in per), F.lit(0.0)) / n for j in (1, 2, 3)]
    rows = per + [(F.lit("accuracy"), F.lit(None).cast("double"), F.lit(None).cast("double"), acc, F.col("n")),
                  (F.lit("macro avg"), *macro, F.col("n")),
                  (F.lit("weighted avg"), *weighted, F.col("n"))]
    structs = F.array(*[F.struct(r[0].alias("label"), r[1].alias("precision"), r[2].alias("recall"),
                                 r[3].alias("f1"), r[4].cast("long").alias("support")) for r in rows])
    return a.select(F.inline(structs))


def prob_of_truth(truth: Column, p_pass: Column) -> Column:
    pc = F.least(F.greatest(p_pass, F.lit(LOG_LOSS_EPS)), F.lit(1.0 - LOG_LOSS_EPS))
    return F.when(truth == POS, pc).otherwise(F.lit(1.0) - pc)


def log_loss(df: DataFrame, truth: str, prob: str) -> DataFrame:
    """-mean ln p(true class), probabilities clipped to [eps, 1-eps]."""
    return df.agg((-F.avg(F.log(prob_of_truth(F.col(truth), F.col(prob))))).alias("log_loss"),
                  F.count(F.lit(1)).alias("n"))


def threshold_sweep(df: DataFrame, truth: str, prob: str,
                    thresholds: Sequence[float] = SWEEP_THRESHOLDS) -> DataFrame:
    """Accuracy and class precisions for every threshold, from one aggregate.

    Row bucket m = number of thresholds strictly below p; with ascending
    thresholds, "p > t_i" is exactly "m > i".
    """
    ts = sorted(float(t) for t in thresholds)
    tarr = F.array(*[F.lit(t) for t in ts])
    m = F.size(F.filter(tarr, lambda t: F.col(prob) > t))
    buckets = (df.select(m.alias("m"), F.col(truth).alias("truth"))
               .groupBy("m").agg(_cnt(F.col("truth") == POS).alias("npos"),
                                 _cnt(F.col("truth") == NEG).alias("nneg")))
    idx = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(ts)])
    grid = buckets.select("m", "npos", "nneg", F.explode(idx).alias("g")).select("m", "npos", "nneg", "g.*")
    above = F.col("m") > F.col("i")
    cells = grid.groupBy("i", "threshold").agg(
        F.sum(F.when(~above, F.col("nneg")).otherwise(0)).cast("long").alias("c00"),
        F.sum(F.when(above, F.col("nneg")).otherwise(0)).cast("long").alias("c01"),
        F.sum(F.when(~above, F.col("npos")).otherwise(0)).cast("long").alias("c10"),
        F.sum(F.when(above, F.col("npos")).otherwise(0)).cast("long").alias("c11"))
    return cells.select("threshold", (F.col("c01") + F.col("c11")).alias("n_pred_pass"),
                        *_precision_pair_cols(F.col("c00"), F.col("c01"), F.col("c10"), F.col("c11")))


def metrics_by_run(df: DataFrame, run: str, truth: str, prob: str, threshold: float) -> DataFrame:
    """Per run: accuracy, !pass precision, pass precision and log loss."""
    t = F.col(truth)
    pred = threshold_label(F.col(prob), threshold)
    g = df.groupBy(run).agg(
        _cnt((t == NEG) & (pred == NEG)).alias("c00"), _cnt((t == NEG) & (pred == POS)).alias("c01"),
        _cnt((t == POS) & (pred == NEG)).alias("c10"), _cnt((t == POS) & (pred == POS)).alias("c11"),
        (-F.avg(F.log(prob_of_truth(t, F.col(prob))))).alias("log_loss"))
    return g.select(run, *_precision_pair_cols(F.col("c00"), F.col("c01"), F.col("c10"), F.col("c11")), "log_loss")


RUN_METRICS = ("accuracy", "npass_precision", "pass_precision", "log_loss")


def run_stats(metrics: DataFrame, cols: Sequence[str] = RUN_METRICS) -> DataFrame:
    """Mean and sample standard deviation of each metric over runs."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__sd")]
    a = metrics.agg(F.count(F.lit(1)).alias("runs"), *aggs)
    structs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"{c}__mean").alias("mean"),
                                 F.col(f"{c}__sd").alias("sd"), F.col("runs").alias("runs")) for c in cols])
    return a.select(F.inline(structs))


def histogram(spark: SparkSession, df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram (last bin closed), all ``bins`` rows.

    Two scalars (min, max) reach the driver; binning is one aggregate.
    min == max widens the range by 0.5 on each side, like numpy.
    """
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, n long")
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = hi - lo
    b = F.least(F.floor((F.col(col) - F.lit(lo)) * F.lit(bins / width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width / bins)).alias("lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width / bins)).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
            .orderBy("bin"))
