import math

import numpy as np
from pyspark.sql import functions as F

from tessera.ml import evaluate as E


def scored(spark, rows):
    return spark.createDataFrame(rows, "truth string, p double")


def test_precision_rules_q15(spark):
    df = E.predict_threshold(scored(spark, [("pass", 0.9), ("!pass", 0.8)]), "p", 0.5)
    pair = E.precision_pair(df, "truth", "prediction").first()
    assert pair.npass_precision == 1.0 and pair.pass_precision == 0.5       # nothing predicted !pass -> 1
    rep = {r.label: r for r in E.classification_report(df, "truth", "prediction").collect()}
    assert rep["!pass"].precision == 0.0                                     # the report uses 0
    assert rep["accuracy"].f1 == 0.5 and rep["accuracy"].support == 2


def test_threshold_strict_q16(spark):
    df = E.predict_threshold(scored(spark, [("pass", 0.5), ("pass", 1.0)]), "p", 0.5)
    assert [r.prediction for r in df.collect()] == ["!pass", "pass"]
    df = E.predict_threshold(scored(spark, [("pass", 1.0)]), "p", 1.0)
    assert df.first().prediction == "!pass"


def test_sweep_monotone_and_matches_direct(spark):
    rng = np.random.default_rng(3)
    rows = [("pass" if rng.random() < 0.6 else "!pass", float(p)) for p in rng.random(300)] + [("pass", 0.05)]
    df = scored(spark, rows)
    sweep = sorted(E.threshold_sweep(df, "truth", "p").collect(), key=lambda r: r.threshold)
    assert len(sweep) == 21
    counts = [r.n_pred_pass for r in sweep]
    assert counts == sorted(counts, reverse=True) and counts[-1] == 0
    for r in sweep:
        direct = E.precision_pair(E.predict_threshold(df, "p", r.threshold), "truth", "prediction").first()
        assert math.isclose(direct.accuracy, r.accuracy)
        assert math.isclose(direct.pass_precision, r.pass_precision)


def test_log_loss_and_confusion(spark):
    rows = [("pass", 0.9), ("!pass", 0.2), ("pass", 0.0), ("!pass", 1.0)]
    df = scored(spark, rows)
    eps = E.LOG_LOSS_EPS
    want = -np.mean([math.log(0.9), math.log(0.8), math.log(eps), math.log(eps)])
    assert math.isclose(E.log_loss(df, "truth", "p").first().log_loss, want, rel_tol=1e-12)
    cm = {(r.truth, r.predicted): r.n for r in E.confusion(E.predict_threshold(df, "p", 0.5), "truth", "prediction").collect()}
    assert cm == {("!pass", "!pass"): 1, ("!pass", "pass"): 1, ("pass", "!pass"): 1, ("pass", "pass"): 1}


def test_run_stats_sample_sd(spark):
    m = spark.createDataFrame([(1.0, 0.5, 0.5, 0.1), (0.0, 0.5, 0.7, 0.3)],
                              "accuracy double, npass_precision double, pass_precision double, log_loss double")
    st = {r.metric: r for r in E.run_stats(m).collect()}
    assert st["accuracy"].mean == 0.5 and math.isclose(st["accuracy"].sd, math.sqrt(0.5))
    h = E.histogram(spark, m, "accuracy", 50).collect()
    assert len(h) == 50 and sum(r.n for r in h) == 2 and h[-1].n == 1          # last bin closed
