"""The registered model queries on the smallest driver tables, and what must follow from their output."""
import os
import time

import pytest
from pyspark.sql import functions as F

from tessera.ml import evaluate as E
from tessera.plans import binding as B
from tessera.plans import queries as Q
from tessera.session import session_store

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def run(spark):
    """Each query's rows, computed once."""
    names = ("MODEL_ITER", "REPEAT_RUNS", "MICE_ITERATIONS", "GRID_ITER", "GRID_FOLDS")
    production = [getattr(Q, n) for n in names]
    for n, short in zip(names, (3, 2, 1, 2, 2)):   # what is computed from the fits does not depend on their length
        setattr(Q, n, short)
    session_store(spark, "models").clear()
    done = {}

    def rows(name):
        if name not in done:
            done[name] = Q.REGISTRY[name](spark, SF).collect()
        return done[name]

    yield rows
    for n, value in zip(names, production):
        setattr(Q, n, value)
    session_store(spark, "models").clear()


def test_production_parameters():
    assert (Q.MODEL_ITER, Q.REPEAT_RUNS, Q.MICE_ITERATIONS, Q.GRID_FOLDS, Q.GRID_ITER) == (100, 5, 5, 6, 20)


def test_mice_fills_the_labelled_master(spark, run):
    rows = run("ml_mice")
    master = {r.report_id: r for r in Q.rounded(Q._labelled_master(spark, SF)).collect()}
    assert len(rows) == len(master)
    for r in rows:
        assert all(v is not None for v in r)
        for c in r.__fields__:
            if master[r.report_id][c] is not None:
                assert r[c] == pytest.approx(master[r.report_id][c])


def test_scored_rows_are_the_stratified_test_set(spark, run):
    rows = run("ml_boosted_fit")
    split = {r.report_id: r.final_result for r in Q.REGISTRY["ml_split_stratified"](spark, SF).where("is_test").collect()}
    truth = {r.report_id: r.truth for r in rows}
    counts = lambda values: {v: list(values).count(v) for v in set(values)}
    assert counts(truth.values()) == counts(split.values())                  # as many of each class, by another seed
    final = {r.report_id: r.final_result for r in Q._labelled_master(spark, SF).collect()}
    assert all(final[i] == t for i, t in truth.items())
    assert all(0 <= r.p_pass <= 1 and r.prediction == (E.POS if r.p_pass > Q.MODEL_THRESHOLD else E.NEG) for r in rows if r.p_pass != Q.MODEL_THRESHOLD)


def test_metrics_follow_from_the_scored_rows(run):
    scored = run("ml_boosted_fit")
    one = next(r for r in run("ml_pipeline_run") if r.features == "all")
    assert one.accuracy == pytest.approx(sum(r.truth == r.prediction for r in scored) / len(scored), abs=1e-6)
    for metric, label in (("npass_precision", E.NEG), ("pass_precision", E.POS)):
        said = [r for r in scored if r.prediction == label]
        assert one[metric] == pytest.approx(sum(r.truth == label for r in said) / len(said) if said else 1.0, abs=1e-6)
    assert {r.features for r in run("ml_pipeline_run")} == set(Q.FEATURE_SETS)


def test_importances_are_of_every_slot_and_sum_to_one(spark, run):
    rows = run("ml_feature_importance")
    assert sum(r.score for r in rows) == pytest.approx(1, abs=1e-4) and len({r.feature for r in rows}) == len(rows)
    assert len(rows) == Q._frame(spark, SF)[1].size and "cert1" in {r.feature for r in rows} and any("=" in r.feature for r in rows)


def test_without_tests_drops_exactly_the_share_columns(spark, run):
    run("ml_pipeline_run")
    names = lambda s: {b[0] for b in Q._frame(spark, SF, s)[1].blocks}
    assert names("all") - names("without_tests") == set(B.TEST_SHARE_COLUMNS)


def test_repeats_and_fitted_sweep_average_the_runs(run):
    stats = {r.metric: r for r in run("ml_repeat_eval")}
    sweep = {round(r.threshold, 2): r for r in run("ml_threshold_sweep_fitted")}
    assert all(r.runs == 2 for r in stats.values()) and len(sweep) == 21 and all(r.runs == 2 for r in sweep.values())
    assert sweep[0.5].accuracy == pytest.approx(stats["accuracy"].mean, abs=1e-5)
    assert sweep[0.5].pass_precision == pytest.approx(stats["pass_precision"].mean, abs=1e-5)
    predicted = [sweep[t].n_pred_pass for t in sorted(sweep)]
    assert predicted == sorted(predicted, reverse=True) and predicted[-1] == 0


def test_search_and_comparison(run):
    grid = run("ml_grid_search")
    assert len(grid) == 4 and all(0.3 < r.cv_accuracy <= 1 for r in grid)
    compared = {r.model: r.cv_accuracy for r in run("ml_cv_compare")}
    assert compared["tuned"] == pytest.approx(max(r.cv_accuracy for r in grid)) and set(compared) == {"tuned", "untuned"}


def test_the_tuned_point_is_what_is_fitted(spark, run):
    run("ml_boosted_fit")
    _, best, _ = Q._grid(spark, SF)
    model = Q._model(spark, SF)
    assert model.getStepSize() == best["eta"] and model.getMaxDepth() == best["max_depth"] and model.getNumTrees == Q.MODEL_ITER


def test_tree_report_and_leaves(spark, run):
    reports = run("ml_decision_tree")
    assert {r.features for r in reports} == set(Q.FEATURE_SETS)
    leaves = run("ml_tree_rules")
    train, slots = Q._parts(spark, SF)[0], Q._frame(spark, SF)[1]
    assert sum(r.n_rows for r in leaves) == train.count()
    passed = sum(r.n_rows * r.pass_share for r in leaves)
    assert passed == pytest.approx(train.where("label = 1").count(), abs=0.01 * len(leaves))
    assert all(r.rule for r in leaves) and max(r.rule.count(" AND ") for r in leaves) < 10


def test_lsh_neighbours_of_the_embeddings(spark, run):
    exact = {}
    points = Q._embeddings(spark, SF)
    from tessera.ml.knn import knn
    for r in knn(points.where(Q._minority()), points, "vec_id", Q.EMB_COLS, Q.ADASYN_K).collect():
        exact.setdefault(r.qid, set()).add(r.pid)
    found = {}
    for r in run("ml_lsh_neighbours"):
        found.setdefault(r.qid, set()).add(r.pid)
    assert sum(len(exact[q] & found.get(q, set())) for q in exact) >= 0.9 * sum(map(len, exact.values()))


def test_what_overlapping_fits_share_is_built_once(spark):
    built = []

    def build():
        time.sleep(0.2)
        built.append(1)
        return len(built)

    try:
        assert Q._overlapped(lambda n: Q._shared(spark, "slow", build) + n, [(0,), (1,), (2,)]) == [1, 2, 3] and built == [1]
    finally:
        for key in ("slow", ("lock", "slow")):
            session_store(spark, "models").pop(key, None)
