import tempfile

from pyspark.sql import functions as F

from tessera.ml.prepare import dummies, dummy_table, impute_initial, label_encode, stratified_folds, stratified_split
from tessera.sources.columnar_json import read_columnar_json, write_columnar_json
from tessera.sources.stage import read_stage_table, write_table


def test_dummies_null_all_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, c string")
    assert sorted(map(tuple, dummy_table(df, ["c"]).collect())) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    frame, slots = dummies(df, ["c"])
    assert slots.blocks == (("c", 0, 2, True),)
    assert {r.id: r.dummies.toArray().tolist() for r in frame.collect()} == {1: [1, 0], 2: [0, 1], 3: [0, 0]}


def test_label_encode_sorted(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id long, c string")
    out = {r.id: r.c_code for r in label_encode(df, ["c"]).collect()}
    assert out == {1: 1.0, 2: 0.0, 3: 2.0}


def test_impute_initial_mode_tie_smallest_and_observed_kept(spark):
    df = spark.createDataFrame([(1, 1.0, "b"), (2, None, "a"), (3, 3.0, None), (4, None, "b"), (5, 5.0, "a")],
                               "id long, x double, s string")
    out, stats = impute_initial(df, ["x"], ["s"], with_masks=True)
    rows = {r.id: r for r in out.collect()}
    assert stats["s"] == "a" and rows[3].s == "a" and rows[2].x == 3.0
    assert rows[1].x == 1.0 and rows[1].s == "b" and rows[2].x__was_null and not rows[1].x__was_null


def test_folds_are_equal_in_each_class_and_independent_of_the_split(spark):
    df = spark.createDataFrame([(i, "a" if i % 5 else "b") for i in range(5000)], "rid long, y string")
    split = stratified_split(df, "rid", "y", 0.1, 3)
    train = split.where("not is_test")
    for frame in (train, train.repartition(5)):
        sizes = {(r.y, r.fold): r["count"] for r in stratified_folds(frame, ["rid"], "y", 6, 3).groupBy("y", "fold").count().collect()}
        assert len(sizes) == 12
        for y, n in (("a", 3600), ("b", 900)):
            assert all(abs(sizes[y, f] - n / 6) <= 1 for f in range(6))
    few = stratified_folds(df.limit(7), ["rid"], "y", 6, 3)
    assert few.where("fold is null or fold not between 0 and 5").count() == 0


def test_test_sets_of_different_seeds_overlap_like_independent_draws(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(15000)], "rid long, y string")
    tests = [{r.rid for r in stratified_split(df, "rid", "y", 0.1, s).where("is_test").collect()} for s in range(3)]
    for i in range(3):
        assert len(tests[i]) == 1500 and 100 < len(tests[i] & tests[i - 1]) < 200


def test_columnar_json_and_stage_round_trip(spark):
    df = spark.createDataFrame([(i, f"n{i}", float(i) / 3) for i in range(50)], "a long, b string, c double")
    path = tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp") + "/cj"
    write_columnar_json(df, path, ["a", "b", "c"], files=3)
    back = read_columnar_json(spark, path, ["0", "1", "2"], ["a", "b", "c"], ["long", "string", "double"])
    assert sorted(map(tuple, back.select("a", "b", "c").collect())) == sorted(map(tuple, df.collect()))
    assert back.select("_file").distinct().count() == 3
    p2 = tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp") + "/st"
    write_table(df, p2)
    assert read_stage_table(spark, p2).count() == 50


def test_columnar_json_bounds_rows_and_keeps_rows_missing_in_the_first_column(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(25)], "a long, b string")
    write_columnar_json(df, str(tmp_path / "cj"), ["a", "b"], files=1, max_rows=10)
    back = read_columnar_json(spark, str(tmp_path / "cj"), ["0", "1"], ["a", "b"], ["long", "string"])
    assert sorted(map(tuple, back.select("a", "b").collect())) == sorted(map(tuple, df.collect()))
    assert back.select("_file").distinct().count() == 3
    (tmp_path / "one.json").write_text('{"0": {"0": 1}, "1": {"0": "x", "1": "y"}}')
    rows = read_columnar_json(spark, str(tmp_path / "one.json"), ["0", "1"], ["a", "b"], ["long", "string"]).collect()
    assert sorted((r._row, r.a, r.b) for r in rows) == [(0, 1, "x"), (1, None, "y")]


def test_stratified_split_exact_counts(spark):
    import math
    from tessera.ml.prepare import stratified_split
    rows = [(i, "pass" if i % 4 == 0 else "!pass") for i in range(5003)]
    df = spark.createDataFrame(rows, "rid long, y string")
    a = stratified_split(df.repartition(4), "rid", "y", 0.1, 7)
    got = {r.y: r["count"] for r in a.where("is_test").groupBy("y").count().collect()}
    n_test = math.ceil(0.1 * 5003)
    assert sum(got.values()) == n_test
    assert abs(got["pass"] - 0.25 * n_test) <= 1
    b = stratified_split(df.repartition(7), "rid", "y", 0.1, 7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
