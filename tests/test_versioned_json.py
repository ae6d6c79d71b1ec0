"""Versioned keyed updates, staged tables with a life cycle, split column-JSON."""
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.update import apply_versions, update_by_key
from tessera.sources.columnar_json import json_cells, read_columnar_json, write_columnar_json
from tessera.sources.versioned import BUCKET, VersionedTable


def replay(rows, updates, insert=False):
    """The update loop, one write after the other."""
    state = {k: v for k, v in rows}
    for k, version, value in sorted(updates, key=lambda u: (u[1] is not None, u[1] or 0, u[2] is not None, u[2] or "")):
        if k is not None and (k in state or insert):
            state[k] = value
    return sorted(state.items(), key=str)


ROWS = [(i, f"v{i}") for i in range(40)]
UPDATES = [(3, 1, "a"), (3, 7, "b"), (3, 2, "c"), (5, 1, None), (6, 2, "x"), (6, 2, "y"), (None, 9, "no key"), (99, 1, "not there"), (7, None, "first"), (7, 0, "then")]


@pytest.mark.parametrize("insert", [False, True])
def test_the_last_write_wins(spark, insert):
    df = spark.createDataFrame(ROWS, "k long, v string")
    updates = spark.createDataFrame(UPDATES, "k long, version long, v string").repartition(3)
    got = apply_versions(df, updates, "k", "version", ["v"], insert)
    assert got.columns == ["k", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == replay(ROWS, UPDATES, insert)


def test_versions_agree_with_the_single_update(spark):
    df = spark.createDataFrame(ROWS, "k long, v string")
    one = spark.createDataFrame([(3, 1, "a"), (8, 1, "b")], "k long, version long, v string")
    assert sorted(map(tuple, apply_versions(df, one, "k", "version", ["v"]).collect())) == sorted(map(tuple, update_by_key(df, one, "k", "v").collect()))


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k", buckets=8)
    assert table.write(spark.createDataFrame(ROWS, "k long, v string")) == 1
    updates = spark.createDataFrame([(3, 1, "a"), (3, 2, "b"), (11, 1, "z")], "k long, version long, v string")
    version, touched = table.merge(updates, "version", ["v"])
    assert version == 2 and 1 <= len(touched) <= 2
    folders = table._folders()
    assert {b for b in folders if folders[b] != table._folders(1)[b]} == set(touched)
    assert sorted(map(tuple, table.read().collect()), key=str) == replay(ROWS, [(3, 1, "a"), (3, 2, "b"), (11, 1, "z")])
    assert sorted(map(tuple, table.read(version=1).collect())) == ROWS  # readers of the old version still have it
    assert table.merge(updates.limit(0), "version", ["v"]) == (3, [])


def files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names}


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    table = VersionedTable(spark, path, "k", buckets=4)
    table.write(spark.createDataFrame(ROWS, "k long, v string"))
    bad = spark.createDataFrame(ROWS, "k long, v string").withColumn("v", F.when(F.col("k") < 39, F.col("v")).otherwise(F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        table.write(bad)
    assert table.versions() == [1] and sorted(map(tuple, table.read().collect())) == ROWS
    table.clean()
    assert len(os.listdir(f"{path}/data")) == 1  # what the failed write left is gone
    assert sorted(map(tuple, table.read().collect())) == ROWS


def test_cleaning_keeps_what_is_named_and_nothing_stays_after_a_drop(spark, tmp_path):
    path = str(tmp_path / "t")
    table = VersionedTable(spark, path, "k", buckets=4)
    table.write(spark.createDataFrame(ROWS, "k long, v string"))
    table.merge(spark.createDataFrame([(3, 1, "a")], "k long, version long, v string"), "version", ["v"])
    before = sorted(map(tuple, table.read().collect()))
    n = len(files(path))
    table.clean()
    assert table.versions() == [2] and sorted(map(tuple, table.read().collect())) == before and len(files(path)) < n
    parts = [p for p in files(path) if p.endswith(".parquet") and f"{BUCKET}=" in p]
    assert len({p.split(f"{BUCKET}=")[1].split("/")[0] for p in parts}) == len(parts) // 1  # each bucket once
    with pytest.raises(ValueError):
        table.read(version=1)
    table.drop()
    assert not os.path.exists(path)
    with pytest.raises(ValueError):
        table.read()


def nasty(i):
    r = random.Random(i)
    return r.choice([None, f'a,b,"{i}", {{x}}', "\\", "\\\"," * 3, "},\"1\":{\"0\":", "[,]", "é日本,\U0001f600", "", "tab\tnew\nline", f"plain {i}"])


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    n = 3000
    frame = {"0": {str(i): nasty(i) for i in range(n)}, "1": {str(i): i for i in range(n)}, "2": {}, "name, \"x\"": {str(i): [1, i, "q,"] for i in range(0, n, 7)}}
    path = tmp_path / "one.json"
    path.write_text(json.dumps(frame, ensure_ascii=False))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        assert spark.read.text(str(path), lineSep=",").rdd.getNumPartitions() > 10
        cells = {(r.column, r.row): r.value for r in json_cells(spark, str(path)).collect()}
        rows = {r._row: (r.text, r.number) for r in read_columnar_json(spark, str(path), ["0", "1"], ["text", "number"], ["string", "long"]).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == {i: (nasty(i), i) for i in range(n)}
    assert {k for k in cells if k[0] == "name, \"x\""} == {("name, \"x\"", str(i)) for i in range(0, n, 7)}
    assert all(json.loads(cells["name, \"x\"", str(i)]) == [1, i, "q,"] for i in range(0, n, 7))
    assert not any(c == "2" for c, _ in cells)


@pytest.mark.parametrize("text", ['{}', '{"0":{}}', '{"0": {}, "1": {"5": "x"}}', '{\n "1" : { "5" : "x" },\n "0" : { "5" : null }\n}\n'])
def test_small_objects(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    got = [(r._row, r.a, r.b) for r in read_columnar_json(spark, str(tmp_path / "a.json"), ["0", "1"], ["a", "b"], ["string", "string"]).collect()]
    assert got == ([(5, None, "x")] if "5" in text else [])


def test_several_files_keep_apart(spark, tmp_path):
    df = spark.createDataFrame([(i, nasty(i)) for i in range(120)], "a long, b string")
    write_columnar_json(df, str(tmp_path / "cj"), ["a", "b"], files=2, max_rows=20)
    back = read_columnar_json(spark, str(tmp_path / "cj"), ["0", "1"], ["a", "b"], ["long", "string"])
    assert sorted(map(str, back.select("a", "b").collect())) == sorted(map(str, df.collect()))
