"""Column-oriented JSON extracts: ``{"<col>": {"<row>": value, ...}, ...}``.

Each file is one JSON object (pandas' default ``to_json`` orientation).  A file is read by as many tasks as it
has splits: text is cut at commas, a structural index tells which commas stand between cells, and cells are
put together again by their number.

* A comma-cut fragment gives its quotes (is the next fragment inside a string?) and, for either case, how deep
  its brackets go.  Sums of these over a split, and over the splits before it (one row a split), give the state at
  each fragment's start: at depth 2 outside a string it starts a cell, at depth 1 a column.
* Cells and columns are numbered by running counts in the same way, so a cell whose string holds commas is whole
  again wherever its split ends, and a column's name, which stands once, reaches all of its cells by a join.

Linear in the text; a task holds a split and no string is longer than a cell.  Convert to Parquet once at ingest.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint


def _bracket_depth(text: F.Column) -> F.Column:
    """Opened less closed brackets of text that lies outside strings."""
    count = lambda marks: F.length(F.regexp_replace(text, f"[^{marks}]", ""))
    return count(r"\{\[") - count(r"\}\]")


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Comma-cut fragments with their file, split, place in it, quotes, and depth if they start outside or inside a string."""
    raw = spark.read.text(path, lineSep=",").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value",
        F.monotonically_increasing_id().alias("at"))  # ascending inside a split
    plain = F.split(F.regexp_replace("value", r"\\.", ""), '"')  # no escaped quotes: parts alternate between outside and inside
    kept = lambda parity: F.array_join(F.filter("parts", lambda _, i: i % 2 == parity), " ")
    cut = raw.withColumn("parts", plain)
    return cut.select("file", "split", "at", "value", ((F.size("parts") - 1) % 2).alias("odd"),
                      _bracket_depth(kept(0)).alias("outside"), _bracket_depth(kept(1)).alias("inside"))


def _running(df: DataFrame, values: dict[str, F.Column]) -> DataFrame:
    """``df`` with, for each value, its sum over all fragments of the file before this one."""
    local = Window.partitionBy("file", "split").orderBy("at")
    upto = df.withColumns({f"{n}__own": v.cast("long") for n, v in values.items()})
    upto = upto.withColumns({f"{n}__local": F.sum(f"{n}__own").over(local) - F.col(f"{n}__own") for n in values})
    totals = upto.groupBy("file", "split").agg(*[F.sum(f"{n}__own").alias(n) for n in values])
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", "split", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}__before") for n in values])
    joined = upto.join(offsets, ["file", "split"])
    return joined.withColumns({n: F.col(f"{n}__local") + F.col(f"{n}__before") for n in values}).drop(
        *[f"{n}__{x}" for n in values for x in ("own", "local", "before")])


def json_cells(spark: SparkSession, path: str) -> DataFrame:
    """(file, column, row, value): one row a cell, values as strings, read over the splits of each file."""
    state = _running(_fragments(spark, path), {"quotes": F.col("odd")})
    in_string = F.col("quotes") % 2 == 1
    state = _running(state.withColumn("in_string", in_string), {"depth": F.when(in_string, F.col("inside")).otherwise(F.col("outside"))})
    # a file's first fragment starts its first column, at depth 0
    state = state.withColumn("starts_column", ~F.col("in_string") & (F.col("depth") < 2)).withColumn("starts_cell", ~F.col("in_string") & (F.col("depth") <= 2))
    state = _running(state, {"columns": F.col("starts_column").cast("int"), "cells": F.col("starts_cell").cast("int")})
    own = lambda n, flag: F.col(n) + F.col(flag).cast("long")
    state = checkpoint(state.select("file", "split", "at", "value", own("columns", "starts_column").alias("column_no"), own("cells", "starts_cell").alias("cell_no"), "starts_column"))
    pieces = F.array_sort(F.collect_list(F.struct("split", "at", "value")))
    texts = state.groupBy("file", "column_no", "cell_no").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), ",").alias("text"),
                                                              F.max("starts_column").alias("first"))
    texts = texts.withColumn("text", F.trim(F.regexp_replace("text", r"[\r\n\t]", " ")))
    # the first cell of a column: {"col":{"row":value  or  "col":{"row":value
    head = r'^\{?\s*("(?:[^"\\]|\\.)*+")\s*:\s*\{'
    name = F.get(F.from_json(F.concat(F.lit("["), F.regexp_extract("text", head, 1), F.lit("]")), "array<string>"), F.lit(0))
    body = F.when(F.col("first"), F.regexp_replace("text", head, "")).otherwise(F.col("text"))
    # what closes the column and the file stands after the last cell of a column; from_json reads one object and ignores it
    cell = F.from_json(F.concat(F.lit("{"), F.trim(body), F.lit("}")), "map<string,string>")
    names = texts.where("first").select("file", "column_no", name.alias("column"))
    found = texts.select("file", "column_no", F.explode(cell).alias("row", "value"))
    return found.join(names, ["file", "column_no"]).select("file", "column", "row", "value")


def read_columnar_json(spark: SparkSession, path: str, columns: Sequence[str],
                       names: Sequence[str] | None = None,
                       types: Sequence[T.DataType] | None = None) -> DataFrame:
    """Read column-oriented JSON file(s) at ``path`` into a row DataFrame.

    ``columns`` are the positional keys in the file ("0", "1", ...), ``names``
    the output names and ``types`` the target types (strings by default).
    The row index is kept as ``_row`` (long) so the file order is recoverable.
    """
    names = list(names or columns)
    types = list(types or [T.StringType()] * len(columns))
    cells = json_cells(spark, path)
    picked = [F.first(F.when(F.col("column") == str(c), F.col("value")), ignorenulls=True).cast(t).alias(n)
              for c, n, t in zip(columns, names, types)]
    return cells.groupBy(F.col("file").alias("_file"), F.col("row").cast("long").alias("_row")).agg(*picked)


def write_columnar_json(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None,
                        max_rows: int = 100_000) -> str:
    """Write ``df`` in the column-oriented layout, one JSON object per file.

    Each Spark partition becomes one file for every ``max_rows`` of its rows, numbered 0..n-1 in
    partition order, so a file (and what one task gathers) never exceeds that bound.
    """
    if files:
        df = df.repartition(files)
    pid = F.spark_partition_id()
    at = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    numbered = df.select(pid.alias("_part"), at.alias("_at"), *columns)
    tagged = numbered.withColumn("_row", F.col("_at") % max_rows).withColumn(
        "_file", F.concat_ws("-", "_part", F.floor(F.col("_at") / max_rows).cast("long")))
    per_file = tagged.groupBy("_file").agg(*[
        F.map_from_entries(F.collect_list(F.struct(F.col("_row").cast("string"), F.col(c).cast("string"))))
        .alias(f"c{i}") for i, c in enumerate(columns)])
    obj = F.to_json(F.struct(*[F.col(f"c{i}").alias(str(i)) for i in range(len(columns))]))
    per_file.select("_file", obj.alias("value")).write.mode("overwrite").partitionBy("_file").text(path)
    return path
