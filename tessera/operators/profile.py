"""Data profiles: null counts / rates, missing-value report, schema, class balance.

Null counts for all columns are computed in ONE pass (one aggregate with a
conditional sum per column), then unpivoted; only the per-column summary is
small enough to ever reach the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, miss_num, miss_rate) for every column, one scan."""
    cols = df.columns
    aggs = [F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).cast("long").alias(f"c{i}")
            for i, c in enumerate(cols)]
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("miss_num")) for i, c in enumerate(cols)])
    long = wide.select("__n", F.inline(pairs))
    return long.select("column_name", "miss_num",
                       (F.col("miss_num").cast("double") / F.col("__n").cast("double")).alias("miss_rate"))


def null_counts(df: DataFrame) -> DataFrame:
    return null_profile(df).select("column_name", "miss_num")


def null_rates(df: DataFrame) -> DataFrame:
    return null_profile(df).select("column_name", "miss_rate")


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, highest rate first (name breaks ties)."""
    return (null_profile(df).where(F.col("miss_rate") > 0)
            .orderBy(F.col("miss_rate").desc(), F.col("column_name")))


def schema_profile(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, column_name, dtype) from the schema (metadata only, no scan)."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "position int, column_name string, dtype string")


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per class; the null class is left out."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
