"""Sinks and staged tables (the reference writes spreadsheets; we write Parquet)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write a result table; CSV gets a header so small reports open anywhere."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def read_stage_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Re-read a staged table.  Parquet carries no index artefact column."""
    df = spark.read.format(fmt).load(path)
    if "Unnamed: 0" in df.columns:
        df = df.drop("Unnamed: 0")
    return df
