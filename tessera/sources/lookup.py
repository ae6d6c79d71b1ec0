"""Small lookup files (the address -> country sheet) read with a declared schema."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_lookup_csv(spark: SparkSession, path: str, schema: str, order: str) -> DataFrame:
    """CSV with a header and a declared DDL schema (no inference pass).

    ``order`` names the file's line-number column, which becomes ``_order``, so a "first matching
    row" rule holds with ``min_by`` however many splits or files the sheet is read in.  A schema
    without that column raises: the order of rows in a distributed read is no order of lines.
    """
    if order not in StructType.fromDDL(schema).names:
        raise ValueError(f"the schema has no column {order!r} to order the rows by: {schema}")
    return spark.read.csv(path, header=True, schema=schema).withColumnRenamed(order, "_order")
