"""Plain table scans (``SELECT *`` of the extractor) and a name -> DataFrame catalog.

Scans are lazy Parquet reads; Catalyst prunes columns and pushes filters into
the scan, so callers select only what they use.  A JDBC source is the same
call with ``fmt="jdbc"`` and connection options supplied by the caller's
configuration (never by code).
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(table: str, partition_column: str | None = None, lower: object = None, upper: object = None,
                 partitions: int | None = None, fetch_rows: int = 10_000, **connection: str) -> dict[str, str]:
    """Options of a JDBC scan.  With a partition column and its bounds the table is read by
    ``partitions`` tasks (rows outside the bounds fall into the first and last one); without, by one."""
    given = [partition_column, lower, upper, partitions]
    if any(v is not None for v in given) and None in given:
        raise ValueError("partition_column, lower, upper and partitions go together")
    out = {**connection, "dbtable": table, "fetchsize": str(fetch_rows)}
    if partition_column:
        out.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
    return out


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet",
               options: dict[str, str] | None = None) -> DataFrame:
    """Scan one table: ``{base}/{name}.parquet`` for files, the options of ``jdbc_options`` for JDBC."""
    reader = spark.read.format(fmt)
    if fmt == "jdbc":
        return reader.options(**jdbc_options(name, **(options or {}))).load()
    if options:
        reader = reader.options(**options)
    suffix = "" if fmt not in ("parquet", "orc", "json", "csv") else f".{fmt}"
    return reader.load(f"{base.rstrip('/')}/{name}{suffix}")


def read_tables(spark: SparkSession, base: str, names: Iterable[str], **kw) -> dict[str, DataFrame]:
    """The extractor's query loop as a dict of lazy scans (nothing is read yet)."""
    return {n: read_table(spark, base, n, **kw) for n in names}


def register_catalog(tables: dict[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """Expose every DataFrame as a temp view named ``prefix + name``;
    returns name -> view name."""
    views = {n: f"{prefix}{n}" for n in tables}
    for name, df in tables.items():
        df.createOrReplaceTempView(views[name])
    return views
