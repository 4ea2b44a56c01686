"""Relational table scan (S6) through the JDBC data source.

Needs the database's JDBC driver on the classpath; the column list and the
predicate are pushed into the database query, and a numeric partition column
splits the scan into parallel range queries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, columns: Sequence[str] | None = None, predicate: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int = 8, fetch_size: int = 10000, **extra) -> dict:
    cols = ", ".join(columns) if columns else "*"
    query = f"(SELECT {cols} FROM {table}" + (f" WHERE {predicate}" if predicate else "") + ") q"
    opts = {"url": url, "dbtable": query, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("partition_column needs lower and upper bounds")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                     "numPartitions": str(num_partitions)})
    return opts


def read_jdbc_table(spark: SparkSession, url: str, table: str, columns: Sequence[str] | None = None,
                    predicate: str | None = None, partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int = 8, **extra) -> DataFrame:
    opts = jdbc_options(url, table, columns, predicate, partition_column, lower, upper, num_partitions, **extra)
    return spark.read.format("jdbc").options(**opts).load()
