"""Database source for the reference's MySQL queries (A3, A8 over JDBC).

Not exercised by the test suite (no database is available to it). A
parallel read splits ``partition_column`` into ``num_partitions`` ranges so
that each task runs one bounded query, never an OFFSET loop.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000, properties: Mapping[str, str] | None = None) -> DataFrame:
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if query is not None:
        if partition_column:
            # partitioned reads need a table expression
            reader = reader.option("dbtable", f"({query}) AS q")
        else:
            reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
        reader = reader.option("partitionColumn", partition_column) \
            .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound)) \
            .option("numPartitions", str(num_partitions))
    return reader.load()
