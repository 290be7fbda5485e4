"""Schema and inventory."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA_COLUMNS = "ordinal_position int, column_name string, data_type string, is_nullable boolean, comment string"


def table_schema(df: DataFrame) -> DataFrame:
    """A10: (ordinal, name, type, nullable, comment) of a frame's columns in
    order. Built from the schema on the driver: one row per column."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment"))
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, SCHEMA_COLUMNS)


def table_inventory(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, row_count, comment) for every table, by name. The
    counts are one union of aggregates, so a single job scans all tables in
    parallel. Without ``tables`` the whole catalog is listed: stored tables of
    the current database with their comments, and temporary views."""
    comments: dict[str, str | None] = {}
    if tables is None:
        listed = spark.catalog.listTables()
        comments = {t.name: t.description for t in listed}
        tables = {t.name: spark.table(t.name) for t in listed}
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(comments.get(name)).cast("string").alias("comment"))
        for name, df in sorted(tables.items())]
    if not parts:
        return spark.createDataFrame([], "table_name string, row_count bigint, comment string")
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("table_name")


def catalog_inventory(spark: SparkSession, names: Sequence[str] | None = None, scan_missing: bool = True) -> DataFrame:
    """A11 without reading data: (table_name, row_count, counted, comment) of
    the current database's stored tables, or of ``names``. The row count is the
    one that ``ANALYZE TABLE`` stored; a table without one is counted by a
    scan and marked ``counted`` (left null if ``scan_missing`` is off)."""
    comments = {t.name: t.description for t in spark.catalog.listTables() if t.tableType != "TEMPORARY"}
    wanted = sorted(comments if names is None else names)
    known = {name: stored_row_count(spark, name) for name in wanted}
    schema = "table_name string, row_count bigint, counted boolean, comment string"
    rows = [(n, known[n], False, comments.get(n)) for n in wanted if known[n] is not None or not scan_missing]
    parts = [spark.createDataFrame(rows, schema)]
    missing = [n for n in wanted if known[n] is None and scan_missing]
    if missing:
        counted = table_inventory(spark, {n: spark.table(n) for n in missing})
        text = F.create_map(*[x for n in missing for x in (F.lit(n), F.lit(comments.get(n)).cast("string"))])
        parts.append(counted.select("table_name", "row_count", F.lit(True).alias("counted"), text[F.col("table_name")].alias("comment")))
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("table_name")


def stored_row_count(spark: SparkSession, name: str) -> int | None:
    """The row count among a table's stored statistics."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").where("col_name = 'Statistics'").collect()
    found = re.search(r"(\d+) rows", rows[0]["data_type"]) if rows else None
    return int(found[1]) if found else None


def analyze(spark: SparkSession, names: Sequence[str]) -> None:
    """Store the statistics of tables; Spark then also plans joins by them."""
    for name in names:
        spark.sql(f"ANALYZE TABLE `{name}` COMPUTE STATISTICS")
