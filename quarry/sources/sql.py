"""SQL sources (A3-A7): named and ad-hoc queries over registered views.

The reference keeps queries as ``.sql`` text looked up by name and runs them
on MySQL. Here the text runs through ``spark.sql`` over views, so Catalyst
plans the joins and aggregates. A database stays reachable through the JDBC
reader (``sources.jdbc``), which can be registered as a view as well.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

LOG = logging.getLogger(__name__)


def register_tables(spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet") -> None:
    """Register ``{view: path}`` as temporary views."""
    for name, path in tables.items():
        spark.read.format(fmt).load(path).createOrReplaceTempView(name)


class QueryBook:
    """Named SQL texts: a folder of ``<name>.sql`` files or an in-memory map."""

    def __init__(self, folder: str | None = None, texts: Mapping[str, str] | None = None):
        self.folder = folder
        self.texts = dict(texts or {})

    def get(self, name: str) -> str | None:
        key = name[:-4] if name.endswith(".sql") else name
        if key in self.texts:
            return self.texts[key]
        if self.folder:
            path = os.path.join(self.folder, f"{key}.sql")
            if os.path.exists(path):
                with open(path, encoding="utf-8") as fh:
                    return fh.read()
        return None


def _clean(text: str) -> str:
    return text.strip().rstrip(";").strip()


def scan_query(spark: SparkSession, book: QueryBook, name: str,
               fallback_table: str | None = None) -> DataFrame:
    """A3: run a named SELECT. A5: when the text is missing and a main table
    is given, read the whole table instead (no filters)."""
    text = book.get(name)
    if text is None:
        if fallback_table is None:
            raise KeyError(f"no query named {name!r}")
        LOG.warning("query %s missing; reading table %s", name, fallback_table)
        return scan_fallback_table(spark, fallback_table)
    return spark.sql(_clean(text))


def scan_fallback_table(spark: SparkSession, table: str) -> DataFrame:
    """A5: ``SELECT *`` of the main table."""
    return spark.table(table)


def scan_adhoc_sql(spark: SparkSession, text: str, limit: int | None = None) -> DataFrame:
    """A4: run SQL text, optionally limited."""
    df = spark.sql(_clean(text))
    return df.limit(limit) if limit else df


def query_page(df: DataFrame, order: Sequence[str], limit: int | None, offset: int = 0) -> DataFrame:
    """``LIMIT n [OFFSET m]`` on a query, in a stated order (a limit
    without an order is not deterministic in Spark). The offset is ignored
    when 0 or when there is no limit."""
    if not limit:
        return df
    ordered = df.orderBy(*order) if order else df
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(limit)


def query_count(df: DataFrame) -> DataFrame:
    """``SELECT COUNT(*) FROM (q)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
