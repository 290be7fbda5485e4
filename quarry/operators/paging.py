"""Newest-first ordering and paging.

The reference sorts by load order, which has no meaning in Spark; every
dataset names an order key with a unique tie-break instead. Paging refuses to
run without a key, and ``verify_order_key`` checks on the data that it is
unique (pages over a key with ties could lose or repeat rows). Shallow pages plan as ``TakeOrderedAndProject``
(a per-partition top-k then a merge of k rows per task); deep pages should
use the keyset form, which is a pushed-down filter plus the same top-k.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarry.functions.literals import typed_lit


def _keys(keys: Sequence[str] | str) -> list[str]:
    names = [keys] if isinstance(keys, str) else list(keys)
    if not names:
        raise ValueError("paging needs an order key (load order has no meaning in Spark)")
    return names


def verify_order_key(df: DataFrame, keys: Sequence[str] | str) -> None:
    """Raise unless the key tells all rows apart (nulls count as equal): one
    aggregate over the key columns, to run once per dataset, not per page."""
    names = _keys(keys)
    repeated = df.groupBy(*names).agg(F.count(F.lit(1)).alias("quarry_n")).where("quarry_n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"order key {names} has ties; add a unique column to it")


def newest_first(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Order by the key, newest first."""
    return df.orderBy(*[F.col(k).desc_nulls_last() for k in _keys(keys)])


def page(df: DataFrame, keys: Sequence[str] | str, number: int, size: int) -> DataFrame:
    """Rows ``(number-1)*size`` .. ``number*size`` of the newest-first order."""
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    ordered = newest_first(df, keys)
    skip = (number - 1) * size
    return (ordered.offset(skip) if skip else ordered).limit(size)


def page_after(df: DataFrame, keys: Sequence[str] | str, last_seen: Sequence[Any], size: int) -> DataFrame:
    """S2 for deep pages: the ``size`` rows after ``last_seen`` (the key
    values of the previous page's last row), by a lexicographic filter. Nulls
    come last, so a null key follows every value and nothing follows a null."""
    names = _keys(keys)
    if len(last_seen) != len(names):
        raise ValueError(f"{len(names)} order keys need as many values, not {len(last_seen)}")
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    same: list[Column] = []
    conds: list[Column] = []
    for k, value in zip(names, last_seen):
        col = F.col(k)
        if value is None:
            same.append(col.isNull())
            continue
        lit = typed_lit(value, dtypes[k])
        conds.append(reduce(lambda a, b: a & b, [*same, (col < lit) | col.isNull()]))
        same.append(col == lit)
    after = reduce(lambda a, b: a | b, conds) if conds else F.lit(False)
    return newest_first(df.filter(after), names).limit(size)


def page_summary(df: DataFrame, number: int, size: int) -> DataFrame:
    """S3: total rows, total pages (ceil), and the first/last row numbers of
    page ``number``, from one count."""
    total = F.col("total_rows")
    first = F.lit((number - 1) * size + 1)
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        total,
        F.ceil(total / F.lit(size)).cast("bigint").alias("total_pages"),
        F.when(total >= first, first).otherwise(F.lit(0)).cast("bigint").alias("first_row"),
        F.least(total, F.lit(number * size).cast("bigint")).alias("last_row"),
    )


def page_prefetch(df: DataFrame, keys: Sequence[str] | str, number: int, size: int) -> DataFrame:
    """The next page."""
    return page(df, keys, number + 1, size)


def row_numbers(df: DataFrame, keys: Sequence[str] | str, number: int, size: int,
                name: str = "row_no") -> DataFrame:
    """Page ``number`` with a 1-based display number that continues over
    pages. The window runs on the page only (at most ``size`` rows), never
    on the whole frame."""
    names = _keys(keys)
    rows = page(df, names, number, size)
    w = Window.orderBy(*[F.col(k).desc_nulls_last() for k in names])
    return rows.withColumn(name, (F.row_number().over(w) + F.lit((number - 1) * size)).cast("bigint"))


def head_preview(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows."""
    return df.limit(n)
