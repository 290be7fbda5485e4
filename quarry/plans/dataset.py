"""Building a dataset from its spec: base -> pre filters -> shape -> aliases.

Period and soft-delete filters act on the base relation, before any
aggregation in ``shape`` (the reference splices them into the query's WHERE
ahead of GROUP BY); user filters act on the shaped result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.filters import apply_filters, not_deleted
from quarry.functions.period import MASTER_CATEGORY, criterion_columns, period_filter
from quarry.functions.text import alias_projection, resolve_alias
from quarry.operators.paging import page
from quarry.spec import DatasetSpec, FilterSpec


def prepare_dataset(spark: SparkSession, spec: DatasetSpec, period: str = "", criterion: str = "",
                    as_of: dt.date | None = None, exclude_deleted: bool = False,
                    category: str = "", on_unknown: str = "raise") -> DataFrame:
    df = spec.base(spark)
    if category != MASTER_CATEGORY:
        if period and period.strip():
            if as_of is None:
                raise ValueError("a period needs as_of")
            columns = criterion_columns(criterion, dict(spec.criteria))
            df = period_filter(df, period, columns, as_of, category, on_unknown)
        if exclude_deleted:
            if not spec.deleted_at or spec.deleted_at not in df.columns:
                raise ValueError(f"dataset {spec.name!r} has no soft-delete column {spec.deleted_at!r}")
            df = df.filter(not_deleted(spec.deleted_at))
    if spec.shape is not None:
        df = spec.shape(df)
    if spec.columns:
        df = alias_projection(df, spec.columns)
    return df


def alias_filters(spec: DatasetSpec, filters: Sequence[FilterSpec]) -> list[FilterSpec]:
    """Filters named by display alias, re-aimed at the projected column;
    unknown names are dropped."""
    out = []
    for f in filters:
        if not spec.columns:
            out.append(f)
            continue
        if f.column in spec.columns or resolve_alias(spec.columns, f.column) is not None:
            alias = f.column if f.column in spec.columns else \
                next(a for a, s in spec.columns.items() if s == f.column)
            out.append(FilterSpec(alias, f.kind, f.value, f.path, f.case_sensitive))
    return out


def filtered_view(df: DataFrame, filters: Sequence[FilterSpec], keys: Sequence[str],
                  number: int = 1, size: int = 100) -> DataFrame:
    """The interactive path: typed filters (F16) -> newest first (S1) ->
    page (S2). Filters reach the scan; the page is a top-k."""
    return page(apply_filters(df, filters), keys, number, size)
