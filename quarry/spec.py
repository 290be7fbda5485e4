"""Dataset and filter descriptions.

A dataset is described once: how to build its base relation, the order key
used for newest-first paging, the columns period criteria refer to, the type
dictionary and the soft-delete column. Jobs and interactive views then apply
period, soft-delete and typed filters around it.

Two stages follow the reference's placement rule: period and soft-delete
filters act on ``base`` (before any aggregation in ``shape``), user filters
act on the shaped result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class FilterSpec:
    """One user filter. ``kind`` selects the rule (see functions.filters)."""

    column: str
    kind: str
    value: Any = None
    path: str | None = None
    case_sensitive: bool = True


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    base: Callable[[SparkSession], DataFrame]
    order_key: Sequence[str] = ()
    shape: Callable[[DataFrame], DataFrame] | None = None
    columns: Mapping[str, str] = field(default_factory=dict)   # alias -> source
    criteria: Mapping[str, str | Sequence[str]] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    deleted_at: str | None = "deleted_at"
    main_table: str | None = None
    display_name: str | None = None


@dataclass(frozen=True)
class JobSpec:
    """One manifest row (the reference's fields, typed). ``filename_format`` is
    an output name pattern; ``encoding`` is a CSV output's; ``timeout_s`` is
    this job's deadline in seconds (blank: the run's)."""

    sql_name: str
    output_name: str
    period: str = ""
    criterion: str = ""
    save_path: str = ""
    target: str = "parquet"
    exclude_deleted: bool = False
    paste_mode: str = ""
    test: bool = False
    category: str = ""
    main_table: str = ""
    display_name: str = ""
    sheet_name: str = ""
    frequency: str = ""
    filename_format: str = ""
    encoding: str = "windows-31j"
    enabled: str = "TRUE"
    timeout_s: str = ""
