"""Typed filters (F1-F18) as Column builders.

Every builder returns a ``Column`` or ``None``; ``None`` means "no
condition" (an empty value, a sentinel such as ``'-'``, or a value that
cannot be converted, which the reference skips with a warning). Conditions
combine with AND. Predicates keep the ``column <op> literal`` form wherever
the rule allows it so that Parquet can prune row groups.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal, InvalidOperation
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quarry.functions.casting import float_text, integer_or_null, number_or_null, parse_datetime
from quarry.functions.literals import (
    FRACTIONAL, INTEGRAL, day_start, parse_day, parse_timestamp, round_trips,
    to_python, typed_lit,
)
from quarry.spec import FilterSpec

LOG = logging.getLogger(__name__)

# Form input types and "no condition" sentinels.
INPUT_FREE_TEXT = "FA"
INPUT_PULLDOWN = "プルダウン"
INPUT_RADIO = "ラジオボタン"
INPUT_CHECKBOX = "チェックボックス"
INPUT_DATES = ("date", "datetime", "Date", "Datetime")
NO_CHOICE = ("-", "すべて", "")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty(value: Any) -> bool:
    return value is None or (isinstance(value, str) and value.strip() == "")


def as_timestamp(c: str | Column, dtype: T.DataType) -> Column:
    """The column as a timestamp; text that does not parse becomes null and
    so never matches."""
    col = _col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col
    return parse_datetime(col, dtype)


def _comparable_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return dtype
    return T.TimestampNTZType()


def day_range(c: str | Column, dtype: T.DataType, start: dt.date | None,
              end: dt.date | None) -> Column | None:
    """Inclusive range of calendar days on a date, timestamp or text column.

    For timestamps the end bound is half-open at the next midnight, which is
    the reference's ``23:59:59.999999`` end at microsecond precision.
    """
    if start is None and end is None:
        return None
    col = as_timestamp(c, dtype)
    ctype = _comparable_type(dtype)
    parts = []
    if start is not None:
        parts.append(col >= day_start(start, ctype))
    if end is not None:
        if isinstance(ctype, T.DateType):
            parts.append(col <= day_start(end, ctype))
        else:
            parts.append(col < day_start(end + dt.timedelta(days=1), ctype))
    return reduce(lambda a, b: a & b, parts)


# --- F1-F3: text -----------------------------------------------------------

def _as_text(c: str | Column, dtype: T.DataType | None) -> Column:
    """A column as the text a user sees: doubles as plain decimals
    (``12345678.0``, not ``1.2345678E7``)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float_text(_col(c).cast("double"))
    return _col(c).cast("string")


def text_ci(c: str | Column, pattern: str | None, dtype: T.DataType | None = None) -> Column | None:
    """case-insensitive regex search on the column as text."""
    if _empty(pattern):
        return None
    return _as_text(c, dtype).rlike("(?i)" + pattern)


def text_regex(c: str | Column, pattern: str | None, dtype: T.DataType | None = None) -> Column | None:
    """case-sensitive regex search on the column as text."""
    if _empty(pattern):
        return None
    return _as_text(c, dtype).rlike(pattern)


def substring(c: str | Column, value: str | None, case_sensitive: bool = True,
              wildcards: bool = False) -> Column | None:
    """literal substring (``LIKE '%v%'``). ``wildcards=True`` lets ``%``
    and ``_`` in the value act as SQL wildcards, as the unescaped reference
    does."""
    if _empty(value):
        return None
    col = _col(c).cast("string")
    if wildcards:
        if case_sensitive:
            return col.like(f"%{value}%")
        return col.ilike(f"%{value}%")
    if case_sensitive:
        return col.contains(value)
    return F.lower(col).contains(value.lower())


# --- F4-F7, F14: equality and membership ----------------------------------

def int_equals(c: str | Column, value: Any, dtype: T.DataType | None = None) -> Column | None:
    """equality with an integer; a non-integer value skips the filter. On
    a text column the rows match whose text is that whole number; other text
    never does, and never stops the job."""
    if _empty(value):
        return None
    try:
        number = to_python(value, T.LongType())
    except ValueError:
        LOG.warning("not an integer, filter skipped: %r", value)
        return None
    if isinstance(dtype, T.StringType):
        return integer_or_null(_col(c)) == F.lit(number)
    return _col(c) == F.lit(number)


def numeric_equals(c: str | Column, value: Any, dtype: T.DataType | None = None) -> Column | None:
    """equality with a number, exact and pushed to the scan: the literal
    has the column's type. On an integer column a fraction, or a value outside
    the type's range, matches nothing; on a float column the number is rounded
    to a float as the column's values were; on a text column the rows match
    whose text is that number. A bad value skips the filter."""
    if _empty(value):
        return None
    text = str(value).strip()
    try:
        number = Decimal(text)
    except InvalidOperation:
        LOG.warning("not a number, filter skipped: %r", value)
        return None
    if isinstance(dtype, INTEGRAL):
        bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(dtype)]
        fits = number.is_finite() and number == number.to_integral_value() and -(1 << bits - 1) <= number < 1 << bits - 1
        return _col(c) == F.lit(int(number)).cast(dtype) if fits else F.lit(False)
    if isinstance(dtype, T.DecimalType) and number.is_finite():
        return _col(c) == F.lit(number)
    if isinstance(dtype, T.FloatType):
        return _col(c) == F.lit(float(text)).cast("float")
    if isinstance(dtype, T.StringType):
        return number_or_null(_col(c)) == F.lit(float(text))
    return _col(c) == F.lit(float(text))


def equals(c: str | Column, value: Any, dtype: T.DataType = T.StringType()) -> Column | None:
    """equality with the value converted to the column type."""
    if value is None:
        return None
    try:
        return _col(c) == typed_lit(value, dtype)
    except ValueError:
        LOG.warning("value does not fit %s, filter skipped: %r", dtype.simpleString(), value)
        return None


def choice(c: str | Column, value: Any, dtype: T.DataType = T.StringType()) -> Column | None:
    """single select / radio equality; no condition for the sentinels."""
    if value is None or (isinstance(value, str) and value.strip() in NO_CHOICE):
        return None
    return equals(c, value, dtype)


def multi_choice(c: str | Column, labels: Iterable[str] | Mapping[str, bool],
                 dtype: T.DataType = T.StringType()) -> Column | None:
    """value among the ticked labels, compared as text.

    Labels are converted to the column type (so the ``IN`` pushes down);
    labels that would not print back identically can never equal the
    column's text and are dropped.
    """
    if isinstance(labels, Mapping):
        labels = [label for label, ticked in labels.items() if ticked]
    labels = [str(label) for label in labels]
    if not labels:
        return None
    if isinstance(dtype, T.StringType):
        return _col(c).isin(labels)
    kept = [to_python(label, dtype) for label in labels if round_trips(label, dtype)]
    if not kept:
        return F.lit(False)
    return _col(c).isin([typed_lit(v, dtype) for v in kept])


# --- F8-F11: dates ---------------------------------------------------------

def date_range(c: str | Column, start: Any = None, end: Any = None,
               dtype: T.DataType = T.TimestampNTZType()) -> Column | None:
    """F8: inclusive day range, either side optional."""
    first = None if _empty(start) else parse_day(start)
    last = None if _empty(end) else parse_day(end)
    return day_range(c, dtype, first, last)


def date_range_midnight(c: str | Column, start: Any = None, end: Any = None,
                        dtype: T.DataType = T.TimestampNTZType()) -> Column | None:
    """like F8 but the end bound is midnight of the end day."""
    col = as_timestamp(c, dtype)
    ctype = _comparable_type(dtype)
    parts = []
    if not _empty(start):
        parts.append(col >= day_start(parse_day(start), ctype))
    if not _empty(end):
        parts.append(col <= day_start(parse_day(end), ctype))
    return reduce(lambda a, b: a & b, parts) if parts else None


def sql_date_range(c: str | Column, start: Any = None, end: Any = None,
                   dtype: T.DataType = T.TimestampNTZType()) -> Column | None:
    """needs both ends; equal ends test the day, otherwise BETWEEN with a
    midnight end."""
    if _empty(start) or _empty(end):
        return None
    first, last = parse_day(start), parse_day(end)
    if first == last:
        return day_range(c, dtype, first, first)
    return date_range_midnight(c, first, last, dtype)


def date_equals(c: str | Column, value: Any,
                dtype: T.DataType = T.TimestampNTZType()) -> Column | None:
    """exact date / timestamp equality."""
    if _empty(value):
        return None
    if isinstance(dtype, T.DateType):
        return _col(c) == day_start(parse_day(value), dtype)
    kind = "timestamp" if isinstance(dtype, T.TimestampType) else "timestamp_ntz"
    return as_timestamp(c, dtype) == F.lit(parse_timestamp(value).isoformat(sep=" ")).cast(kind)


# --- F12, F13: JSON --------------------------------------------------------

def json_contains(c: str | Column, value: str, path: str = "$") -> Column | None:
    """MySQL ``JSON_CONTAINS(c, '"value"', path)``.

    The candidate is a JSON string, so it matches a string equal to
    ``value`` at ``path`` or such a string among the elements of an array
    there; numbers, objects and invalid JSON never match. Arrays nested in
    arrays are not searched.
    """
    if value is None:
        return None
    doc = F.try_parse_json(_col(c).cast("string"))
    node = F.try_variant_get(doc, path, "variant")

    def is_text(v: Column) -> Column:
        return F.schema_of_variant(v) == F.lit("STRING")

    direct = is_text(node) & (F.try_variant_get(node, "$", "string") == F.lit(value))
    items = F.try_variant_get(node, "$", "array<variant>")
    in_array = F.exists(items, lambda x: is_text(x) & (F.try_variant_get(x, "$", "string") == F.lit(value)))
    return F.coalesce(direct | F.coalesce(in_array, F.lit(False)), F.lit(False))


def json_path(c: str | Column, path: str, value: str | None) -> Column | None:
    """JSON_CONTAINS at a path."""
    if _empty(value):
        return None
    return json_contains(c, value, path)


def json_root(c: str | Column, value: str | None) -> Column | None:
    """JSON_CONTAINS at the document root."""
    if _empty(value):
        return None
    return json_contains(c, value, "$")


# --- F15: soft delete -----------------------------------------------------

def not_deleted(c: str | Column = "deleted_at") -> Column:
    """rows that are not soft-deleted."""
    return _col(c).isNull()


# --- F16-F18: folding ------------------------------------------------------

def predicate_for(spec: FilterSpec, dtype: T.DataType) -> Column | None:
    """One FilterSpec as a Column for a column of ``dtype``."""
    c, v, kind = F.col(spec.column), spec.value, spec.kind
    if kind == "text":
        return text_ci(c, v, dtype)
    if kind == "regex":
        return text_regex(c, v, dtype)
    if kind == "substring":
        return substring(c, v, spec.case_sensitive)
    if kind == "like":
        return substring(c, v, spec.case_sensitive, wildcards=True)
    if kind == "int":
        return int_equals(c, v, dtype)
    if kind == "number":
        return numeric_equals(c, v, dtype)
    if kind == "equals":
        return equals(c, v, dtype)
    if kind == "choice":
        return choice(c, v, dtype)
    if kind == "multi":
        return multi_choice(c, v or [], dtype)
    if kind in ("date_range", "date_range_midnight", "sql_date_range"):
        start, end = (v or {}).get("start_date"), (v or {}).get("end_date")
        builder = {"date_range": date_range, "date_range_midnight": date_range_midnight,
                   "sql_date_range": sql_date_range}[kind]
        return builder(c, start, end, dtype)
    if kind == "date_equals":
        return date_equals(c, v, dtype)
    if kind == "json_path":
        return json_path(c, spec.path or "$", v)
    if kind == "json_root":
        return json_root(c, v)
    if kind == "not_deleted":
        return not_deleted(c)
    raise ValueError(f"unknown filter kind: {kind}")


def from_form(column: str, input_type: str, value: Any, dtype: T.DataType) -> FilterSpec:
    """Map a form input type to a filter, as the interactive view does:
    free text is integer equality on integer columns and a regex search
    elsewhere; pull-downs and radios are equality; check boxes are
    membership; date inputs are inclusive day ranges."""
    if input_type == INPUT_FREE_TEXT:
        kind = "int" if isinstance(dtype, INTEGRAL) else "regex"
    elif input_type in (INPUT_PULLDOWN, INPUT_RADIO):
        kind = "choice"
    elif input_type == INPUT_CHECKBOX:
        kind = "multi"
    elif input_type in INPUT_DATES:
        kind = "date_range"
    else:
        kind = input_type
    return FilterSpec(column=column, kind=kind, value=value)


def _matches_blank(spec: FilterSpec, dtype: T.DataType) -> bool:
    """Would the filter accept the value a null is normalised to (F18)?"""
    if spec.kind in ("text", "regex") and not _empty(spec.value):
        flags = re.IGNORECASE if spec.kind == "text" else 0
        try:
            return isinstance(dtype, T.StringType) and re.search(spec.value, "", flags) is not None
        except re.error:
            return False
    if spec.kind in ("int", "number", "equals", "choice") and isinstance(dtype, INTEGRAL):
        try:
            return float(str(spec.value).strip()) == 0.0
        except ValueError:
            return False
    if spec.kind == "multi" and isinstance(dtype, INTEGRAL):
        labels = spec.value.keys() if isinstance(spec.value, Mapping) else spec.value
        return "0" in [str(x) for x in (labels or [])]
    return False


def build_predicate(df: DataFrame, specs: Sequence[FilterSpec],
                    nulls_as_blank: bool = False) -> Column | None:
    """F16: AND of all filters; filters on unknown columns are skipped.

    ``nulls_as_blank=True`` reproduces the reference's habit of blanking
    nulls before filtering (F18) without coalescing inside the predicate,
    which would stop pushdown: only the filters that accept the blank value
    get an ``OR c IS NULL``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for spec in specs:
        if spec.column not in types:
            LOG.warning("filter on unknown column skipped: %s", spec.column)
            continue
        dtype = types[spec.column]
        pred = predicate_for(spec, dtype)
        if pred is None:
            continue
        if nulls_as_blank and _matches_blank(spec, dtype):
            pred = pred | F.col(spec.column).isNull()
        parts.append(pred)
    if not parts:
        return None
    return reduce(lambda a, b: a & b, parts)


def apply_filters(df: DataFrame, specs: Sequence[FilterSpec],
                  nulls_as_blank: bool = False) -> DataFrame:
    """F16 on a frame. An empty result keeps its schema."""
    pred = build_predicate(df, specs, nulls_as_blank)
    return df if pred is None else df.filter(pred)


def typed_filter(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """type-directed dispatch: text columns get a case-insensitive
    search, numbers equality, timestamps exact equality."""
    specs = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for column, value in values.items():
        if _empty(value) or column not in types:
            continue
        dtype = types[column]
        if isinstance(dtype, (INTEGRAL + FRACTIONAL)):
            specs.append(FilterSpec(column, "number", value))
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            specs.append(FilterSpec(column, "date_equals", value))
        else:
            specs.append(FilterSpec(column, "text", value))
    return apply_filters(df, specs)


def normalize_nulls(df: DataFrame) -> DataFrame:
    """text nulls to ``''`` and integer nulls to 0, floats untouched.

    Use it in the output projection, after the filters, so predicates still
    reach the scan.
    """
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        elif isinstance(field.dataType, INTEGRAL):
            c = F.coalesce(c, F.lit(0).cast(field.dataType))
        out.append(c.alias(field.name))
    return df.select(*out)
