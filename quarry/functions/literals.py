"""Driver-side conversion of user input into typed literals.

Filter values arrive as text from forms and manifests. Converting them on
the driver to the column's own type keeps predicates of the form
``column <op> literal``, which Catalyst pushes into the Parquet scan; casting
the column instead would not push down.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column, functions as F, types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

# Date layouts accepted for user-typed dates and timestamps.
DATE_LAYOUTS = ("%Y-%m-%d", "%Y/%m/%d")
TIMESTAMP_LAYOUTS = ("%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S",
                     "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S.%f")


def parse_day(value: Any) -> dt.date:
    """A calendar day from a date, datetime or text; ValueError otherwise."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value).strip()
    for layout in DATE_LAYOUTS + TIMESTAMP_LAYOUTS:
        try:
            return dt.datetime.strptime(text, layout).date()
        except ValueError:
            continue
    raise ValueError(f"not a date: {value!r}")


def parse_timestamp(value: Any) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    text = str(value).strip()
    for layout in TIMESTAMP_LAYOUTS + DATE_LAYOUTS:
        try:
            return dt.datetime.strptime(text, layout)
        except ValueError:
            continue
    raise ValueError(f"not a timestamp: {value!r}")


def to_python(value: Any, dtype: T.DataType) -> Any:
    """Convert ``value`` to a Python value of ``dtype``; ValueError if it
    does not convert exactly."""
    if isinstance(dtype, T.BooleanType):
        text = str(value).strip().lower()
        if text in ("true", "1"):
            return True
        if text in ("false", "0"):
            return False
        raise ValueError(f"not a boolean: {value!r}")
    if isinstance(dtype, INTEGRAL):
        if isinstance(value, bool):
            raise ValueError("boolean is not an integer")
        if isinstance(value, int):
            return value
        text = str(value).strip()
        try:
            number = Decimal(text)
        except InvalidOperation as exc:
            raise ValueError(f"not an integer: {value!r}") from exc
        if number != number.to_integral_value():
            raise ValueError(f"not an integer: {value!r}")
        return int(number)
    if isinstance(dtype, T.DecimalType):
        try:
            return Decimal(str(value).strip())
        except InvalidOperation as exc:
            raise ValueError(f"not a number: {value!r}") from exc
    if isinstance(dtype, FRACTIONAL):
        return float(str(value).strip())
    if isinstance(dtype, T.DateType):
        return parse_day(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return parse_timestamp(value)
    return str(value)


def typed_lit(value: Any, dtype: T.DataType) -> Column:
    """A literal of exactly ``dtype`` (constant-folded, so it pushes down)."""
    python_value = to_python(value, dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(python_value.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(python_value.isoformat(sep=" ")).cast("timestamp")
    if isinstance(dtype, T.DateType):
        return F.lit(python_value.isoformat()).cast("date")
    return F.lit(python_value).cast(dtype)


def round_trips(label: str, dtype: T.DataType) -> bool:
    """True when the column value equal to ``label`` prints back as
    ``label`` (how a string comparison of the column would see it)."""
    try:
        python_value = to_python(label, dtype)
    except (ValueError, TypeError):
        return False
    if isinstance(dtype, INTEGRAL):
        return str(python_value) == label
    if isinstance(dtype, FRACTIONAL) and not isinstance(dtype, T.DecimalType):
        return repr(float(python_value)) == label
    if isinstance(dtype, T.BooleanType):
        return str(python_value) == label
    if isinstance(dtype, T.DateType):
        return python_value.isoformat() == label
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return str(python_value) == label
    return True


def day_start(day: dt.date, dtype: T.DataType) -> Column:
    """Midnight of ``day`` as a literal comparable with a column of ``dtype``."""
    if isinstance(dtype, T.DateType):
        return F.lit(day.isoformat()).cast("date")
    kind = "timestamp" if isinstance(dtype, T.TimestampType) else "timestamp_ntz"
    return F.lit(f"{day.isoformat()} 00:00:00").cast(kind)
