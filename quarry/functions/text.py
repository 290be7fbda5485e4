"""Small text helpers for previews and projections (B1, B2)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Preview lengths (cells 35, grid cells 30; headers 20, or 15
# when a frame has more than 10 columns) and the ellipsis.
CELL_CHARS = 35
GRID_CELL_CHARS = 30
HEADER_CHARS = 20
HEADER_CHARS_WIDE = 15
WIDE_COLUMNS = 10
ELLIPSIS = "..."


def truncate(c: Column, n: int = CELL_CHARS) -> Column:
    """B2: cut text to ``n`` characters followed by ``...``."""
    text = c.cast("string")
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(ELLIPSIS))).otherwise(text)


def header_label(name: str, n_columns: int) -> str:
    limit = HEADER_CHARS_WIDE if n_columns > WIDE_COLUMNS else HEADER_CHARS
    return name if len(name) <= limit else name[:limit] + ELLIPSIS


def preview_truncate(df: DataFrame, n: int = CELL_CHARS, headers: bool = False) -> DataFrame:
    """B2 over every text column (and optionally the header labels)."""
    width = len(df.columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() == "string":
            c = truncate(c, n)
        out.append(c.alias(header_label(f.name, width) if headers else f.name))
    return df.select(*out)


def alias_projection(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """B1: project ``{alias: source expression}``."""
    return df.select(*[F.expr(src).alias(alias) for alias, src in columns.items()])


def resolve_alias(columns: Mapping[str, str], name: str) -> str | None:
    """The source column of a display alias (a filter on an alias applies to
    its source column); ``None`` when unknown."""
    if name in columns:
        return columns[name]
    if name in columns.values():
        return name
    return None
