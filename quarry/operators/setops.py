"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_chunks(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate row chunks of one schema (by column name). A plain
    union: no shuffle, partitions are simply listed one after another."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), frames)
