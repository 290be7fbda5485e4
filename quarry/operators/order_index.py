"""An order index: any page at any depth by a bounded read.

``build_order_index`` stores a frame newest first, in files that are ranges of
the order key, each row with the number of its range and its place there. A
second, tiny table holds for each file its bounds, its row count and the rows
before it. A page number then says which files hold the page and which places
in them: the read opens those files alone, and the places, which ascend in a
file, let Parquet skip all pages of it that hold none of them. Depth costs
nothing, and totals and row numbers come from the index without a scan.

The frame's order is fixed when the index is built; filtered views have
another order of places, and use ``paging.page`` or ``page_after``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quarry.operators.paging import _keys, newest_first, verify_order_key
from quarry.sinks.fs import write_counted

RANGE, PLACE = "quarry_range", "quarry_place"
PAGE_ROWS = 4096  # rows that Parquet skips or reads together
RANGE_ROWS = 500_000  # rows of a range, which one task sorts
_PLACE_BITS = 33  # of monotonically_increasing_id: the partition above, the row below


def build_order_index(df: DataFrame, keys: Sequence[str] | str, path: str, partitions: int | None = None,
                      file_rows: int = 5_000_000, page_rows: int = PAGE_ROWS, check_key: bool = True) -> str:
    """Write the ordered rows to ``path``/data and the index to ``path``/index.
    ``keys`` must tell all rows apart (checked unless ``check_key`` is off).
    Unless ``partitions`` says how many, the ranges grow in number with the rows."""
    names = _keys(keys)
    if check_key:
        verify_order_key(df, names)
    order = [F.col(k).desc_nulls_last() for k in names]
    ranged = df.repartitionByRange(partitions or max(1, -(-df.count() // RANGE_ROWS)), *order)
    at = F.monotonically_increasing_id()
    rows = ranged.sortWithinPartitions(*order).withColumn(PLACE, at) \
        .withColumn(RANGE, F.shiftright(PLACE, _PLACE_BITS).cast("int")) \
        .withColumn(PLACE, F.col(PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
    options = {"parquet.page.row.count.limit": str(page_rows), "maxRecordsPerFile": str(file_rows)}
    write_counted(rows, lambda d: d.write.mode("errorifexists").options(**options).parquet(f"{path}/data"))
    spark = df.sparkSession
    stored = spark.read.parquet(f"{path}/data").select(RANGE, PLACE, *names, F.col("_metadata.file_path").alias("quarry_path"))
    # the keys at a file's ends are read from the two rows there: the least of a struct would sort all rows
    ends = stored.join(F.broadcast(_files(stored)), RANGE) \
        .where((F.col(PLACE) == F.col("quarry_file.from_place")) | (F.col(PLACE) == F.col("quarry_file.to_place")))
    bounds = [f(F.struct(PLACE, *names)).alias(n) for f, n in ((F.min, "first_row"), (F.max, "last_row"))]
    files = ends.groupBy(RANGE, "quarry_file").agg(*bounds).select(RANGE, "quarry_file.*", "first_row", "last_row")
    # one row a file, so this window is as small as the listing of the files
    along = Window.orderBy(RANGE, "from_place").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))) \
        .select("file", RANGE, "from_place", "n", "before", F.col("first_row").dropFields(PLACE).alias("newest"),
                F.col("last_row").dropFields(PLACE).alias("oldest")) \
        .coalesce(1).write.mode("errorifexists").parquet(f"{path}/index")
    return path


def _files(stored: DataFrame) -> DataFrame:
    """One row a file: its range and (file, n, from_place, to_place), summed
    as plain numbers in one entry a file and task."""
    return stored.groupBy(RANGE, "quarry_path") \
        .agg(F.count(F.lit(1)).alias("n"), F.min(PLACE).alias("from_place"), F.max(PLACE).alias("to_place")) \
        .select(RANGE, F.struct(F.col("quarry_path").alias("file"), "n", "from_place", "to_place").alias("quarry_file"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, from_place, n, before, newest, oldest), one row a file."""
    return spark.read.parquet(f"{path}/index")


def indexed_page(spark: SparkSession, path: str, number: int, size: int, row_no: str | None = None) -> DataFrame:
    """S2 (and S5 with ``row_no``): page ``number`` of the stored order. Only
    the files that hold the page are opened; the index gives at most a handful."""
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    low, high = (number - 1) * size, number * size
    parts = read_index(spark, path).where((F.col("before") < high) & (F.col("before") + F.col("n") > low)) \
        .orderBy("before").collect()
    if not parts:
        rows = spark.read.parquet(f"{path}/data").limit(0)
        shift = F.lit(0)
    else:
        rows = spark.read.parquet(*[p["file"] for p in parts])
        here, shift = F.lit(False), F.lit(None).cast("long")
        for p in parts:
            a = p["from_place"] + max(0, low - p["before"])
            b = p["from_place"] + min(p["n"], high - p["before"])
            same = F.col(RANGE) == p[RANGE]
            here = here | (same & (F.col(PLACE) >= F.lit(a)) & (F.col(PLACE) < F.lit(b)))
            shift = F.when(same, F.lit(p["before"] - p["from_place"])).otherwise(shift)
        rows = rows.where(here)
    rows = rows.orderBy(RANGE, PLACE)
    if row_no:
        rows = rows.withColumn(row_no, (F.col(PLACE) + shift + 1).cast("bigint"))
    return rows.drop(RANGE, PLACE)


def indexed_summary(spark: SparkSession, path: str, number: int, size: int) -> DataFrame:
    """S3 from the index alone: total rows, total pages, first and last row
    number of page ``number``."""
    first = F.lit((number - 1) * size + 1)
    total = F.col("total_rows")
    return read_index(spark, path).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows")).select(
        total, F.ceil(total / F.lit(size)).cast("bigint").alias("total_pages"),
        F.when(total >= first, first).otherwise(F.lit(0)).cast("bigint").alias("first_row"),
        F.least(total, F.lit(number * size).cast("bigint")).alias("last_row"))


def page_of_key(spark: SparkSession, path: str, keys: Sequence[str] | str, values: Sequence, size: int) -> int | None:
    """The number of the page that holds the row with these key values, found
    by the files' bounds and one pruned read; None if there is no such row."""
    names = _keys(keys)
    if len(values) != len(names):
        raise ValueError("a value for every key is needed")
    rows = spark.read.parquet(f"{path}/data")
    for k, v in zip(names, values):
        rows = rows.where(F.col(k).eqNullSafe(F.lit(v)))
    found = rows.select(RANGE, PLACE).limit(1).collect()
    if not found:
        return None
    part = read_index(spark, path).where((F.col(RANGE) == found[0][RANGE]) & (F.col("from_place") <= found[0][PLACE])) \
        .orderBy(F.col("from_place").desc()).first()
    return (part["before"] + found[0][PLACE] - part["from_place"]) // size + 1


def stored_order(spark: SparkSession, path: str, keys: Sequence[str] | str) -> DataFrame:
    """All rows of the index, newest first."""
    return newest_first(spark.read.parquet(f"{path}/data").drop(RANGE, PLACE), keys)
