"""File sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.operators.paging import newest_first
from quarry.sinks.fs import file_system
from quarry.sinks.versions import read_dataset

# CSV encodings of the reference (Windows Japanese, UTF-8).
CP932 = "windows-31j"
UTF8 = "UTF-8"


def scan_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """A1: a stored dataset, versioned (its newest version) or plain. Column
    choice and the predicate are applied to the lazy scan, so Parquet reads
    only those columns and row groups."""
    df = read_dataset(spark, path) if isinstance(path, str) else spark.read.parquet(*path)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df


def scan_parquet_head(spark: SparkSession, path: str, keys: Sequence[str], n: int,
                      with_total: bool = True) -> DataFrame:
    """A2: the ``n`` newest rows, plus the dataset's total row count as a
    column (a scalar subquery, evaluated once)."""
    df = read_dataset(spark, path)
    head = newest_first(df, keys).limit(n)
    if with_total:
        total = df.agg(F.count(F.lit(1)).alias("total_rows")).scalar()
        head = head.withColumn("total_rows", total)
    return head


def scan_partitioned(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The reference reads a large dataset chunk by chunk; Spark's split
    planning is that chunking, with all chunks in parallel and never an OFFSET
    loop. Split sizes are the session's (``spark.sql.files.maxPartitionBytes``)."""
    return scan_parquet(spark, path, columns)


def scan_csv(spark: SparkSession, path: str, encoding: str = UTF8, header: bool = True,
             schema: str | None = None, sep: str = ",", multiline: bool | None = None) -> DataFrame:
    """CSV with a header in CP932 or UTF-8, quotes doubled, blanks and
    quoted line ends kept. Give ``schema`` in production: inference costs a
    full extra pass. Only files without quoted line ends can be split into
    tasks. Unless ``multiline`` says which it is, files of one split are read
    whole, and larger ones are first looked through, in parallel, for a line
    that ends inside quotes."""
    if multiline is None:
        multiline = _largest_file(spark, path) <= _split_bytes(spark) or has_quoted_line_ends(spark, path)
    reader = spark.read.option("header", header).option("encoding", encoding).option("sep", sep) \
        .option("multiLine", multiline).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path)


def has_quoted_line_ends(spark: SparkSession, path: str) -> bool:
    """Does a line of the CSV files hold an odd number of quotes? With doubled
    quotes that is so exactly where a value goes on over a line end. Quotes
    are one byte in both encodings, and no other character holds that byte."""
    line = F.col("value")
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def _split_bytes(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest data file at ``path`` (a pattern, a file or a folder)."""
    fs, hpath, _ = file_system(spark, path)
    largest = 0
    for status in fs.globStatus(hpath) or []:
        files = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        largest = max([largest, *(f.getLen() for f in files)])
    return largest
