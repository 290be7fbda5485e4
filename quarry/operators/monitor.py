"""Freshness and error monitoring over logs and audit data (M1-M8).

A log is a frame of text lines (``spark.read.text`` gives a ``value``
column); the timestamp sits in the first 19 characters. All rules are
filters, regex extractions and small aggregates.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, functions as F

from quarry.sinks.fs import names_in
from quarry.sinks.versions import changes_of

# Words that mark an error line.
ERROR_WORDS = ("ERROR", "エラー", "失敗")
# Error classes (first match wins), as Java/RE2 regexes;
# matched without regard to case, as the log scanner's Select-String does.
DATABASE_PATTERN = "データベース接続|MySQL Connection|Lost connection"
API_PATTERN = "APIError|API"
CLASS_DATABASE, CLASS_API, CLASS_OTHER = "database", "api", "other"
# Failed-job marker; the blank after it may be U+3000.
FAILED_JOB_PATTERN = "★失敗★[\\s　]+([^:]+):"
# Record count and table name in run output, with fallback.
RECORDS_PATTERN = "(\\d+) レコード処理完了"
RECORDS_FALLBACK = "(\\d+) レコード"
# (word characters in the Unicode sense, as the run-output parser reads them)
TABLE_PATTERN = "処理完了: ([\\p{L}\\p{N}_]+)"
# Log timestamp layout and width.
LOG_TS_LAYOUT = "yyyy-MM-dd HH:mm:ss"
LOG_TS_WIDTH = 19
# Severity bands by error count (0 none, <5 low, <20 medium).
SEVERITY_NONE, SEVERITY_LOW, SEVERITY_MEDIUM, SEVERITY_HIGH = "none", "low", "medium", "high"
LOW_LIMIT, MEDIUM_LIMIT = 5, 20
# Freshness bands (<1 h, <24 h, older) and their texts.
FRESH_HOURS, FAIRLY_FRESH_HOURS = 1, 24
FRESH_TEXT = "データは最新です"
FAIRLY_FRESH_TEXT = "データは比較的新しいです"
OLD_TEXT = "データが古い可能性があります"


def _ts_literal(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_log(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines with ``line``, ``ts`` (null when the first 19 characters are not
    a timestamp) and ``is_error``."""
    line = F.col(text)
    head = F.substring(line, 1, LOG_TS_WIDTH)
    # the shape test makes the cast exact (and exception-free)
    ts = F.when(head.rlike("^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}$"),
                head.try_cast("timestamp_ntz")).cast("timestamp_ntz")
    is_error = line.contains(ERROR_WORDS[0])
    for word in ERROR_WORDS[1:]:
        is_error = is_error | line.contains(word)
    return lines.select(line.alias("line"), ts.alias("ts"), is_error.alias("is_error"))


def recent_errors(log: DataFrame, as_of: dt.datetime, hours: float = 1) -> DataFrame:
    """M3: error lines newer than ``as_of - hours``; lines without a valid
    timestamp are skipped."""
    cutoff = as_of - dt.timedelta(hours=hours)
    return log.where(F.col("is_error") & F.col("ts").isNotNull() & (F.col("ts") > _ts_literal(cutoff))) \
        .select("ts", "line")


def error_class(line: Column) -> Column:
    """M4's classifier: database, else API, else other (first match)."""
    return F.when(line.rlike("(?i)" + DATABASE_PATTERN), F.lit(CLASS_DATABASE)) \
        .when(line.rlike("(?i)" + API_PATTERN), F.lit(CLASS_API)).otherwise(F.lit(CLASS_OTHER))


def error_classes(errors: DataFrame) -> DataFrame:
    """M4: error count per class; the classes sum to the total."""
    return errors.groupBy(error_class(F.col("line")).alias("error_class")) \
        .agg(F.count(F.lit(1)).alias("n_errors"))


def failed_jobs(errors: DataFrame) -> DataFrame:
    """M5: distinct job names named by failure lines, sorted."""
    name = F.regexp_extract(F.col("line"), FAILED_JOB_PATTERN, 1)
    return errors.select(F.trim(name).alias("job")).where(F.col("job") != "").distinct().orderBy("job")


def severity(count: Column) -> Column:
    """M6: none / low / medium / high by error count."""
    return F.when(count == 0, F.lit(SEVERITY_NONE)).when(count < LOW_LIMIT, F.lit(SEVERITY_LOW)) \
        .when(count < MEDIUM_LIMIT, F.lit(SEVERITY_MEDIUM)).otherwise(F.lit(SEVERITY_HIGH))


def error_severity(errors: DataFrame, by: Column | None = None) -> DataFrame:
    """M6 over error lines: the count (per ``by`` group if given) and its band."""
    if by is None:
        counts = errors.agg(F.count(F.lit(1)).alias("n_errors"))
    else:
        counts = errors.groupBy(by.alias("bucket")).agg(F.count(F.lit(1)).alias("n_errors"))
    return counts.withColumn("severity", severity(F.col("n_errors")))


def latest_errors(errors: DataFrame, n: int = 5) -> DataFrame:
    """M7: the ``n`` newest error lines (a top-k: one small sort per task)."""
    return errors.orderBy(F.col("ts").desc(), F.col("line").desc()).limit(n)


def first_errors(errors: DataFrame, n: int = 3) -> DataFrame:
    """M7's preview form: the ``n`` oldest error lines of the window."""
    return errors.orderBy(F.col("ts").asc(), F.col("line").asc()).limit(n)


def output_record_counts(log: DataFrame) -> DataFrame:
    """M8: record counts and table names reported in run output."""
    line = F.col("line")
    first = F.nullif(F.regexp_extract(line, RECORDS_PATTERN, 1), F.lit(""))
    fallback = F.nullif(F.regexp_extract(line, RECORDS_FALLBACK, 1), F.lit(""))
    table = F.nullif(F.regexp_extract(line, TABLE_PATTERN, 1), F.lit(""))
    return log.select("ts", F.coalesce(first, fallback).cast("bigint").alias("records"), table.alias("table_name")) \
        .where(F.col("records").isNotNull() | F.col("table_name").isNotNull())


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(3.6e9)


def last_update(df: DataFrame, name: str | Column, ts: str | Column) -> DataFrame:
    """Newest timestamp per dataset (a partial aggregate, then a shuffle of
    one row per dataset per task)."""
    name_col = F.col(name) if isinstance(name, str) else name
    ts_col = F.col(ts) if isinstance(ts, str) else ts
    return df.groupBy(name_col.alias("dataset")).agg(F.max(ts_col).cast("timestamp_ntz").alias("last_modified"))


def stale_datasets(df: DataFrame, name: str | Column, ts: str | Column, as_of: dt.datetime,
                   hours: float = 24) -> DataFrame:
    """M1: datasets whose newest update is more than ``hours`` before ``as_of``."""
    latest = last_update(df, name, ts)
    age = hours_between(_ts_literal(as_of), F.col("last_modified"))
    return latest.select("dataset", "last_modified", age.alias("age_hours")).where(F.col("age_hours") > hours)


def freshness_band(age_hours: Column) -> Column:
    """M2: the freshness text for an age in hours."""
    return F.when(age_hours < FRESH_HOURS, F.lit(FRESH_TEXT)) \
        .when(age_hours < FAIRLY_FRESH_HOURS, F.lit(FAIRLY_FRESH_TEXT)).otherwise(F.lit(OLD_TEXT))


def file_freshness(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """M1 on stored files: newest modification time of a file-backed frame's
    files, one row per file from the file listing; no content is read."""
    files = df.sparkSession.read.format("binaryFile").load(df.inputFiles())
    latest = files.agg(F.max("modificationTime").cast("timestamp_ntz").alias("last_modified"))
    age = hours_between(_ts_literal(as_of), F.col("last_modified"))
    return latest.select("last_modified", age.alias("age_hours"), freshness_band(age).alias("freshness"))


def stale_files(spark, folder: str, as_of: dt.datetime, hours: float = 24) -> DataFrame:
    """M1 over a folder of stored datasets (``<name>.parquet``, each a file or
    a folder of part files, partitioned or not): datasets whose newest file was
    modified more than ``hours`` before ``as_of``. One row per file comes from
    the file listing; no content is read. Of a versioned dataset the commits'
    records count, as its files are hidden from listings."""
    root = folder.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet").load(root).select("path", "modificationTime")
    datasets = [f"{root}/{name}" for name in names_in(spark, root) if name.endswith(".parquet")]
    records = [changed for path in datasets if (changed := changes_of(spark, path)) != path]
    if records:
        files = files.unionByName(spark.read.format("binaryFile").load(records).select("path", "modificationTime"))
    below = F.element_at(F.split(F.col("path"), re.escape(root.split(":", 1)[-1].lstrip("/")) + "/"), 2)
    return stale_datasets(files, F.regexp_extract(below, r"^(.*?\.parquet)(/|$)", 1),
                          F.col("modificationTime").cast("timestamp_ntz"), as_of, hours)
