"""Versioned datasets: publish that never shows a gap, appends that may be repeated.

A versioned dataset is a folder with

* ``_data/quarry_commit=<name>/``: the files of one write, never changed, and
* ``_versions/<number>``: one small record per commit, made only if absent.

A commit replaces the data or appends to it. A reader takes the records from
the last replacing one on and reads the folders they name, so it sees either
the state before a commit or after it. What a killed job wrote has no record
and is ignored. Both names begin with an underscore: a plain read of the folder
finds no data instead of a mixture of versions.

* ``publish_version`` replaces: it commits the number after the one it began
  from. If another publisher was first, it raises ``ConcurrentPublish`` and its
  files go.
* ``append_version`` appends under the next free number; appends never collide.
  With ``txn`` (the id of a run and job, say) an append that is already
  committed is not done again, so a failed job can simply be run again (as long
  as the commit's record is kept).
* ``prune_versions`` deletes what no reader needs: versions beyond the last
  ``keep``, and folders without a record, once they are old enough.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.sinks.fs import create_if_absent, delete, modified_at, names_in, path_exists, read_text, write_counted

COMMIT = "quarry_commit"
REPLACE, APPEND = "replace", "append"


class ConcurrentPublish(RuntimeError):
    """Another publisher of the same target was first."""


def _records_dir(target: str) -> str:
    return f"{target.rstrip('/')}/_versions"


def _data_dir(target: str) -> str:
    return f"{target.rstrip('/')}/_data"


def is_versioned(spark: SparkSession, target: str) -> bool:
    """Is there a versioned dataset, or what a writer of one has begun?"""
    return path_exists(spark, _records_dir(target)) or path_exists(spark, _data_dir(target))


def version_numbers(spark: SparkSession, target: str) -> list[int]:
    return sorted(int(n) for n in names_in(spark, _records_dir(target)) if n.isdigit())


def latest_version(spark: SparkSession, target: str) -> int:
    """The newest version's number; 0 if there is none."""
    return max(version_numbers(spark, target), default=0)


def _record(spark: SparkSession, target: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{_records_dir(target)}/{number:012d}")) | {"number": number}


def _state(spark: SparkSession, target: str, number: int | None = None) -> list[dict]:
    """The records that make up a version, oldest first."""
    found = []
    for n in reversed([n for n in version_numbers(spark, target) if number is None or n <= number]):
        found.append(_record(spark, target, n))
        if found[-1]["mode"] == REPLACE:
            break
    return found[::-1]


def version_folders(spark: SparkSession, target: str, number: int | None = None) -> list[str]:
    """The folders whose files make up a version."""
    return [f"{_data_dir(target)}/{COMMIT}={r['folder']}" for r in _state(spark, target, number)]


def changes_of(spark: SparkSession, path: str) -> str:
    """Where a listing sees a dataset change: the records of a versioned one,
    else the dataset itself."""
    return _records_dir(path) if path_exists(spark, _records_dir(path)) else path


def version_schema(spark: SparkSession, target: str) -> StructType | None:
    """The columns of the newest version, None without one."""
    state = _state(spark, target)
    return StructType.fromJson(state[0]["schema"]) if state else None


def read_version(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The newest version, or the state after commit ``number``."""
    state = _state(spark, target, number)
    if not state or (number is not None and state[-1]["number"] != number):
        raise FileNotFoundError(f"{target} has no version{'' if number is None else f' {number}'}")
    schema = StructType.fromJson(state[0]["schema"])
    folders = [f"{_data_dir(target)}/{COMMIT}={r['folder']}" for r in state]
    rows = spark.read.schema(StructType([*schema.fields, StructField(COMMIT, StringType())])).option("basePath", _data_dir(target)).parquet(*folders)
    return rows.select(*[rows[f"`{f.name}`"] for f in schema.fields])


def version_log(spark: SparkSession, target: str) -> DataFrame:
    """(version, mode, txn, row_count, committed_at): the commits that are kept."""
    rows = [(r["number"], r["mode"], r["txn"], r["rows"], r["at"]) for r in
            (_record(spark, target, n) for n in version_numbers(spark, target))]
    return spark.createDataFrame(rows, "version long, mode string, txn string, row_count long, at double") \
        .select("version", "mode", "txn", "row_count", F.timestamp_seconds("at").alias("committed_at"))


def _done(spark: SparkSession, target: str, txn: str | None) -> dict | None:
    if txn is None:
        return None
    records = (_record(spark, target, n) for n in reversed(version_numbers(spark, target)))
    return next((r for r in records if r["txn"] == txn), None)


def _written(df: DataFrame, target: str, partition_by: Sequence[str] | None, options: Mapping[str, str] | None) -> tuple[str, int]:
    """Write the files of a commit: (its folder's name, rows)."""
    name = f"c-{uuid.uuid4().hex}"

    def write(frame: DataFrame) -> None:
        writer = frame.write.mode("errorifexists").options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{_data_dir(target)}/{COMMIT}={name}")

    return name, write_counted(df, write)


def _commit(df: DataFrame, target: str, number: int, mode: str, folder: str, rows: int, txn: str | None) -> dict | None:
    """The record, if this number was still free."""
    record = {"mode": mode, "folder": folder, "rows": rows, "txn": txn, "at": time.time(), "schema": json.loads(df.schema.json())}
    made = create_if_absent(df.sparkSession, f"{_records_dir(target)}/{number:012d}", json.dumps(record))
    return record | {"number": number} if made else None


def publish_version(df: DataFrame, target: str, txn: str | None = None, expect: int | None = None,
                    partition_by: Sequence[str] | None = None, options: Mapping[str, str] | None = None,
                    allowed=lambda: None) -> dict:
    """Replace the data of ``target``; returns the commit's record. ``expect``
    is the version that the frame was made from (default: the newest one when
    the call begins); a publisher that finds another one there raises.
    ``allowed`` is called before the commit and may raise (a deadline)."""
    spark = df.sparkSession
    done = _done(spark, target, txn)
    if done:
        return done
    base = latest_version(spark, target) if expect is None else expect
    folder, rows = _written(df, target, partition_by, options)
    allowed()
    record = _commit(df, target, base + 1, REPLACE, folder, rows, txn)
    if record is None:
        delete(spark, f"{_data_dir(target)}/{COMMIT}={folder}")
        raise ConcurrentPublish(f"version {base + 1} of {target} was published by another writer")
    return record


def append_version(df: DataFrame, target: str, txn: str | None = None, partition_by: Sequence[str] | None = None,
                   options: Mapping[str, str] | None = None, allowed=lambda: None) -> dict:
    """Append to ``target`` under its columns (made with the frame's when
    new); returns the commit's record, that of an earlier commit if ``txn``
    is done already."""
    spark = df.sparkSession
    done = _done(spark, target, txn)
    if done:
        return done
    schema = version_schema(spark, target)
    if schema is not None:
        df = fitted(df, schema)
    folder, rows = _written(df, target, partition_by, options)
    allowed()
    while True:
        number = latest_version(spark, target) + 1
        done = _done(spark, target, txn)  # the same job, run twice at once; whoever commits after this look takes the number
        if done:
            delete(spark, f"{_data_dir(target)}/{COMMIT}={folder}")
            return done
        record = _commit(df, target, number, APPEND, folder, rows, txn)
        if record:
            return record


def prune_versions(spark: SparkSession, target: str, keep: int = 2, older_than_s: float = 86_400) -> list[int]:
    """Delete records and files that the last ``keep`` replaced states do not
    need, and files without a record, if older than ``older_than_s`` (give
    it the longest time a reader or a job takes). Returns the numbers deleted."""
    if keep < 1:
        raise ValueError("at least the newest version is kept")
    numbers = version_numbers(spark, target)
    replacing, needed, cut_off = 0, [], time.time() - older_than_s
    for n in reversed(numbers):
        record = _record(spark, target, n)
        if replacing < keep or record["at"] > cut_off:
            needed.append(record)
        replacing += record["mode"] == REPLACE
    kept = {r["number"] for r in needed}
    gone = [n for n in numbers if n not in kept]
    for n in gone:
        delete(spark, f"{_records_dir(target)}/{n:012d}")
    folders = {f"{COMMIT}={r['folder']}" for r in needed}
    for name in names_in(spark, _data_dir(target)):
        if name not in folders and modified_at(spark, f"{_data_dir(target)}/{name}") < cut_off:
            delete(spark, f"{_data_dir(target)}/{name}")
    return gone


def fitted(df: DataFrame, header: StructType) -> DataFrame:
    """``df`` with the columns and types of ``header``; a frame that lacks a
    column, or brings one the table does not have, is refused."""
    missing = [f.name for f in header.fields if f.name not in df.columns]
    unknown = [c for c in df.columns if c not in header.names]
    if missing or unknown:
        raise ValueError(f"columns do not fit the table: missing {missing}, unknown {unknown}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in header.fields])


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A stored dataset, versioned or a plain Parquet folder."""
    return read_version(spark, path) if is_versioned(spark, path) else spark.read.parquet(path)
