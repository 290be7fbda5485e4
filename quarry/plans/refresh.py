"""Refresh what changed (M1 into J1).

The files that a job reads are listed (path, time of change, size) and compared
with the listing kept from the last time its job succeeded. Only jobs with a
new, changed or vanished file run. The listing is one row per file, comes from
the file system alone and is kept as a versioned dataset.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.plans.jobs import run_manifest
from quarry.session import scratch_path
from quarry.sinks.versions import changes_of, latest_version, publish_version, read_version
from quarry.sinks.writers import AUDIT_SCHEMA, RESULT_OK
from quarry.spec import DatasetSpec, JobSpec

LISTING = "source string, path string, modified timestamp, size bigint"
NEW, CHANGED, GONE = "new", "changed", "gone"


def file_listing(spark: SparkSession, inputs: Mapping[str, Sequence[str]]) -> DataFrame:
    """(source, path, modified, size) of the files under each source's paths.
    Nothing is opened: the columns come from the listing. A versioned dataset
    is listed by its commits' records."""
    parts = [spark.createDataFrame([], LISTING)]
    for source, paths in sorted(inputs.items()):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([changes_of(spark, p) for p in paths])
        parts.append(files.select(F.lit(source).alias("source"), "path", F.col("modificationTime").alias("modified"),
                                  F.col("length").alias("size")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def stored_listing(spark: SparkSession, listing_path: str) -> DataFrame:
    """The listing of the last time, empty before the first."""
    return read_version(spark, listing_path) if latest_version(spark, listing_path) else spark.createDataFrame([], LISTING)


def changed_files(before: DataFrame, now: DataFrame) -> DataFrame:
    """(source, path, change): files that are new, changed or gone."""
    b = before.select("source", "path", F.struct("modified", "size").alias("was"))
    n = now.select("source", "path", F.struct("modified", "size").alias("is"))
    change = F.when(F.col("was").isNull(), NEW).when(F.col("is").isNull(), GONE).when(F.col("was") != F.col("is"), CHANGED)
    return n.join(b, ["source", "path"], "full").select("source", "path", change.alias("change")).where("change is not null")


def refresh(spark: SparkSession, jobs: Sequence[JobSpec], specs: Mapping[str, DatasetSpec],
            inputs: Mapping[str, Sequence[str]], listing_path: str, as_of: dt.date, out_root: str, audit_path: str,
            run_id: str, **run_settings) -> DataFrame:
    """Run the jobs whose inputs (files by SQL name) changed since they last
    succeeded, and jobs whose inputs are not named; returns their audit rows. A
    file that changes while its job runs is seen the next time, as the listing
    is taken before. A failed job keeps its old listing and runs again."""
    seen = scratch_path(spark, "listing")
    file_listing(spark, inputs).write.parquet(seen)
    now, before = spark.read.parquet(seen), stored_listing(spark, listing_path)
    touched = {r["source"] for r in changed_files(before, now).select("source").distinct().collect()}  # names of jobs
    due = [job for job in jobs if job.sql_name in touched or job.sql_name not in inputs]
    if not due:
        return spark.createDataFrame([], AUDIT_SCHEMA)
    audit = run_manifest(spark, due, specs, as_of, out_root, audit_path, run_id, **run_settings)
    named = {job.display_name or job.sql_name: job.sql_name for job in due}
    failed = {named[r["display_name"]] for r in audit.where(F.col("result") != RESULT_OK).select("display_name").collect()}
    old = F.col("source").isin(sorted(failed))
    publish_version(before.where(old).unionByName(now.where(~old)), listing_path)
    return audit
