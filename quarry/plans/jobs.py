"""Batch jobs from a manifest.

The manifest is a small table of job rows read on the driver. Each job is
an independent Spark job (scan -> period -> soft delete -> shape -> sink);
one failure is recorded and the rest go on. Row counts come from an
Observation on the write itself. A job may have a deadline; with
``committed=True`` Parquet and table outputs are versioned datasets, so an
append that failed half-way, or a whole run, can be run again under its id.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import os
import re
import threading
import time
import traceback
from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.functions.casting import cast_lenient
from quarry.plans.dataset import prepare_dataset
from quarry.plans.deadline import Deadline, JobStopped
from quarry.sinks import versions as V
from quarry.sinks import writers as W
from quarry.sinks.writers import (
    PASTE_APPEND, RESULT_FAILED, RESULT_OK, audit_row, audit_write, export_csv, export_parquet, replace_table,
    write_counted,
)
from quarry.spec import DatasetSpec, JobSpec

LOG = logging.getLogger(__name__)

# Manifest words.
TARGET_CSV = "CSV"
TARGET_SHEET = "スプシ"
TARGET_PARQUET = "parquet"
TRUE_WORDS = ("TRUE", "1", "YES")
MONTH_START = "月初"
# The manifest's flag column of each run mode.
MODE_RAW = "raw"
MODE_FLAGS = {"production": "実行対象", "test": "テスト実行", MODE_RAW: "テスト実行"}
# Per-job result lines (the blank after the failure mark is
# U+3000) and the log line layout read by the monitors.
SUCCESS_LINE = "★成功★ {sql} -> {output}"
FAILURE_LINE = "★失敗★　{sql}: {reason}"
LOG_LINE = "{stamp} - {level} - {message}"
SHORT_TIMEOUT = "timeout must be at least 1 second"
TEST_FOLDER = "test"
TEST_SUFFIX = "_test"
# Output name patterns.
NAME_PATTERNS = ("yyyyMMdd_{filename}", "{filename}_yyyy-MM-dd", "{filename}yyyy-MM-dd", "{filename}_yyyyMMddhhmmss",
                 "{filename}_yyyy-MM")
# Date words of the patterns, longest first, as strftime layouts.
STAMP_WORDS = {"yyyyMMddhhmmss": "%Y%m%d%H%M%S", "yyyy-MM-dd": "%Y-%m-%d", "yyyyMMdd": "%Y%m%d", "yyyy-MM": "%Y-%m"}


def select_jobs(manifest: DataFrame, as_of: dt.date, flag: str = "enabled",
                frequency: str = "frequency") -> DataFrame:
    """Rows whose flag is TRUE (any case; 1 and YES too); month-start
    jobs only on day 1."""
    on = F.upper(F.trim(F.col(flag).cast("string"))).isin(*TRUE_WORDS)
    freq_ok = F.coalesce(F.col(frequency), F.lit("")) != MONTH_START if as_of.day != 1 else F.lit(True)
    return manifest.where(on & freq_ok)


def jobs_from_manifest(manifest: DataFrame, as_of: dt.date, columns: Mapping[str, str] | None = None,
                       flag: str = "enabled", frequency: str = "frequency") -> list[JobSpec]:
    """J1's input from a manifest table (CSV, Parquet or a sheet export):
    rows are selected as J2 does, rows with J7 violations are refused, and
    the rest become JobSpecs. ``columns`` maps JobSpec fields to the
    manifest's own column names. A manifest holds one row per job, so the
    selected rows are brought to the driver."""
    names = {f: (columns or {}).get(f, f) for f in JobSpec.__dataclass_fields__}
    present = set(manifest.columns)
    renamed = manifest.select(*[F.col(src).alias(field) for field, src in names.items() if src in present])
    if frequency not in renamed.columns:
        renamed = renamed.withColumn(frequency, F.lit(""))
    chosen = select_jobs(renamed, as_of, flag, frequency) if flag in renamed.columns else renamed
    for field in ("sql_name", "output_name", "target", "sheet_name"):
        if field not in chosen.columns:
            chosen = chosen.withColumn(field, F.lit(""))
    bad = validate_jobs(chosen).collect()
    if bad:
        raise ValueError("manifest problems: " + "; ".join(f"{r['sql_name']}: {r['problem']}" for r in bad))
    truthy = lambda v: str(v).strip().upper() in TRUE_WORDS
    jobs = []
    for row in chosen.collect():
        values = {k: ("" if v is None else v) for k, v in row.asDict().items()}
        for key in ("exclude_deleted", "test"):
            if key in values:
                values[key] = truthy(values[key])
        jobs.append(JobSpec(**{k: (v if isinstance(v, bool) else str(v)) for k, v in values.items()}))
    return jobs


def jobs_for_mode(mode: str, main: DataFrame, raw: DataFrame | None, as_of: dt.date,
                  columns: Mapping[str, str] | None = None, flag: str | None = None) -> list[JobSpec]:
    """The jobs of a run mode: the mode decides which manifest table is read
    and which of its flag columns selects the rows (``flag`` overrides it)."""
    if mode not in MODE_FLAGS:
        raise ValueError(f"unknown mode: {mode!r}")
    manifest = raw if mode == MODE_RAW else main
    if manifest is None:
        raise ValueError(f"mode {mode!r} needs its manifest table")
    return jobs_from_manifest(manifest, as_of, {**(columns or {}), "enabled": flag or MODE_FLAGS[mode]})


def job_file_name(fmt: str, filename: str, now: dt.datetime, ext: str = "") -> str:
    """Output name from a pattern; any other text is the name itself, and
    without one the file name is. The extension of the file name goes, and
    ``ext`` is put on once."""
    base = os.path.splitext(filename)[0]
    if not fmt:
        return base + ext
    if not any(pattern in fmt for pattern in NAME_PATTERNS):
        return os.path.splitext(fmt)[0] + ext if ext and fmt.endswith(ext) else fmt + ext
    words = "|".join(map(re.escape, STAMP_WORDS))
    return re.sub(words, lambda m: now.strftime(STAMP_WORDS[m[0]]), fmt).replace("{filename}", base) + ext


def test_target(job: JobSpec) -> JobSpec:
    """A test job writes beside production: files under ``<path>/test``,
    sheets/tables as ``<name>_test``."""
    if not job.test:
        return job
    from dataclasses import replace
    if job.target == TARGET_SHEET:
        return replace(job, sheet_name=f"{job.sheet_name}{TEST_SUFFIX}")
    return replace(job, save_path=f"{job.save_path.rstrip('/')}/{TEST_FOLDER}")


def validate_jobs(manifest: DataFrame) -> DataFrame:
    """One row per violation: (sql_name, problem)."""
    c = F.col
    blank = lambda name: F.coalesce(F.trim(c(name)), F.lit("")) == ""
    problems = F.array_compact(F.array(
        F.when(blank("sql_name"), F.lit("missing sql name")),
        F.when(blank("output_name"), F.lit("missing output name")),
        F.when((c("target") == TARGET_SHEET) & blank("sheet_name"), F.lit("missing sheet name")),
        F.when(~c("target").isin(TARGET_CSV, TARGET_SHEET, TARGET_PARQUET), F.lit("unknown target")),
        F.when(~blank("timeout_s") & ~F.coalesce(c("timeout_s").try_cast("double") >= 1, F.lit(False)), F.lit(SHORT_TIMEOUT))
        if "timeout_s" in manifest.columns else F.lit(None),
    ))
    return manifest.select(c("sql_name"), F.explode(problems).alias("problem"))


def validate_run_settings(parallelism: int, retries: int, timeout_s: float | None) -> list[str]:
    """J7's run checks; no timeout is no limit."""
    errors = []
    if parallelism < 1:
        errors.append("parallelism must be at least 1")
    if retries < 0:
        errors.append("retries must not be negative")
    if timeout_s is not None and not timeout_s >= 1:
        errors.append(SHORT_TIMEOUT)
    return errors


def output_path(job: JobSpec, out_root: str, now: dt.datetime) -> str:
    """Where a job writes."""
    folder = f"{out_root.rstrip('/')}/{job.save_path.strip('/')}" if job.save_path else out_root.rstrip("/")
    ext = {TARGET_CSV: ".csv", TARGET_PARQUET: ".parquet"}.get(job.target, "")
    name = job_file_name(job.filename_format, job.output_name or job.sql_name, now, ext)
    return f"{folder}/{job.sheet_name or name}" if job.target == TARGET_SHEET else f"{folder}/{name}"


def is_append(job: JobSpec) -> bool:
    return job.target == TARGET_SHEET and job.paste_mode == PASTE_APPEND


def _sink(df: DataFrame, job: JobSpec, spec: DatasetSpec, path: str, txn: str | None = None, allowed=lambda: None) -> int:
    """Write the frame where the job says; the rows written. With ``txn``
    Parquet and tables are committed under it, once."""
    if job.target == TARGET_CSV:
        return write_counted(df, lambda d: export_csv(d, path, types=spec.types, encoding=job.encoding, allowed=allowed))
    if job.target == TARGET_PARQUET and txn:
        W.refuse_plain(df.sparkSession, path)
        return V.publish_version(cast_lenient(df, spec.types), path, txn=txn, allowed=allowed)["rows"]
    if job.target == TARGET_PARQUET:
        return write_counted(df, lambda d: export_parquet(d, path, types=spec.types, allowed=allowed))
    # re-aimed: a sheet becomes a table, appended to or replaced; other paste modes are refused
    if job.target == TARGET_SHEET and txn:
        return W.commit_table(df, path, job.paste_mode, txn, allowed=allowed)
    if job.target == TARGET_SHEET:
        return write_counted(df, lambda d: replace_table(d, path, job.paste_mode, allowed=allowed))
    raise ValueError(f"unknown target: {job.target!r}")


def run_job(spark: SparkSession, job: JobSpec, specs: Mapping[str, DatasetSpec], as_of: dt.date, out_root: str,
            run_id: str, now: dt.datetime | None = None, retries: int = 0, timeout_s: float | None = None,
            txn: str | None = None, stop: threading.Event | None = None) -> tuple[tuple, str]:
    """Run one job: (its audit row, its result line). A job whose source
    fails is tried again up to ``retries`` times; an append only with ``txn``,
    the id it is committed under, as a part of a plain one may have been
    written. All attempts share one deadline; the job's own ``timeout_s``
    comes before the run's."""
    start = dt.datetime.now()
    now = now or start
    job = test_target(job)
    # concurrent jobs share the cluster fairly (FAIR scheduler pool per job)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"job-{job.sql_name}")
    attempts = 1 if is_append(job) and txn is None else 1 + retries
    rows, error = None, ""
    seconds = float(job.timeout_s) if job.timeout_s else timeout_s
    tag = f"quarry-{hashlib.sha1(f'{run_id}:{txn}:{id(job)}'.encode()).hexdigest()}"
    with Deadline(spark, tag, seconds, stop) as deadline:
        for attempt in range(1, attempts + 1):
            try:
                deadline.check()
                spec = specs.get(job.sql_name)
                if spec is None:
                    raise KeyError(f"no dataset named {job.sql_name!r}")
                path = output_path(job, out_root, now)
                df = prepare_dataset(spark, spec, job.period, job.criterion, as_of, job.exclude_deleted, job.category)
                rows, error = _sink(df, job, spec, path, txn, deadline.check), ""
                message = SUCCESS_LINE.format(sql=job.sql_name, output=path.rsplit("/", 1)[-1])
                break
            except Exception as exc:  # one failure must not stop the batch
                try:
                    deadline.check()
                except (TimeoutError, JobStopped) as late:  # the cause of whatever Spark reports
                    exc = late
                LOG.error("job %s failed (attempt %d of %d): %s", job.sql_name, attempt, attempts, exc)
                LOG.debug(traceback.format_exc())
                error = f"{type(exc).__name__}: {exc}"
                message = FAILURE_LINE.format(sql=job.sql_name, reason=error.replace("\n", " "))
                # what the job says is wrong stays wrong, and time that is over stays over
                if isinstance(exc, (KeyError, ValueError, TimeoutError, JobStopped)):
                    break
    ok = not error
    ended = now + (dt.datetime.now() - start)
    row = audit_row(job.display_name or job.sql_name, job.sheet_name, job.main_table, job.category, job.target, rows, ok,
                    error, logged_at=ended, spare=run_id, started_at=now)
    line = LOG_LINE.format(stamp=now.strftime("%Y-%m-%d %H:%M:%S"), level="INFO" if ok else "ERROR", message=message)
    return row, line


def job_txns(jobs: Sequence[JobSpec], run_id: str) -> list[str]:
    """The id that each job of a run commits under: it follows from the run and
    the job alone, so running a part of the jobs again repeats nothing."""
    seen: Counter = Counter()
    out = []
    for job in jobs:
        digest = hashlib.sha1(repr(job).encode()).hexdigest()
        out.append(f"{run_id}:{digest}:{seen[digest]}")
        seen[digest] += 1
    return out


def output_clashes(paths: Sequence[str], jobs: Sequence[JobSpec]) -> list[str]:
    """Outputs that more than one job writes, unless all of them append."""
    writers: dict[str, list[bool]] = {}
    for path, job in zip(paths, jobs):
        writers.setdefault(path, []).append(is_append(job))
    return [f"two jobs write {path}" for path, appends in sorted(writers.items()) if len(appends) > 1 and not all(appends)]


def run_manifest(spark: SparkSession, jobs: Sequence[JobSpec], specs: Mapping[str, DatasetSpec],
                 as_of: dt.date, out_root: str, audit_path: str, run_id: str,
                 parallelism: int = 1, pause_s: float = 0.0, now: dt.datetime | None = None,
                 retries: int = 0, timeout_s: float | None = None, committed: bool = False,
                 stop: threading.Event | None = None) -> DataFrame:
    """Run every job; returns this run's audit rows. Two jobs with one
    output are refused unless both append; those run one after the other. A
    job that is not done after ``timeout_s`` seconds (or its own) is cancelled
    and audited as failed, and so are all that are left once ``stop`` is set.
    ``committed`` makes Parquet and table outputs versioned (readers:
    ``sinks.versions.read_dataset``); appends are then retried, and a run that
    was killed can be run again under its ``run_id``."""
    stamp = now or dt.datetime.now()
    paths = [output_path(test_target(job), out_root, stamp) for job in jobs]
    own = [(job.sql_name, _seconds(job.timeout_s)) for job in jobs if job.timeout_s]
    problems = validate_run_settings(parallelism, retries, timeout_s) + output_clashes(paths, jobs)
    problems += [f"{name}: {SHORT_TIMEOUT}" for name, seconds in own if seconds is None or not seconds >= 1]
    if problems:
        raise ValueError("; ".join(problems))
    txns = job_txns(jobs, run_id) if committed else [None] * len(jobs)
    run = lambda i: run_job(spark, jobs[i], specs, as_of, out_root, run_id, now, retries, timeout_s, txns[i], stop)
    by_path: dict[str, list[int]] = {}
    for i, path in enumerate(paths):
        by_path.setdefault(path, []).append(i)
    results: dict[int, tuple[tuple, str]] = {}
    try:
        if parallelism == 1:
            for i in range(len(jobs)):
                if i and pause_s:
                    time.sleep(pause_s)
                results[i] = run(i)
        else:
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                for done in pool.map(lambda group: [(i, run(i)) for i in group], by_path.values()):
                    results.update(done)
    finally:  # what ran is recorded even if the batch is interrupted: one write per run
        ran = [results[i] for i in sorted(results)]
        if ran:
            audit_write(spark, audit_path, [row for row, _ in ran], run_id)
            # one result line per job (a handful of rows) into the run log
            lines = spark.createDataFrame([(line,) for _, line in ran], "value string")
            lines.coalesce(1).write.mode("overwrite").text(f"{run_log_dir(out_root)}/run={run_id}")
    if not results:
        return spark.createDataFrame([], W.AUDIT_SCHEMA)
    return read_audit(spark, audit_path, run_id)


def _seconds(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def run_log_dir(out_root: str) -> str:
    """Text log of job result lines, one folder per run (read it with
    ``spark.read.text`` and the monitors)."""
    return f"{out_root.rstrip('/')}/_run_log"


def run_one(spark: SparkSession, jobs: Sequence[JobSpec], specs: Mapping[str, DatasetSpec], name: str,
            as_of: dt.date, out_root: str, audit_path: str, run_id: str,
            synonyms: Mapping[str, str] | None = None, now: dt.datetime | None = None) -> DataFrame:
    """Run the jobs matching a display name, main table or SQL name (an
    English synonym maps to a display name)."""
    wanted = (synonyms or {}).get(name, name)
    chosen = [j for j in jobs if wanted in (j.display_name, j.main_table, j.sql_name)]
    if not chosen:
        raise KeyError(f"no job named {name!r}")
    return run_manifest(spark, chosen, specs, as_of, out_root, audit_path, run_id, now=now)


def read_audit(spark: SparkSession, audit_path: str, run_id: str | None = None) -> DataFrame:
    return W.read_audit(spark, audit_path, run_id)


def job_summary(audit: DataFrame) -> DataFrame:
    """Total, succeeded, failed, success rate (0 with no jobs) and the
    seconds from the first start to the last end."""
    ok = F.col("result") == RESULT_OK
    total = F.count(F.lit(1))
    seconds = lambda c: F.unix_seconds(c.cast("timestamp"))
    return audit.agg(
        total.alias("total_jobs"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(F.col("result") == RESULT_FAILED).alias("failed"),
        F.when(total == 0, F.lit(0.0)).otherwise(F.count_if(ok) / total).alias("success_rate"),
        F.coalesce(seconds(F.max("logged_at")) - seconds(F.min("started_at")), F.lit(0)).alias("duration_s"),
    )


def job_details(audit: DataFrame) -> DataFrame:
    """J6's listing: each job's result, rows, seconds and error, in order of
    its start."""
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    return audit.select("display_name", "target", "result", "row_count", "error", "started_at",
                        (seconds("logged_at") - seconds("started_at")).alias("duration_s")) \
        .orderBy("started_at", "display_name")
