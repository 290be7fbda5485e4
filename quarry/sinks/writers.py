"""Sinks (W1-W10) and the publish step.

Every file sink writes into a staging directory next to the target and then
swaps it in (``publish``), so a failed job leaves the previous version intact
and no half-written dataset is ever visible. Writes run on the executors, one
file per task; a single output file happens only on explicit request.

``publish`` is for one writer per target: between its two renames the target is
absent for a moment, and two publishers of one target could undo each other.
``run_manifest`` therefore refuses two jobs with one output. Parquet targets
can be versioned instead (``versioned=True``, ``txn=...``; ``sinks.versions``):
readers never see a gap, the slower of two publishers raises, and an append
may be repeated. A target that is versioned stays so.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quarry.functions.casting import cast_lenient, csv_prepare, drop_empty_rows, lenient_problems
from quarry.functions.filters import apply_filters
from quarry.sinks import versions as V
from quarry.sinks.fs import file_system as _fs, path_exists, write_counted
from quarry.session import scratch_path
from quarry.sources.files import CP932, UTF8, scan_csv
from quarry.spec import FilterSpec

# Sheet paste modes and the audit result words.
PASTE_APPEND = "最終行積立て"
PASTE_REPLACE = "全張替え"
RESULT_OK = "成功"
RESULT_FAILED = "失敗"
AUDIT_SCHEMA = ("display_name string, sheet string, main_table string, category string, target string, "
                "row_count bigint, result string, error string, logged_at timestamp_ntz, spare string, "
                "started_at timestamp_ntz")
BOM = "\ufeff"
REJECT_RAW, REJECT_PROBLEMS = "quarry_raw", "quarry_problems"  # columns of the working copy
# Export file stamp and name.
STAMP_LAYOUT = "%Y-%m-%d-%H%M%S"
EXPORT_NAME = "{stamp}_{suffix}.csv"


# --- publish -----------------------------------------------------------------

def staging_path(target: str) -> str:
    return f"{target.rstrip('/')}.staging-{uuid.uuid4().hex}"


def _recover(fs, tgt, jvm, target: str) -> None:
    """Finish a swap that a crash interrupted: with no target but a version
    moved aside, put the newest one back; with both, drop the aside ones."""
    aside = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-*")) or []
    aside = sorted(aside, key=lambda st: st.getModificationTime())
    if aside and not fs.exists(tgt):
        fs.rename(aside.pop().getPath(), tgt)
    for st in aside:
        fs.delete(st.getPath(), True)


def publish(spark: SparkSession, staging: str, target: str) -> str:
    """Swap ``staging`` in as ``target``: the old version is moved aside,
    the new one renamed in, the old one deleted. A swap cut short by a
    driver failure is completed on the next publish."""
    fs, tgt, jvm = _fs(spark, target)
    stg = jvm.org.apache.hadoop.fs.Path(staging)
    parent = tgt.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    _recover(fs, tgt, jvm, target)
    old = None
    if fs.exists(tgt):
        old = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
        if not fs.rename(tgt, old):
            raise OSError(f"could not move {target} aside")
    if not fs.rename(stg, tgt):
        if old is not None:
            fs.rename(old, tgt)
        raise OSError(f"could not publish {staging} as {target}")
    if old is not None:
        fs.delete(old, True)
    return target


# --- CSV ---------------------------------------------------------------------

def _csv_writer(df: DataFrame, encoding: str, header: bool, sep: str, chunk_rows: int | None):
    writer = df.write.mode("overwrite").option("header", header).option("encoding", encoding) \
        .option("sep", sep).option("emptyValue", "").option("nullValue", "") \
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if chunk_rows:
        writer = writer.option("maxRecordsPerFile", str(chunk_rows))
    return writer


def export_csv(df: DataFrame, path: str, types: Mapping[str, str] | None = None,
               encoding: str = UTF8, header: bool = True, sep: str = ",",
               chunk_rows: int | None = None, single_file: bool = False,
               prepare: bool = True, bom: bool = False, skip_empty: bool = False, allowed=lambda: None) -> str | None:
    """Clean (T6-T9) and write CSV with a header, then publish.

    CP932 output (``encoding=CP932``) replaces characters it cannot encode,
    as the reference's ``errors='replace'`` does. Empty text is written as
    nothing, like pandas. ``bom=True`` (UTF-8 only) starts every file with a
    byte-order mark: each part file begins with its header line, so the mark
    rides on the first column's name. ``skip_empty=True`` publishes nothing
    (and returns None) when the result has no rows; the rows are counted on
    the write itself, not by a separate job."""
    out = csv_prepare(df, types or {}) if prepare else df
    if bom:
        if not header or encoding.upper().replace("-", "") != "UTF8":
            raise ValueError("a byte-order mark needs UTF-8 output with a header")
        first = out.columns[0]
        out = out.withColumnRenamed(first, BOM + first)
    if single_file:  # a shuffle: only the writing is one task, not all that comes before
        out = out.repartition(1)
    stage = staging_path(path)
    rows = write_counted(out, lambda d: _csv_writer(d, encoding, header, sep, chunk_rows).csv(stage))
    if skip_empty and rows == 0:
        fs, hstage, _ = _fs(df.sparkSession, stage)
        fs.delete(hstage, True)
        return None
    allowed()
    return publish(df.sparkSession, stage, path)


def export_csv_chunked(df: DataFrame, path: str, chunk_rows: int | None = None, **kwargs) -> str:
    """As W1 in several files, each with its header; no row is lost
    between them. By default every task writes one part, so parts follow the
    size of the splits; ``chunk_rows`` asks for parts of so many rows at most."""
    return export_csv(df, path, chunk_rows=chunk_rows, **kwargs)


def export_csv_merged(df: DataFrame, path: str, keys: Sequence[str] = (), types: Mapping[str, str] | None = None,
                      encoding: str = UTF8, sep: str = ",", chunk_rows: int | None = None, prepare: bool = True,
                      bom: bool = False) -> str:
    """W2 as one file: parts are written by all tasks, in the order of ``keys``
    (newest first) if given, and joined on the file system under one header.
    HDFS joins files by name alone; other file systems are copied part by part
    through a small buffer. No task holds more than its own part."""
    spark = df.sparkSession
    rows = newest_ranges(df, keys) if keys else df
    out = csv_prepare(rows, types or {}) if prepare else rows
    if bom and encoding.upper().replace("-", "") != "UTF8":
        raise ValueError("a byte-order mark needs UTF-8 output")
    stage = staging_path(path)
    _csv_writer(out, encoding, False, sep, chunk_rows).csv(stage)
    names = [BOM + c if bom and not i else c for i, c in enumerate(out.columns)]
    one = spark.createDataFrame([tuple(names)], T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]))
    _csv_writer(one.coalesce(1), encoding, False, sep, None).csv(f"{stage}-header")
    parts = [_part_files(spark, f"{stage}-header"), _part_files(spark, stage)]
    joined = f"{stage}-joined"
    join_files(spark, [p for group in parts for p in group], joined)
    fs, hstage, jvm = _fs(spark, stage)
    publish(spark, joined, path)
    for leftover in (stage, f"{stage}-header"):
        fs.delete(jvm.org.apache.hadoop.fs.Path(leftover), True)
    return path


def _part_files(spark: SparkSession, folder: str) -> list[str]:
    """The part files of a written folder in the order of their tasks."""
    fs, hfolder, _ = _fs(spark, folder)
    found = [st.getPath() for st in fs.listStatus(hfolder) if st.getLen() > 0]
    return [p.toString() for p in sorted(found, key=lambda p: p.getName()) if p.getName().startswith("part-")]


def join_files(spark: SparkSession, parts: Sequence[str], target: str) -> None:
    """One file with the bytes of ``parts`` in order."""
    fs, htarget, jvm = _fs(spark, target)
    path = jvm.org.apache.hadoop.fs.Path
    out = fs.create(htarget, True)
    if fs.getScheme() == "hdfs":
        out.close()
        paths = spark.sparkContext._gateway.new_array(path, len(parts))
        for i, part in enumerate(parts):
            paths[i] = path(part)
        fs.concat(htarget, paths)
        return
    try:
        for part in parts:
            source = fs.open(path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()


def export_tsv(df: DataFrame, path: str, **kwargs) -> str:
    """Tab-separated text (the current page, typically)."""
    return export_csv(df, path, sep="\t", **kwargs)


# --- Parquet -----------------------------------------------------------------

def export_parquet(df: DataFrame, path: str, types: Mapping[str, str] | None = None,
                   compression: str = "snappy", partition_by: Sequence[str] | None = None, versioned: bool = False,
                   bloom_columns: Mapping[str, int] | Sequence[str] = (), allowed=lambda: None) -> str:
    """Lenient typing (T2), Parquet, publish. Nulls stay null.
    ``versioned`` publishes a version; ``allowed`` is called before the
    publish and may raise. ``bloom_columns`` (with the number of different
    values that a row group may hold, if known) get Bloom filters, so that an
    equality filter (F4-F7, F14) for a value that a row group does not hold
    skips it even where the value lies between its bounds."""
    out = cast_lenient(df, types or {})
    options = {"compression": compression} | bloom_options(bloom_columns)
    _publish_parquet(out, path, options, partition_by, versioned, allowed)
    return path


def bloom_options(columns: Mapping[str, int] | Sequence[str]) -> dict[str, str]:
    """Write options for Bloom filters; without a number of values the filter's
    size is chosen from what the row group holds."""
    options = {}
    for name in columns:
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        if isinstance(columns, Mapping):
            options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(columns[name])
        else:
            options[f"parquet.bloom.filter.adaptive.enabled#{name}"] = "true"
    return options


def export_parquet_checked(df: DataFrame, path: str, rejects_path: str, types: Mapping[str, str],
                           versioned: bool = False) -> tuple[int, int]:
    """W3 with T2's losses kept: rows whose values all fit their types go to
    ``path``, typed; rows with a value that does not go to ``rejects_path`` as
    they came, with ``problems`` (column and value each). Every row is in one
    of the two. The source is read once, into a working copy that both are
    written from. Returns (rows, rejected rows)."""
    spark = df.sparkSession
    clash = {REJECT_RAW, REJECT_PROBLEMS, "problems"} & set(df.columns)
    if clash:
        raise ValueError(f"columns named like those of the rejects: {sorted(clash)}")
    problems = lenient_problems(df, types)
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    marked = df.select(*[F.col(f"`{c}`") for c in df.columns], problems.alias(REJECT_PROBLEMS),
                       F.when(F.size(problems) > 0, raw).alias(REJECT_RAW))
    copy = scratch_path(spark, "checked")
    cast_lenient(marked, types).write.parquet(copy)
    both = spark.read.parquet(copy)
    good = both.where(F.col(REJECT_RAW).isNull()).select(*[F.col(f"`{c}`") for c in df.columns])
    bad = both.where(F.col(REJECT_RAW).isNotNull()).select(f"{REJECT_RAW}.*", F.col(REJECT_PROBLEMS).alias("problems"))
    counts = []
    for rows, target in ((bad, rejects_path), (good, path)):  # the rejects first: good rows alone would look complete
        counts.append(write_counted(rows, lambda d, t=target: _publish_parquet(d, t, {}, None, versioned)))
    fs, hcopy, _ = _fs(spark, copy)
    fs.delete(hcopy, True)
    return counts[1], counts[0]


def _publish_parquet(out: DataFrame, path: str, options: Mapping[str, str], partition_by: Sequence[str] | None,
                     versioned: bool, allowed=lambda: None) -> None:
    spark = out.sparkSession
    if versioned or V.is_versioned(spark, path):
        refuse_plain(spark, path)
        V.publish_version(out, path, partition_by=partition_by, options=options, allowed=allowed)
        return
    stage = staging_path(path)
    writer = out.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(stage)
    allowed()
    publish(spark, stage, path)


def refuse_plain(spark: SparkSession, path: str) -> None:
    """Versions and plain files never share a folder."""
    if not V.is_versioned(spark, path) and path_exists(spark, path):
        raise ValueError(f"{path} is a plain dataset; versions need a path of their own")


def export_parquet_newest(df: DataFrame, path: str, keys: Sequence[str],
                          types: Mapping[str, str] | None = None, partitions: int | None = None,
                          compression: str = "snappy", versioned: bool = False) -> str:
    """Parquet whose files and rows run newest-first: a range
    partitioning on the descending key (sampled bounds, no single-task sort)
    and a sort inside each partition. Without ``partitions`` the exchange has
    the session's number, and adaptive execution joins neighbouring ranges by
    the bytes that were really shuffled; a hash of the row after the keys lets
    one very common key value spread over several files."""
    out = newest_ranges(cast_lenient(df, types or {}), keys, partitions)
    _publish_parquet(out, path, {"compression": compression}, None, versioned)
    return path


def newest_ranges(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` in ranges of the descending key, sorted inside each."""
    order = [F.col(k).desc_nulls_last() for k in keys]
    order.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc())
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


# --- tables ------------------------------------------------------------------

def under_header(df: DataFrame, path: str) -> DataFrame:
    """``df`` with the columns and types of the table at ``path``; a frame
    that lacks a column, or brings one the table does not have, is refused."""
    return V.fitted(df, df.sparkSession.read.parquet(path).schema)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, txn: str | None = None) -> str:
    """Append to a Parquet table under its header; created with the
    frame's schema when new. With ``txn``, the id of this append (a run and
    job, say), the table is a versioned one and an append may be repeated:
    what a failed attempt left is ignored, and one that is done is not done
    again."""
    spark = df.sparkSession
    if txn is not None or V.is_versioned(spark, path):
        commit_table(df, path, PASTE_APPEND, txn, partition_by)
        return path
    if path_exists(spark, path):
        df = under_header(df, path)
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def replace_table(df: DataFrame, path: str, mode: str = PASTE_REPLACE, versioned: bool = False, allowed=lambda: None) -> str:
    """Replace a table's data, keeping its columns. Paste modes other
    than replace/append are refused (the reference silently wrote nothing)."""
    check_mode(mode)
    spark = df.sparkSession
    if versioned or V.is_versioned(spark, path):
        commit_table(df, path, mode, allowed=allowed)
        return path
    if mode in (PASTE_APPEND, "append"):
        return append_table(df, path)
    out = under_header(df, path) if path_exists(spark, path) else df
    _publish_parquet(out, path, {}, None, False, allowed)
    return path


def check_mode(mode: str) -> None:
    if mode not in (PASTE_APPEND, "append", PASTE_REPLACE, "overwrite"):
        raise ValueError(f"unknown paste mode: {mode!r}")


def commit_table(df: DataFrame, path: str, mode: str = PASTE_REPLACE, txn: str | None = None,
                 partition_by: Sequence[str] | None = None, allowed=lambda: None) -> int:
    """W6 and W7 on a versioned table: append or replace under its columns, as
    one commit; the rows of the commit (of the earlier one, if ``txn`` is done)."""
    check_mode(mode)
    spark = df.sparkSession
    refuse_plain(spark, path)
    if mode in (PASTE_APPEND, "append"):
        return V.append_version(df, path, txn=txn, partition_by=partition_by, allowed=allowed)["rows"]
    header = V.version_schema(spark, path)
    out = df if header is None else V.fitted(df, header)
    return V.publish_version(out, path, txn=txn, partition_by=partition_by, allowed=allowed)["rows"]


def load_csv_to_table(spark: SparkSession, mapping: Mapping[str, str], encoding: str = CP932,
                      schemas: Mapping[str, str] | None = None) -> dict[str, str]:
    """Each ``csv path = target`` entry is read (A9) and replaces the
    target's data under its existing columns (W7)."""
    done = {}
    for source, target in mapping.items():
        schema = (schemas or {}).get(source)
        done[source] = replace_table(scan_csv(spark, source, encoding=encoding, schema=schema), target)
    return done


# --- audit -------------------------------------------------------------------

def audit_row(display_name: str, sheet: str, main_table: str, category: str, target: str, row_count: int | None,
              ok: bool, error: str = "", logged_at: dt.datetime | None = None, spare: str = "",
              started_at: dt.datetime | None = None) -> tuple:
    """One row of the audit table; ``started_at`` defaults to ``logged_at``."""
    stamp = (logged_at or dt.datetime.now()).replace(microsecond=0)
    return (display_name, sheet, main_table, category, target, row_count, RESULT_OK if ok else RESULT_FAILED, error,
            stamp, spare, (started_at or stamp).replace(microsecond=0))


def audit_write(spark: SparkSession, audit_path: str, rows: Sequence[tuple], run_id: str) -> None:
    """The audit rows of a run, one write into the run's own directory, so
    runs at the same time never share a committer's temporary folder."""
    spark.createDataFrame(list(rows), AUDIT_SCHEMA).coalesce(1).write.mode("append") \
        .parquet(f"{audit_path.rstrip('/')}/run={run_id}")


def audit_append(spark: SparkSession, audit_path: str, *args, **kwargs) -> None:
    """Append one audit row (``audit_row``'s fields) after the write (the
    reference logged success before writing)."""
    audit_write(spark, audit_path, [audit_row(*args, **kwargs)], uuid.uuid4().hex)


def read_audit(spark: SparkSession, audit_path: str, run_id: str | None = None) -> DataFrame:
    """The audit table, or one run's rows read from the run's directory
    alone (directories are an implementation detail)."""
    names = [f.split(" ")[0] for f in AUDIT_SCHEMA.split(", ")]
    root = audit_path.rstrip("/")
    return spark.read.parquet(root if run_id is None else f"{root}/run={run_id}").select(*names)


def export_view_csv(df: DataFrame, folder: str, filters: Sequence[FilterSpec] = (),
                    types: Mapping[str, str] | None = None, encoding: str = CP932,
                    suffix: str = "export", now: dt.datetime | None = None) -> str:
    """The filtered view (all rows under the same conditions), empty
    rows dropped (T13), prepared (T9), written as CSV named by time."""
    view = drop_empty_rows(apply_filters(df, filters))
    stamp = (now or dt.datetime.now()).strftime(STAMP_LAYOUT)
    name = EXPORT_NAME.format(stamp=stamp, suffix=suffix)
    return export_csv(view, f"{folder.rstrip('/')}/{name}", types=types, encoding=encoding)
