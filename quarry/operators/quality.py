"""Validation and profiling (Q1-Q8).

Each report is computed by one distributed aggregate over the frame (plus
one group-by for duplicate rows); only the single result row reaches the
driver, where it is reshaped into a handful of report rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quarry.functions.casting import blank_to_null, number_or_null, parse_datetime
from quarry.functions.filters import from_form
from quarry.functions.literals import FRACTIONAL, INTEGRAL
from quarry.sinks.fs import file_system
from quarry.sinks.versions import is_versioned, read_dataset, version_folders
from quarry.spec import FilterSpec

NUMERIC = INTEGRAL + FRACTIONAL

# Type families used by the column_types rule.
TYPE_FAMILIES = {
    "int": INTEGRAL,
    "float": FRACTIONAL,
    "str": (T.StringType,),
    "string": (T.StringType,),
    "object": (T.StringType,),
    "txt": (T.StringType,),
    "date": (T.DateType,),
    "datetime": (T.TimestampType, T.TimestampNTZType),
    "bool": (T.BooleanType,),
}

# Name hints for filter kinds (Q8).
DATE_NAME_HINTS = ("日付", "日時")
CHOICE_NAME_HINTS = ("フラグ",)
CHOICE_NAME_SUFFIX = "可"

# Columns of a filter-definition sheet and its mark.
DEF_ITEM, DEF_TABLE, DEF_DATA, DEF_INPUT, DEF_OPTIONS, DEF_ON = "DB項目", "TABLE_NAME", "DATA_ITEM", "入力方式", "選択項目", "絞込"
DEF_MARK = "TRUE"
DUPLICATE_HEADER = "ヘッダ行に重複する項目があります。"

REPORT_SCHEMA = "rule string, column string, expected string, actual string, passed boolean"


def _finite(c: Column, dtype: T.DataType) -> Column:
    """NaN -> null, so aggregates skip it as pandas does."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return c.cast("double")


def validate_rules(df: DataFrame, rules: Mapping[str, Any]) -> DataFrame:
    """Q1: check ``min_columns``, ``min_rows``, ``required_columns``,
    ``no_null_columns`` and ``column_types``. Returns one row per check:
    (rule, column, expected, actual, passed). An empty frame yields one
    failed ``not_empty`` row and nothing else."""
    spark = df.sparkSession
    present = set(df.columns)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    null_cols = [c for c in rules.get("no_null_columns", []) if c in present]
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in null_cols]).first()
    rows = row["__rows"]
    out: list[tuple] = []
    if rows == 0:
        out.append(("not_empty", None, ">0", "0", False))
        return spark.createDataFrame(out, REPORT_SCHEMA)
    if "min_columns" in rules:
        n = len(df.columns)
        out.append(("min_columns", None, str(rules["min_columns"]), str(n), n >= rules["min_columns"]))
    if "min_rows" in rules:
        out.append(("min_rows", None, str(rules["min_rows"]), str(rows), rows >= rules["min_rows"]))
    for c in rules.get("required_columns", []):
        out.append(("required_columns", c, "present", "present" if c in present else "missing", c in present))
    for c in null_cols:
        out.append(("no_null_columns", c, "0", str(row[c]), row[c] == 0))
    for c, expected in rules.get("column_types", {}).items():
        if c not in present:
            continue
        actual = dtypes[c]
        family = TYPE_FAMILIES.get(expected.lower())
        ok = isinstance(actual, family) if family else expected.lower() in actual.simpleString()
        out.append(("column_types", c, expected, actual.simpleString(), ok))
    return spark.createDataFrame(out, REPORT_SCHEMA)


def validation_errors(report: DataFrame) -> list[str]:
    """Q1's messages: one per failed check (the report is small)."""
    return [f"{r['rule']}: {r['column'] or ''} expected {r['expected']}, got {r['actual']}".replace("  ", " ")
            for r in report.where(~F.col("passed")).collect()]


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Q3: rows equal to an earlier row (nulls equal), exactly.

    Grouping on every column shuffles every distinct row in full. Instead:
    (1) group on a 64-bit hash of the row, which shuffles 8 bytes per row
    and map-side combines a hot duplicated row to one record per task;
    (2) only rows whose hash occurs more than once are grouped exactly on
    their columns, so hash collisions cannot miscount. The semi-join between
    them carries no hint: Spark picks its form from measured sizes.
    """
    cols = list(subset or df.columns)
    hashed = df.select(*[F.col(c) for c in cols], F.xxhash64(*[F.col(c) for c in cols]).alias("__h"))
    candidates = hashed.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("__h")
    suspects = hashed.join(candidates, "__h", "left_semi")
    groups = suspects.groupBy("__h", *cols).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def quality_report(df: DataFrame) -> DataFrame:
    """Q2: (column, metric, value) rows: total rows and columns, duplicate
    rows, null count per column, and min/max/mean/sample std per numeric
    column (NaN skipped). Dataset-wide metrics have column ``*``. The type of
    each column is in ``column_types``, the stored size in ``stored_bytes``."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    numeric = [f for f in fields if isinstance(f.dataType, NUMERIC)]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"n{i}"))
    for i, f in enumerate(numeric):
        v = _finite(F.col(f.name), f.dataType)
        aggs += [F.min(v).alias(f"mn{i}"), F.max(v).alias(f"mx{i}"),
                 F.avg(v).alias(f"av{i}"), F.stddev_samp(v).alias(f"sd{i}")]
    stats = df.agg(*aggs)
    pairs = [("*", "total_rows", F.col("__rows").cast("double")),
             ("*", "total_columns", F.lit(float(len(fields))))]
    for i, f in enumerate(fields):
        pairs.append((f.name, "null_count", F.col(f"n{i}").cast("double")))
    for i, f in enumerate(numeric):
        for metric, key in (("min", "mn"), ("max", "mx"), ("mean", "av"), ("std", "sd")):
            pairs.append((f.name, metric, F.col(f"{key}{i}")))
    # one aggregate row -> one row per metric
    items = [F.struct(F.lit(c).alias("column"), F.lit(m).alias("metric"), v.cast("double").alias("value"))
             for c, m, v in pairs]
    long = stats.select(F.inline(F.array(*items)))
    dups = duplicate_rows(df).select(F.lit("*").alias("column"), F.lit("duplicate_rows").alias("metric"),
                                     F.col("duplicate_rows").cast("double").alias("value"))
    return long.unionByName(dups)


def column_types(df: DataFrame) -> DataFrame:
    """Q2's type listing: (column, dtype) from the schema."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")


def type_conformance(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Q4: per expected column: does it exist, does every value parse as the
    expected type (``int`` is only tested as numeric), how many do not."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    checks, aggs = [], []
    for i, (name, word) in enumerate(expected.items()):
        if name not in dtypes:
            checks.append((name, word, False, None))
            continue
        c, dtype = F.col(name), dtypes[name]
        if word == "date":
            parsed = parse_datetime(c, dtype)
        elif word in ("int", "float"):
            parsed = c.cast("double") if isinstance(dtype, NUMERIC) else number_or_null(blank_to_null(c))
        else:
            parsed = c
        source = blank_to_null(c) if isinstance(dtype, T.StringType) else c
        aggs.append(F.count_if(source.isNotNull() & parsed.isNull()).alias(f"b{i}"))
        checks.append((name, word, True, f"b{i}"))
    spark = df.sparkSession
    schema = "column string, expected string, exists boolean, valid boolean, bad_values bigint"
    if not aggs:
        return spark.createDataFrame([(n, w, e, False, None) for n, w, e, _ in checks], schema)
    # one aggregate row -> one row per expected column
    items = [F.struct(F.lit(name).alias("column"), F.lit(word).alias("expected"), F.lit(exists).alias("exists"),
                      (F.col(key) == 0 if key else F.lit(False)).alias("valid"),
                      (F.col(key) if key else F.lit(None)).cast("bigint").alias("bad_values"))
             for name, word, exists, key in checks]
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def column_profile(df: DataFrame) -> DataFrame:
    """Q5: (column, dtype, non_null, nulls) for every column, from one
    aggregate."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)]
    row = df.agg(*aggs)
    items = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                      F.col(f"c{i}").alias("non_null"), (F.col("__rows") - F.col(f"c{i}")).alias("nulls"))
             for i, f in enumerate(fields)]
    return row.select(F.inline(F.array(*items)))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path (of a versioned dataset: of its newest version), asked
    of the file system in one call a folder."""
    total = 0
    for folder in version_folders(spark, path) if is_versioned(spark, path) else [path]:
        fs, place, _ = file_system(spark, folder)
        total += int(fs.getContentSummary(place).getLength())
    return total


def dataset_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Q6: rows, columns and stored size (MB) of a stored dataset. The count
    reads file footers only; the size is the file system's."""
    df = read_dataset(spark, path)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(stored_bytes(spark, path) / (1024.0 * 1024.0)).alias("size_mb"))


def distinct_options(df: DataFrame, column: str) -> DataFrame:
    """Q7: all distinct non-empty values of a column for a choice filter,
    sorted; a caller that shows fewer limits them."""
    c = F.col(column)
    return df.select(c.alias(column)).where(c.isNotNull() & (c.cast("string") != "")).distinct().orderBy(column)


def field_kinds(df: DataFrame, flagged: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """Q8: (column, filter kind) from the schema; the Spark type decides,
    the column name is a hint for text columns."""
    kinds = []
    for f in df.schema.fields:
        if flagged is not None and f.name not in flagged:
            continue
        dtype, name = f.dataType, f.name
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) or any(h in name for h in DATE_NAME_HINTS):
            kinds.append((name, "date_range"))
        elif isinstance(dtype, T.BooleanType) or any(h in name for h in CHOICE_NAME_HINTS) or name.endswith(CHOICE_NAME_SUFFIX):
            kinds.append((name, "choice"))
        elif isinstance(dtype, INTEGRAL):
            kinds.append((name, "int"))
        elif isinstance(dtype, FRACTIONAL):
            kinds.append((name, "number"))
        else:
            kinds.append((name, "text"))
    return kinds


def filter_definitions(sheet: DataFrame) -> DataFrame:
    """Q8 from its table: (db_item, table_name, data_item, input_type,
    options) of the rows marked for filtering. ``options`` lists (code, label):
    a line each, the code up to the first blank; a line without a blank is its
    own label. Missing columns count as blank. Headers that repeat, apart
    from case and edge blanks, are refused."""
    clean = [c.strip().lower() for c in sheet.columns]
    if len(clean) != len(set(clean)):
        raise ValueError(DUPLICATE_HEADER)
    named = dict(zip(clean, sheet.columns))

    def cell(name: str) -> Column:
        source = named.get(name.lower())
        return F.lit("") if source is None else F.trim(F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")))

    lines = F.filter(F.split(cell(DEF_OPTIONS), "\r?\n"), lambda x: F.trim(x) != "")
    options = F.transform(lines, lambda x: F.struct(
        F.substring_index(F.trim(x), " ", 1).alias("code"),
        F.when(F.trim(x).contains(" "), F.trim(F.substr(F.trim(x), F.instr(F.trim(x), " ") + 1))).otherwise(F.trim(x)).alias("label")))
    return sheet.where(F.upper(cell(DEF_ON)) == DEF_MARK).select(
        cell(DEF_ITEM).alias("db_item"), cell(DEF_TABLE).alias("table_name"), cell(DEF_DATA).alias("data_item"),
        cell(DEF_INPUT).alias("input_type"), options.alias("options"))


def defined_filters(definitions: DataFrame, dtypes: Mapping[str, T.DataType], values: Mapping[str, Any]) -> list[FilterSpec]:
    """The filters that a form built from ``definitions`` (a row per input
    field) stands for, with the user's ``values`` by item. A choice may be
    named by its label or by its code; codes are what the data hold."""
    specs = []
    for row in definitions.collect():
        item, value = row["db_item"], values.get(row["db_item"])
        if item not in dtypes or value in (None, ""):
            continue
        code = {o["label"]: o["code"] for o in row["options"]}
        if isinstance(value, (list, tuple, set)):
            value = [code.get(v, v) for v in value]
        elif isinstance(value, str):
            value = code.get(value, value)
        specs.append(from_form(item, row["input_type"], value, dtypes[item]))
    return specs
