"""Typing and cleaning.

The type dictionary maps column -> type word (``txt``, ``int``, ``float``,
``date``, ``datetime``). Each rule below is one projection over the frame:
a single ``select`` whose expressions run inside whole-stage codegen. The two
inference rules (T14, T15) need facts about whole columns; they gather all of
them in one aggregate pass and then cast.

Null, blank and zero differ by sink: only the text-sink projections (T6-T10,
T16) turn nulls into ``''``; Parquet keeps nulls.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quarry.functions.literals import FRACTIONAL, INTEGRAL

# Type words of the type dictionary.
TXT, INT, FLOAT, DATE, DATETIME = "txt", "int", "float", "date", "datetime"
# Text the reference treats as null, and the grid's overflow mark.
NULL_WORDS = ("nan", "None")
OVERFLOW_MARK = "#######"
# Output layouts of formatted dates.
DATE_OUT = "yyyy/MM/dd"
DATETIME_OUT = "yyyy/MM/dd HH:mm:ss"
# Accepted slash layouts (ISO text goes through Spark's cast).
SLASH_DATE, SLASH_DATETIME = "yyyy/MM/dd", "yyyy/MM/dd HH:mm:ss"
# Sheet column headers of a type dictionary.
TYPE_SHEET_COLUMN, TYPE_SHEET_TYPE = "DB項目", "DATA_TYPE"

_DEC = T.DecimalType(38, 10)
_BIG = 9e18
# Shapes of number text. Casting text that is not a number makes the JVM
# throw and catch an exception per value; probing a whole text column (type
# inference, conformance) therefore tests the shape first.
NUMBER_SHAPE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_SHAPE = r"^\s*[+-]?\d{1,19}(\.0*)?\s*$"


def number_or_null(c: Column) -> Column:
    """Text -> double, only for text shaped like a number."""
    return F.when(c.rlike(NUMBER_SHAPE), c.try_cast("double"))


def integer_or_null(c: Column) -> Column:
    """Text -> bigint, only for text shaped like a whole number that fits."""
    return F.when(c.rlike(INTEGER_SHAPE), c.try_cast(_DEC).try_cast("bigint"))


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def blank_to_null(c: Column) -> Column:
    """Text null, blank, ``nan`` or ``None`` -> null; other text trimmed."""
    t = F.trim(c.cast("string"))
    return F.when(t.isin("", *NULL_WORDS), F.lit(None).cast("string")).otherwise(t)


# --- number parsing ---------------------------------------------------------

def _whole_text(t: Column) -> Column:
    """Trimmed text -> bigint where it says a whole number that fits, else
    null: digits with at most zeros behind the point are read as they stand
    (any number of decimals, nothing lost above 2^53), powers through double."""
    digits = F.when(t.rlike(r"^[+-]?\d+(\.0*)?$"), F.substring_index(t, ".", 1).try_cast("bigint"))
    power = F.when(t.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)[eE][+-]?\d+$"), t.try_cast("double"))
    return F.coalesce(digits, F.when(power == F.floor(power), power.try_cast("bigint")))


def _number(c: Column, dtype: T.DataType) -> Column:
    """A fractional column with NaN as null, as blank cells come."""
    return c if isinstance(dtype, T.DecimalType) else F.nanvl(c, F.lit(None).cast(dtype))


def lenient_long(c: Column, dtype: T.DataType) -> Column:
    """Integer or null: ``1.0`` -> 1, a fractional value -> null."""
    if isinstance(dtype, INTEGRAL):
        return c.cast("bigint")
    if isinstance(dtype, FRACTIONAL):
        d = _number(c, dtype)
        return F.when(d == F.floor(d), d.try_cast("bigint"))
    return _whole_text(blank_to_null(c))


def strict_long(c: Column, dtype: T.DataType, name: str = "") -> Column:
    """Integer; bad text or a fractional value raises, NaN is blank."""
    if isinstance(dtype, INTEGRAL):
        return c.cast("bigint")
    src = _number(c, dtype) if isinstance(dtype, FRACTIONAL) else blank_to_null(c)
    whole = lenient_long(src, dtype)
    bad = F.raise_error(F.concat(F.lit(f"cannot convert column '{name}' to int: "), src.cast("string"))).cast("bigint")
    return F.when(src.isNotNull(), F.coalesce(whole, bad))  # the value is parsed once


def lenient_double(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (INTEGRAL + FRACTIONAL)):
        return c.cast("double")
    return blank_to_null(c).try_cast("double")


def strict_double(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (INTEGRAL + FRACTIONAL)):
        return c.cast("double")
    return blank_to_null(c).cast("double")


# --- date parsing -----------------------------------------------------------

def parse_datetime(c: Column, dtype: T.DataType) -> Column:
    """Timestamp (ntz) from a date, timestamp or text column; text that fits
    none of the layouts -> null."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    # One parse per value, chosen by the text's shape: trying layouts in
    # turn costs a thrown exception per failed layout and row. ISO text
    # (``-`` separators, optional time and fraction) goes through Spark's
    # exception-free cast; slash layouts through one fixed formatter each.
    text = blank_to_null(c)
    slash = F.substring(text, 5, 1) == "/"
    return F.when(slash & (F.length(text) == 10), F.try_to_timestamp(text, F.lit(SLASH_DATE))) \
        .when(slash & (F.length(text) == 19), F.try_to_timestamp(text, F.lit(SLASH_DATETIME))) \
        .when(slash, F.lit(None)) \
        .otherwise(text.try_cast("timestamp_ntz")).cast("timestamp_ntz")


def strict_datetime(c: Column, dtype: T.DataType, name: str = "") -> Column:
    parsed = parse_datetime(c, dtype)
    if not _is_text(dtype):
        return parsed
    src = blank_to_null(c)
    # coalesce evaluates the parse once; the error branch only runs for a
    # value that did not parse
    return F.coalesce(parsed, F.when(src.isNotNull(), F.raise_error(
        F.concat(F.lit(f"cannot convert column '{name}' to datetime: "), src))).cast("timestamp_ntz"))


# --- T1-T4 ------------------------------------------------------------------

def _apply(df: DataFrame, types: Mapping[str, str], rule) -> DataFrame:
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        word = types.get(name)
        c = F.col(name)
        out.append((rule(c, dtypes[name], word, name) if word else c).alias(name))
    return df.select(*out)


def cast_strict(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Apply the type dictionary; a bad int/float/date raises.
    Columns missing from the frame are skipped."""
    def rule(c, dtype, word, name):
        if word == TXT:
            return c.cast("string")
        if word == INT:
            return strict_long(c, dtype, name)
        if word == FLOAT:
            return strict_double(c, dtype)
        if word == DATE:
            return strict_datetime(c, dtype, name).cast("date") if _is_text(dtype) else c
        if word == DATETIME:
            return strict_datetime(c, dtype, name)
        return c
    return _apply(df, types, rule)


def cast_lenient(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """As T1 but bad values become null and nothing raises; the schema
    is the same whatever the data holds."""
    def rule(c, dtype, word, name):
        if word == TXT:
            return c.cast("string")
        if word == INT:
            return lenient_long(c, dtype)
        if word == FLOAT:
            return lenient_double(c, dtype)
        if word == DATE:
            return parse_datetime(c, dtype).cast("date") if _is_text(dtype) else c
        if word == DATETIME:
            return parse_datetime(c, dtype)
        return c
    return _apply(df, types, rule)


def lenient_losses(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """How many non-blank values T2 turned into null, per typed column
    (one aggregate pass)."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    typed = [(n, w) for n, w in types.items() if n in dtypes and w in (INT, FLOAT, DATE, DATETIME)]
    if not typed:
        return df.sparkSession.createDataFrame([], "column string, lost bigint")
    aggs = []
    for name, _ in typed:
        present = blank_to_null(F.col(name)).isNotNull() if _is_text(dtypes[name]) else F.col(name).isNotNull()
        aggs.append(F.count_if(present & F.col(f"__{name}").isNull()).alias(name))
    # one scan: the lenient value next to the source value
    paired = df.select(*[F.col(n) for n, _ in typed],
                       *[_lenient_expr(F.col(n), dtypes[n], w).alias(f"__{n}") for n, w in typed])
    row = paired.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n, _ in typed)
    return row.selectExpr(f"stack({len(typed)}, {stack}) as (column, lost)")


def lenient_problems(df: DataFrame, types: Mapping[str, str]) -> Column:
    """array<struct<column, value>>: the non-blank values of a row that T2
    turns into null, as text."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for name, word in types.items():
        if name not in dtypes or word not in (INT, FLOAT, DATE, DATETIME):
            continue
        c = F.col(name)
        present = blank_to_null(c).isNotNull() if _is_text(dtypes[name]) else c.isNotNull()
        lost = present & _lenient_expr(c, dtypes[name], word).isNull()
        found.append(F.when(lost, F.struct(F.lit(name).alias("column"), c.cast("string").alias("value"))))
    none = F.lit(None).cast("struct<column:string,value:string>")
    return F.array_compact(F.array(*found, none))


def _lenient_expr(c: Column, dtype: T.DataType, word: str) -> Column:
    if word == INT:
        return lenient_long(c, dtype)
    if word == FLOAT:
        return lenient_double(c, dtype)
    return parse_datetime(c, dtype)


def format_dates(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """T4: ``date`` -> ``yyyy/MM/dd``, ``datetime`` -> ``yyyy/MM/dd HH:mm:ss``;
    values that do not parse -> null."""
    def rule(c, dtype, word, name):
        if word == DATE:
            return F.date_format(parse_datetime(c, dtype), DATE_OUT)
        if word == DATETIME:
            return F.date_format(parse_datetime(c, dtype), DATETIME_OUT)
        return c
    return _apply(df, types, rule)


def cast_format(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient numbers and formatted dates in one projection."""
    def rule(c, dtype, word, name):
        if word == INT:
            return lenient_long(c, dtype)
        if word == FLOAT:
            return lenient_double(c, dtype)
        if word == DATE:
            return F.date_format(parse_datetime(c, dtype), DATE_OUT)
        if word == DATETIME:
            return F.date_format(parse_datetime(c, dtype), DATETIME_OUT)
        if word == TXT:
            return c.cast("string")
        return c
    return _apply(df, types, rule)


def type_dictionary(sheet: DataFrame, column_field: str = TYPE_SHEET_COLUMN,
                    type_field: str = TYPE_SHEET_TYPE) -> dict[str, str]:
    """T5: ``{column: type word}`` from a sheet-like frame (one row per
    dataset column, so small)."""
    rows = sheet.select(F.col(column_field).alias("c"), F.col(type_field).alias("t")) \
        .where(F.col("c").isNotNull() & (F.trim(F.col("c")) != "")).collect()
    return {r["c"]: r["t"] for r in rows}


# --- T6-T10: text sinks -----------------------------------------------------

def blank_nulls(df: DataFrame) -> DataFrame:
    """Text null, ``nan`` and ``None`` -> ``''`` (text columns only)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if _is_text(f.dataType):
            c = F.when(c.isNull() | c.isin(*NULL_WORDS), F.lit("")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def zero_blank_ints(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``int``-typed blanks -> 0."""
    def rule(c, dtype, word, name):
        if word == INT:
            return F.coalesce(lenient_long(c, dtype), F.lit(0).cast("bigint"))
        return c
    return _apply(df, types, rule)


def float_text(d: Column) -> Column:
    """A double as Python prints it: plain digits, except an exponent form
    (``1e-05``) below 1e-4 and from 1e16. Spark's own text (Java's) switches
    to ``1.2345678E7`` already at 1e7 and below 1e-3. The plain form comes
    from parsing Java's shortest text as a decimal (exact: the text, not the
    binary double, is parsed). Known differences: Java 17 sometimes prints
    one digit more than the shortest form (``5.9604644775390625e-08`` for
    Python's ``5.960464477539063e-08``: the same value; Java 19 fixed it),
    and integral values past 1e38 keep the exponent form where Python prints
    every digit."""
    java = d.cast("string")
    a = F.abs(d)
    plain = F.regexp_replace(java.try_cast(T.DecimalType(38, 22)).cast("string"), r"\.?0+$", "")
    plain = F.when(plain.contains("."), plain).otherwise(F.concat(plain, F.lit(".0")))
    sci = F.concat(F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", ""), F.lit("e"),
                   F.format_string("%+03d", F.substring_index(java, "E", -1).cast("int")))
    return F.when(~java.contains("E"), java).when((a < F.lit(1e-4)) | (a >= F.lit(1e16)), sci).otherwise(plain)


def exact_integral_text(d: Column) -> Column:
    """Every digit of an integral double below 1e38, as Python's ``int``
    prints it. Below 2^63 a bigint holds it. Above, a double is a multiple
    of 2^11 per 11 binary orders, so dividing by that power of two is exact,
    the quotient fits a bigint, and the product is formed in decimal (a
    plain decimal cast would round to 17 significant digits)."""
    a = F.abs(d)
    out = F.when(a < F.lit(2.0 ** 63), d.cast("bigint").cast("string"))
    for k in range(11, 67, 11):
        quotient = (d / F.lit(float(2 ** k))).cast("bigint").cast(T.DecimalType(19, 0))
        out = out.when(a < F.lit(2.0 ** (63 + k)), (quotient * F.lit(str(2 ** k)).cast(T.DecimalType(20, 0))).cast("string"))
    return out


def rare_number_text(d: Column) -> Column:
    """Text for magnitudes the common branches do not cover: integral past
    2^63 (every digit, up to 1e38), fractional below 1e-3 or from 1e7."""
    integral = (d % F.lit(1.0)) == F.lit(0.0)
    return F.when(integral & (F.abs(d) < F.lit(1e38)), exact_integral_text(d)).otherwise(float_text(d))


def _java_is_python(d: Column) -> Column:
    """Where Java's and Python's float text agree (cheap test first, so the
    string surgery of ``float_text`` runs only for rare magnitudes)."""
    a = F.abs(d)
    return (a >= F.lit(1e-3)) & (a < F.lit(1e7))


def integral_text(c: Column, dtype: T.DataType) -> Column:
    """One cell as text: integral floats lose ``.0`` (exactly, also past
    the bigint range); other floats as Python prints them; NaN and
    infinities blank (T10's rule); booleans ``1``/``0``; null ``''``."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        d = c.cast("double")
        integral = (d % F.lit(1.0)) == F.lit(0.0)   # floor() would saturate past 2^63
        text = F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit("")) \
            .when(integral & (F.abs(d) < F.lit(2.0 ** 63)), d.cast("bigint").cast("string")) \
            .when(~integral & _java_is_python(d), d.cast("string")) \
            .otherwise(rare_number_text(d))
    elif isinstance(dtype, T.DecimalType):
        text = F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))
    elif isinstance(dtype, T.BooleanType):
        text = F.when(c, F.lit("1")).otherwise(F.lit("0"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def to_text(df: DataFrame) -> DataFrame:
    """T8 over every column."""
    return df.select(*[integral_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def csv_prepare(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The UI export chain as one projection: blank nulls (T6), ``int``
    blanks -> 0 (T7), strict types (T1), integral text (T8, non-finite
    blank as T10), the overflow mark -> ``''``."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        dtype, word = dtypes[name], types.get(name)
        c = F.col(name)
        if word == INT:
            value = F.coalesce(strict_long(c, dtype, name), F.lit(0).cast("bigint"))
            text = integral_text(value, T.LongType())
        elif word == FLOAT:
            text = integral_text(strict_double(c, dtype), T.DoubleType())
        elif _is_text(dtype):
            text = F.when(c.isNull() | c.isin(*NULL_WORDS, OVERFLOW_MARK), F.lit("")).otherwise(c)
        else:
            text = integral_text(c, dtype)
        out.append(text.alias(name))
    return df.select(*out)


def csv_prepare_v2(df: DataFrame) -> DataFrame:
    """Every cell as plain text; NaN/infinities and nulls blank."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = c.cast("double")
            c = F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None)) \
                .when(_java_is_python(d) | (d == F.lit(0.0)), d.cast("string")).otherwise(float_text(d))
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return df.select(*out)


# --- T11-T16 ----------------------------------------------------------------

def decimal_to_double(df: DataFrame) -> DataFrame:
    """Decimal columns -> double."""
    return df.select(*[(F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType)
                        else F.col(f.name)).alias(f.name) for f in df.schema.fields])


def display_clean(df: DataFrame) -> DataFrame:
    """Float columns whose values are all integral become integers;
    text nulls -> ``''``. One aggregate decides every float column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    integral: set[str] = set()
    if floats:
        checks = []
        for name in floats:
            c = F.col(name)
            ok = c.isNull() | ((c == F.floor(c)) & (F.abs(c) < F.lit(_BIG)) & ~F.isnan(c))
            checks.append(F.coalesce(F.bool_and(ok), F.lit(True)).alias(name))
        row = df.agg(*checks).first()
        integral = {name for name in floats if row[name]}
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in integral:
            c = c.cast("bigint")
        elif _is_text(f.dataType):
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(f.name))
    return df.select(*out)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every column is null."""
    return df.dropna(how="all")


def _fits(lo: Column, hi: Column, bits: int) -> Column:
    bound = 2 ** (bits - 1)
    return (lo >= F.lit(-bound)) & (hi <= F.lit(bound - 1))


def _date_shape(c: Column, sep: str, length: int, middle: str | None = None) -> Column:
    shape = (F.length(c) == length) & (F.substring(c, 5, 1) == sep) & (F.substring(c, 8, 1) == sep)
    if middle is not None:
        shape = shape & (F.substring(c, 11, 1) == middle)
    return shape


# The three date shapes recognised by type inference, as
# (separator, length, separator at position 11, parse layout).
DATE_SHAPES = (
    ("-", 10, None, "yyyy-MM-dd"),
    ("/", 10, None, "yyyy/MM/dd"),
    ("-", 19, " ", "yyyy-MM-dd HH:mm:ss"),
)


FITS_INTEGER, FITS_NUMBER, FITS_DATE = 1, 2, 4  # bits; the date shapes take one each from FITS_DATE on


def _fitting(c: Column) -> Column:
    """The types that a text value fits, as bits. The shapes exclude each
    other, so a value is parsed once, as what it looks like; a null fits all."""
    number = FITS_INTEGER | FITS_NUMBER
    bits = F.when(c.isNull(), FITS_DATE * (1 << len(DATE_SHAPES)) - 1).when(F.trim(c) == "", number)
    for i, (sep, length, middle, layout) in enumerate(DATE_SHAPES):
        parsed = F.try_to_timestamp(c, F.lit(layout)).isNotNull()
        bits = bits.when(_date_shape(c, sep, length, middle), F.when(parsed, FITS_DATE << i).otherwise(0))
    return bits.when(integer_or_null(c).isNotNull(), number).when(number_or_null(c).isNotNull(), FITS_NUMBER).otherwise(0)


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns whose every non-null value is a date of one shape
    become timestamps (a value that only looks like one keeps the column text), else all-numeric ones become numbers (integers when
    every value is integral); integer columns shrink to the smallest integer
    type that holds their range. One aggregate pass, then one projection."""
    fields = df.schema.fields
    aggs = []
    for f in fields:
        c = F.col(f.name)
        if _is_text(f.dataType):
            aggs += [F.count(c).alias(f"{f.name}__n"), F.bit_and(_fitting(c)).alias(f"{f.name}__fits")]
        elif isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
            aggs.append(F.min(c).alias(f"{f.name}__lo"))
            aggs.append(F.max(c).alias(f"{f.name}__hi"))
    if not aggs:
        return df
    row = df.agg(*aggs).first().asDict()
    out = []
    for f in fields:
        c, name = F.col(f.name), f.name
        if _is_text(f.dataType) and row[f"{name}__n"]:
            fits = row[f"{name}__fits"]
            layout = next((shape[3] for i, shape in enumerate(DATE_SHAPES) if fits & FITS_DATE << i), None)
            if layout:
                c = F.try_to_timestamp(c, F.lit(layout)).cast("timestamp_ntz")
            elif fits & FITS_NUMBER:
                c = integer_or_null(blank_to_null(c)) if fits & FITS_INTEGER else number_or_null(blank_to_null(c))
        elif f"{name}__lo" in row and row[f"{name}__lo"] is not None:
            c = c.cast(_smallest_integral(row[f"{name}__lo"], row[f"{name}__hi"]))
        out.append(c.alias(name))
    return df.select(*out)


def _smallest_integral(lo: int, hi: int) -> str:
    for bits, name in ((8, "tinyint"), (16, "smallint"), (32, "int")):
        if -(2 ** (bits - 1)) <= lo and hi <= 2 ** (bits - 1) - 1:
            return name
    return "bigint"


def downcast_types(df: DataFrame, floats_to_float: bool = False,
                   category_ratio: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Integers -> smallest integer type by min/max; text -> number when
    every value is numeric; floats -> float only when asked (lossy). Text
    columns with a distinct/rows ratio under ``category_ratio`` are reported
    as category candidates (Parquet dictionary-encodes them anyway).

    Returns ``(frame, report)``; the report has one row per column."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in fields:
        c = F.col(f.name)
        if isinstance(f.dataType, INTEGRAL):
            aggs += [F.min(c).alias(f"{f.name}__lo"), F.max(c).alias(f"{f.name}__hi")]
        elif _is_text(f.dataType):
            aggs += [
                F.count(number_or_null(c)).alias(f"{f.name}__nums"),
                F.count(c).alias(f"{f.name}__n"),
                F.bool_and(c.isNull() | integer_or_null(c).isNotNull()).alias(f"{f.name}__int"),
                F.approx_count_distinct(c).alias(f"{f.name}__distinct"),
            ]
    row = df.agg(*aggs).first().asDict()
    rows = row["__rows"] or 0
    out, report = [], []
    for f in fields:
        c, name, target, ratio = F.col(f.name), f.name, f.dataType.simpleString(), None
        if isinstance(f.dataType, INTEGRAL) and row[f"{name}__lo"] is not None:
            target = _smallest_integral(row[f"{name}__lo"], row[f"{name}__hi"])
            c = c.cast(target)
        elif isinstance(f.dataType, T.DoubleType) and floats_to_float:
            target = "float"
            c = c.cast("float")
        elif _is_text(f.dataType):
            ratio = (row[f"{name}__distinct"] / rows) if rows else None
            if row[f"{name}__n"] and row[f"{name}__nums"] == row[f"{name}__n"]:
                if row[f"{name}__int"]:
                    target = "bigint"
                    c = integer_or_null(c)
                else:
                    target = "double"
                    c = number_or_null(c)
            elif ratio is not None and ratio < category_ratio:
                target = "string (category candidate)"
        out.append(c.alias(name))
        report.append((name, f.dataType.simpleString(), target, ratio))
    spark = df.sparkSession
    rep = spark.createDataFrame(report, "column string, from_type string, to_type string, distinct_ratio double")
    return df.select(*out), rep


def sheet_cells(df: DataFrame) -> DataFrame:
    """Decimals, dates, timestamps and intervals -> text; text nulls
    -> ``''``; other columns unchanged."""
    textual = (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType,
               T.DayTimeIntervalType, T.YearMonthIntervalType)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, textual):
            c = F.coalesce(c.cast("string"), F.lit(""))
        elif _is_text(f.dataType):
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(f.name))
    return df.select(*out)
