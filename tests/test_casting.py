import datetime as dt

import pytest

from quarry.functions import casting as C

DIRTY = [(1, "1"), (2, "1.0"), (3, "1.5"), (4, ""), (5, None), (6, "nan"), (7, "None"), (8, "abc"),
         (9, "9007199254740993")]


def by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_lenient_numbers(spark):
    df = spark.createDataFrame(DIRTY, "id long, v string")
    ints = by_id(C.cast_lenient(df, {"v": "int"}), "v")
    assert ints == {1: 1, 2: 1, 3: None, 4: None, 5: None, 6: None, 7: None, 8: None, 9: 9007199254740993}
    floats = by_id(C.cast_lenient(df, {"v": "float"}), "v")
    assert floats[3] == 1.5 and floats[4] is None and floats[6] is None and floats[8] is None
    losses = {r["column"]: r["lost"] for r in C.lenient_losses(df, {"v": "int"}).collect()}
    assert losses == {"v": 2}   # '1.5' and 'abc'


def test_strict_raises(spark):
    good = spark.createDataFrame([(1, "1"), (2, "2.0"), (3, "")], "id long, v string")
    assert by_id(C.cast_strict(good, {"v": "int", "missing": "int"}), "v") == {1: 1, 2: 2, 3: None}
    for bad in ("abc", "1.5"):
        df = spark.createDataFrame([(1, bad)], "id long, v string")
        with pytest.raises(Exception):
            C.cast_strict(df, {"v": "int"}).collect()
    with pytest.raises(Exception):
        C.cast_strict(spark.createDataFrame([(1, "x")], "id long, v string"), {"v": "date"}).collect()


def test_format_dates(spark):
    rows = [(1, "2023-01-01", "2023-01-01 10:00:00"), (2, "2023/01/01", "2023/01/01 10:00:00"),
            (3, "", "x"), (4, None, "9999-99-99")]
    df = spark.createDataFrame(rows, "id long, d string, t string")
    out = C.format_dates(df, {"d": "date", "t": "datetime"}).orderBy("id").collect()
    assert [r["d"] for r in out] == ["2023/01/01", "2023/01/01", None, None]
    assert [r["t"] for r in out] == ["2023/01/01 10:00:00", "2023/01/01 10:00:00", None, None]
    ts = spark.createDataFrame([(1, dt.datetime(2023, 1, 1, 10, 0))], "id long, t timestamp_ntz")
    assert C.format_dates(ts, {"t": "datetime"}).first()["t"] == "2023/01/01 10:00:00"


def test_integral_text_and_nonfinite(spark):
    vals = [(1, 1.0), (2, 1.5), (3, 1e10), (4, -0.0), (5, float("nan")), (6, float("inf")), (7, None)]
    df = spark.createDataFrame(vals, "id long, v double")
    assert by_id(C.to_text(df), "v") == {"1": "1", "2": "1.5", "3": "10000000000", "4": "0", "5": "", "6": "",
                                         "7": ""}
    v2 = by_id(C.csv_prepare_v2(df), "v")
    assert v2["1"] == "1.0" and v2["5"] == "" and v2["7"] == ""


def test_csv_prepare_chain(spark):
    df = spark.createDataFrame([(1, "", "2.0", "nan", True), (2, "3", "", "#######", False)],
                               "id long, i string, f string, s string, b boolean")
    out = {int(r["id"]): r for r in C.csv_prepare(df, {"i": "int", "f": "float"}).collect()}
    assert out[1]["i"] == "0" and out[1]["f"] == "2" and out[1]["s"] == "" and out[1]["b"] == "1"
    assert out[2]["i"] == "3" and out[2]["f"] == "" and out[2]["s"] == "" and out[2]["b"] == "0"


def test_blank_and_zero(spark):
    df = spark.createDataFrame([(1, None), (2, "nan"), (3, "None"), (4, "x")], "id long, s string")
    assert by_id(C.blank_nulls(df), "s") == {1: "", 2: "", 3: "", 4: "x"}
    ints = spark.createDataFrame([(1, ""), (2, "4")], "id long, n string")
    assert by_id(C.zero_blank_ints(ints, {"n": "int"}), "n") == {1: 0, 2: 4}


def test_display_clean_and_drop_empty(spark):
    df = spark.createDataFrame([(1, 2.0, 1.5, None), (2, None, 2.0, "a")], "id long, a double, b double, s string")
    out = C.display_clean(df)
    assert dict(out.dtypes)["a"] == "bigint" and dict(out.dtypes)["b"] == "double"
    assert by_id(out, "s") == {1: "", 2: "a"}
    empty = spark.createDataFrame([(None, None), (1, None)], "a long, b string")
    assert C.drop_empty_rows(empty).count() == 1


def test_infer_types(spark):
    rows = [("2023-01-01", "2023/01/01", "2023-01-01 10:00:00", "1", "1.5", "x", 5),
            ("2023-01-02", None, "2023-01-02 11:00:00", "20", "2", "y", 300)]
    df = spark.createDataFrame(rows, "a string, b string, c string, n string, f string, s string, k long")
    out = dict(C.infer_types(df).dtypes)
    assert out == {"a": "timestamp_ntz", "b": "timestamp_ntz", "c": "timestamp_ntz", "n": "bigint",
                   "f": "double", "s": "string", "k": "smallint"}


def test_downcast_report(spark):
    df = spark.createDataFrame([(1, 100000, "1", "a"), (2, 5, "2", "a")], "i long, j long, t string, c string")
    frame, report = C.downcast_types(df)
    assert dict(frame.dtypes) == {"i": "tinyint", "j": "int", "t": "bigint", "c": "string"}
    rows = {r["column"]: r["to_type"] for r in report.collect()}
    assert rows["c"].startswith("string")


def test_decimal_and_sheet(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("1.50"), dt.date(2023, 1, 1), None)], "d decimal(10,2), day date, s string")
    assert dict(C.decimal_to_double(df).dtypes)["d"] == "double"
    row = C.sheet_cells(df).first()
    assert row["d"] == "1.50" and row["day"] == "2023-01-01" and row["s"] == ""


def test_type_dictionary(spark):
    sheet = spark.createDataFrame([("a", "int"), ("b", "txt"), ("", "x")], "`DB項目` string, DATA_TYPE string")
    assert C.type_dictionary(sheet) == {"a": "int", "b": "txt"}


def test_float_text_matches_python(spark):
    vals = [12345678.9, 0.0001, 1e-05, 1.5e-07, 123.45, -0.5, 1e20, 1.5e16, 2.5e-4, -12345678.25, 0.001,
            9999999.5, 3.14159, 123456789012.125, 0.1, 1 / 3, 1e22, 1e-300, 1e300 / 3]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {int(r["id"]): r["v"] for r in C.to_text(df).collect()}
    for i, v in enumerate(vals):
        expected = str(int(v)) if float(v).is_integer() and abs(v) < 1e38 else str(v)
        assert got[i] == expected, v


def test_csv_prepare_v2_prints_python_floats(spark):
    vals = [1.0, 12345678.9, 1e7, 1e16, 0.5, 1e-05]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {int(r["id"]): r["v"] for r in C.csv_prepare_v2(df).collect()}
    assert [got[i] for i in range(len(vals))] == [str(v) for v in vals]


def test_exact_integral_text_past_bigint(spark):
    vals = [9.000000000000001e18, 2.0 ** 63, 2.0 ** 63 + 2048, 1.2345678901234567e22, 3.0e30, 9.99e37, -2.0 ** 70]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {int(r["id"]): r["v"] for r in C.to_text(df).collect()}
    assert [got[i] for i in range(len(vals))] == [str(int(v)) for v in vals]


def test_nan_in_int_columns_is_blank(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "id long, v double")
    assert by_id(C.cast_strict(df, {"v": "int"}), "v") == {1: 1, 2: None, 3: None}
    assert {r.id: r.v for r in C.csv_prepare(df, {"v": "int"}).collect()} == {"1": "1", "2": "0", "3": "0"}


def test_fractions_are_never_rounded_away(spark):
    df = spark.createDataFrame([(1, "1.00000000001"), (2, "9007199254740993.000"), (3, "1e3"), (4, "1e-3")], "id long, v string")
    assert by_id(C.cast_lenient(df, {"v": "int"}), "v") == {1: None, 2: 9007199254740993, 3: 1000, 4: None}
    with pytest.raises(Exception):
        C.cast_strict(df.where("id = 1"), {"v": "int"}).collect()


def test_infer_keeps_text_that_only_looks_like_dates(spark):
    df = spark.createDataFrame([("1234-56-78", "2024-01-02"), ("ABCD-12-34", None)], "a string, b string")
    out = C.infer_types(df)
    assert dict(out.dtypes)["a"] == "string" and dict(out.dtypes)["b"] == "timestamp_ntz"
    assert [r.a for r in out.collect()] == ["1234-56-78", "ABCD-12-34"]
