import datetime as dt



from conftest import plan_text
from quarry.functions import filters as FL
from quarry.functions.period import period_filter
from quarry.spec import FilterSpec


def like_chars(spark):
    return spark.createDataFrame([(1, "50%"), (2, "50x"), (3, "a_b"), (4, "axb"), (5, "A.C"), (6, "abc"), (7, None)],
                                 "id long, s string")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_text_rules(spark):
    df = like_chars(spark)
    assert ids(df.where(FL.text_ci("s", "a.c"))) == [5, 6]          # regex, any case
    assert ids(df.where(FL.text_regex("s", "a.c"))) == [6]          # case-sensitive
    assert ids(df.where(FL.substring("s", "50%"))) == [1]           # literal
    assert ids(df.where(FL.substring("s", "50%", wildcards=True))) == [1, 2]
    assert ids(df.where(FL.substring("s", "a_b", wildcards=True))) == [3, 4]
    assert ids(df.where(FL.substring("s", "A", case_sensitive=False))) == [3, 4, 5, 6]
    assert FL.text_ci("s", "") is None


def test_equality_rules(spark):
    df = spark.createDataFrame([(1, 5, 1.5), (2, 7, 2.0), (3, None, None)], "id long, n long, x double")
    assert ids(df.where(FL.int_equals("n", "7"))) == [2]
    assert FL.int_equals("n", "7.5") is None                        # skipped, not an error
    assert ids(df.where(FL.numeric_equals("x", "2"))) == [2]
    assert FL.numeric_equals("x", "abc") is None
    assert FL.choice("n", "-") is None and FL.choice("n", "すべて") is None
    typed = {f.name: f.dataType for f in df.schema.fields}
    assert ids(df.where(FL.multi_choice("n", {"5": True, "07": True, "7": False}, typed["n"]))) == [1]
    assert ids(df.where(FL.multi_choice("n", ["07"], typed["n"]))) == []


def test_date_rules(spark):
    rows = [(1, dt.datetime(2024, 1, 10, 0, 0)), (2, dt.datetime(2024, 1, 12, 23, 59, 59, 999999)),
            (3, dt.datetime(2024, 1, 13, 0, 0)), (4, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    dtype = df.schema["ts"].dataType
    assert ids(df.where(FL.date_range("ts", "2024-01-10", "2024-01-12", dtype))) == [1, 2]
    assert ids(df.where(FL.date_range_midnight("ts", "2024-01-10", "2024-01-12", dtype))) == [1]
    assert ids(df.where(FL.date_range("ts", None, "2024/01/12", dtype))) == [1, 2]
    assert FL.sql_date_range("ts", "2024-01-10", None, dtype) is None
    assert ids(df.where(FL.sql_date_range("ts", "2024-01-12", "2024-01-12", dtype))) == [2]
    assert ids(df.where(FL.date_equals("ts", "2024-01-13", dtype))) == [3]


def test_dates_in_text_column(spark):
    df = spark.createDataFrame([(1, "2024-01-10"), (2, "2024/01/11 10:00:00"), (3, "x"), (4, None)], "id long, d string")
    assert ids(df.where(FL.date_range("d", "2024-01-01", "2024-01-31", df.schema["d"].dataType))) == [1, 2]


def test_json_contains(spark):
    rows = [(1, '{"a":"x"}'), (2, '{"a":["x","y"]}'), (3, '["x"]'), (4, '"x"'), (5, '{"a":1}'), (6, None),
            (7, "not json"), (8, '{"a":{"b":"x"}}')]
    df = spark.createDataFrame(rows, "id long, j string")
    assert ids(df.where(FL.json_path("j", "$.a", "x"))) == [1, 2]
    assert ids(df.where(FL.json_root("j", "x"))) == [3, 4]
    assert ids(df.where(FL.json_path("j", "$.a", "1"))) == []       # a number is not the string "1"


def test_combined_skips_unknown_and_keeps_schema(spark):
    df = like_chars(spark)
    out = FL.apply_filters(df, [FilterSpec("nope", "choice", "x"), FilterSpec("s", "choice", "zzz")])
    assert out.columns == ["id", "s"] and out.count() == 0


def test_nulls_as_blank(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 4)], "id long, n long")
    assert ids(FL.apply_filters(df, [FilterSpec("n", "int", "0")])) == [1]
    assert ids(FL.apply_filters(df, [FilterSpec("n", "int", "0")], nulls_as_blank=True)) == [1, 2]
    normalized = FL.normalize_nulls(df).orderBy("id").collect()
    assert [r["n"] for r in normalized] == [0, 0, 4]


def test_typed_dispatch(spark):
    df = spark.createDataFrame([(1, "Alpha", 3.0, dt.datetime(2024, 1, 1)), (2, "beta", 3.0, dt.datetime(2024, 1, 2))],
                               "id long, name string, v double, ts timestamp_ntz")
    assert ids(FL.typed_filter(df, {"name": "ALPHA", "v": "3"})) == [1]
    assert ids(FL.typed_filter(df, {"ts": "2024-01-02", "v": ""})) == [2]


def test_form_types():
    from pyspark.sql import types as T
    assert FL.from_form("c", "FA", "1", T.LongType()).kind == "int"
    assert FL.from_form("c", "FA", "a", T.StringType()).kind == "regex"
    assert FL.from_form("c", "プルダウン", "a", T.StringType()).kind == "choice"
    assert FL.from_form("c", "チェックボックス", {}, T.StringType()).kind == "multi"
    assert FL.from_form("c", "Datetime", {}, T.TimestampNTZType()).kind == "date_range"


def test_filters_reach_the_scan(spark):
    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    specs = [FilterSpec("o_orderpriority", "substring", "URGENT"),
             FilterSpec("o_orderstatus", "multi", ["F", "O"]),
             FilterSpec("o_orderdate", "date_range", {"start_date": "1996-01-01", "end_date": "1996-12-31"})]
    plan = plan_text(FL.apply_filters(orders, specs))
    assert "StringContains(o_orderpriority,URGENT)" in plan
    assert "In(o_orderstatus" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    dated = period_filter(orders, "前日", "o_orderdate", dt.date(1998, 6, 15))
    assert "LessThan(o_orderdate" in plan_text(dated)
    sized = spark.read.parquet(f"{sf}/part.parquet").where(
        FL.multi_choice("p_size", ["1", "2"], T_long()))
    assert "In(p_size" in plan_text(sized)


def T_long():
    from pyspark.sql import types as T
    return T.IntegerType()


def test_numbers_compare_exactly_and_as_seen(spark):
    from quarry.functions.filters import apply_filters
    from quarry.spec import FilterSpec
    df = spark.createDataFrame([(9007199254740992, 12345678.0), (9007199254740993, 0.5)], "k long, v double")
    ids = lambda kind, col, value: [r.k for r in apply_filters(df, [FilterSpec(col, kind, value)]).collect()]
    assert ids("number", "k", "9007199254740993") == [9007199254740993]
    assert ids("number", "k", "1.5") == [] and ids("number", "k", "1e30") == [] and len(ids("number", "k", "x")) == 2
    assert ids("number", "v", "0.5") == [9007199254740993]
    for kind in ("text", "regex"):
        assert ids(kind, "v", "^12345678") == [9007199254740992]


def test_number_filters_on_text_never_stop_the_job(spark):
    rows = [(1, "7"), (2, "abc"), (3, None), (4, " 7.0 "), (5, "7.5"), (6, ""), (7, "99999999999999999999"), (8, "7e0")]
    df = spark.createDataFrame(rows, "id int, t string")
    pick = lambda kind, value: sorted(r.id for r in FL.apply_filters(df, [FilterSpec("t", kind, value)]).collect())
    assert pick("int", "7") == [1, 4]
    assert pick("number", "7") == [1, 4, 8] and pick("number", "7.5") == [5]


def test_number_filter_on_a_float_column(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, None), (4, 16777217.0)], "id int, x float")
    pick = lambda value: [r.id for r in FL.apply_filters(df, [FilterSpec("x", "number", value)]).collect()]
    assert pick("0.1") == [1] and pick("0.20") == [2] and pick("16777216") == [4] and pick("0.3") == []
