import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import quality as Q


def sample(spark):
    rows = [(i, n, 20 + 5 * i, f"{n}@test.com", dt.datetime(2023, 1, i))
            for i, n in enumerate(["Alice", "Bob", "Charlie", "David", "Eve"], start=1)]
    return spark.createDataFrame(rows, "id long, name string, age long, email string, created_at timestamp_ntz")


def failed(report):
    return sorted((r["rule"], r["column"]) for r in report.where("NOT passed").collect())


def test_validate(spark):
    df = sample(spark)
    ok = Q.validate_rules(df, {"min_columns": 3, "min_rows": 5, "required_columns": ["id"],
                               "no_null_columns": ["id"], "column_types": {"age": "int"}})
    assert failed(ok) == []
    assert failed(Q.validate_rules(df, {"min_columns": 10})) == [("min_columns", None)]
    assert failed(Q.validate_rules(df, {"min_rows": 10})) == [("min_rows", None)]
    assert failed(Q.validate_rules(df, {"required_columns": ["zzz"]})) == [("required_columns", "zzz")]
    assert failed(Q.validate_rules(df, {"column_types": {"age": "float"}})) == [("column_types", "age")]
    empty = Q.validate_rules(df.limit(0), {"min_rows": 1})
    assert [(r["rule"], r["passed"]) for r in empty.collect()] == [("not_empty", False)]


def test_null_rule_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (4, "d"), (5, "e")], "id long, name string")
    report = Q.validate_rules(df, {"no_null_columns": ["id", "name"]})
    assert {r["column"]: r["actual"] for r in report.collect()} == {"id": "1", "name": "1"}
    assert len(Q.validation_errors(report)) == 2


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (2, "B"), (3, "C")], "id long, v string")
    assert Q.duplicate_rows(df).first()[0] == 1
    nulls = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,)], "x long")
    assert Q.duplicate_rows(nulls).first()[0] == 3


def test_quality_report_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    rep = {(r["column"], r["metric"]): r["value"] for r in Q.quality_report(df).collect()}
    assert rep[("v", "mean")] == 2.0 and rep[("v", "max")] == 3.0 and rep[("*", "total_rows")] == 4
    assert rep[("v", "null_count")] == 1


def test_conformance_profile_options(spark):
    df = spark.createDataFrame([("1", "2023-01-01", "a"), ("x", "bad", ""), (None, None, "b")],
                               "n string, d string, s string")
    conf = {r["column"]: (r["exists"], r["valid"], r["bad_values"])
            for r in Q.type_conformance(df, {"n": "int", "d": "date", "zz": "float"}).collect()}
    assert conf == {"n": (True, False, 1), "d": (True, False, 1), "zz": (False, False, None)}
    prof = {r["column"]: (r["non_null"], r["nulls"]) for r in Q.column_profile(df).collect()}
    assert prof["n"] == (2, 1)
    assert [r[0] for r in Q.distinct_options(df, "s").collect()] == ["a", "b"]


def test_dataset_metrics_size(spark):
    path = "/root/testdata/sf0.001/orders.parquet"
    row = Q.dataset_metrics(spark, path).first()
    assert row["n_columns"] == 6 and row["n_rows"] == spark.read.parquet(path).count()
    assert abs(row["size_mb"] - os.path.getsize(path) / 1024 / 1024) < 1e-9


def test_field_kinds(spark):
    df = spark.createDataFrame([(1, "x", "y", True)], "n long, `登録日付` string, `公開フラグ` string, ok boolean")
    assert dict(Q.field_kinds(df)) == {"n": "int", "登録日付": "date_range", "公開フラグ": "choice", "ok": "choice"}


def test_filter_definitions(spark):
    sheet = spark.createDataFrame(
        [("status ", "orders", "注文", "プルダウン", "F closed\nO open now\r\n\n P ", "TRUE"), ("n", None, None, "FA", None, "true "),
         ("off", "t", "d", "FA", "1 x", ""), ("none", "t", "d", "FA", "", None)],
        "`DB項目` string, `Table_Name` string, ` DATA_ITEM` string, `入力方式` string, `選択項目` string, `絞込` string")
    defs = Q.filter_definitions(sheet)
    rows = {r.db_item: r for r in defs.collect()}
    assert set(rows) == {"status", "n"}
    assert [(o["code"], o["label"]) for o in rows["status"].options] == [("F", "closed"), ("O", "open now"), ("P", "P")]
    assert rows["n"].table_name == "" and rows["n"].options == []
    data = spark.createDataFrame([("F", 1), ("O", 2), ("P", 2)], "status string, n int")
    types = {f.name: f.dataType for f in data.schema.fields}
    from quarry.functions.filters import apply_filters
    pick = lambda values: sorted(r.status for r in apply_filters(data, Q.defined_filters(defs, types, values)).collect())
    assert pick({"status": "open now"}) == ["O"] and pick({"status": "P", "n": "2"}) == ["P"] and pick({"n": "2"}) == ["O", "P"]
    assert pick({"status": "-", "unknown": "1", "n": ""}) == ["F", "O", "P"]
    doubled = sheet.select("*", F.lit("").alias("db項目 "))
    with pytest.raises(ValueError, match="重複"):
        Q.filter_definitions(doubled)
