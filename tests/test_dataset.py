import datetime as dt

from pyspark.sql import functions as F

from quarry.plans.dataset import alias_filters, filtered_view, prepare_dataset
from quarry.spec import DatasetSpec, FilterSpec

SF = "/root/testdata/sf0.001"


def orders(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    return o.withColumn("deleted_at", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")))


def test_filters_act_before_the_shape(spark):
    spec = DatasetSpec("by_status", orders, ["o_orderstatus"],
                       shape=lambda df: df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")),
                       criteria={"登録日時": "o_orderdate"})
    got = {r["o_orderstatus"]: r["n"] for r in
           prepare_dataset(spark, spec, "前日まで累積", "登録日時", dt.date(1998, 6, 15), exclude_deleted=True).collect()}
    o = orders(spark)
    expected = {r[0]: r[1] for r in o.where((F.col("o_orderdate") < F.lit("1998-06-15").cast("timestamp_ntz"))
                                            & F.col("deleted_at").isNull()).groupBy("o_orderstatus").count().collect()}
    assert got == expected and "P" not in got


def test_master_category_skips_period_and_soft_delete(spark):
    spec = DatasetSpec("all", orders, ["o_orderkey"], criteria={"登録日時": "o_orderdate"})
    out = prepare_dataset(spark, spec, "前日", "登録日時", dt.date(1998, 6, 15), exclude_deleted=True, category="マスタ")
    assert out.count() == orders(spark).count()


def test_aliases_and_interactive_view(spark):
    spec = DatasetSpec("aliased", orders, ["order_no"], columns={"order_no": "o_orderkey", "status": "o_orderstatus"})
    df = prepare_dataset(spark, spec)
    assert df.columns == ["order_no", "status"]
    filters = alias_filters(spec, [FilterSpec("o_orderstatus", "choice", "F"), FilterSpec("nope", "choice", "x")])
    assert [f.column for f in filters] == ["status"]
    view = filtered_view(df, filters, ["order_no"], 1, 5).collect()
    assert len(view) == 5 and all(r["status"] == "F" for r in view)
    assert [r["order_no"] for r in view] == sorted((r["order_no"] for r in view), reverse=True)
