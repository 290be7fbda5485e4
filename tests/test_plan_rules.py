"""Every registered query keeps to the design rules in its physical plan:
no Python UDFs, no cartesian products or nested-loop joins; and single rules
for plans that once broke them."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quarry.functions import filters as FL
from quarry.operators import quality as Q
from quarry.plans.registry import QUERIES
from tests.conftest import plan_text

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_rules(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan], plan[:2000]


def test_key_lookup_is_pushed_to_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    found = FL.typed_filter(orders, {"o_orderkey": "9007199254740993"})
    assert "EqualTo(o_orderkey,9007199254740993)" in plan_text(found)


def test_type_conformance_scans_once(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    out = Q.type_conformance(li, {"l_quantity": "int", "l_tax": "float", "l_shipdate": "date", "none": "int"})
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_caller_keeps_the_join_threshold(spark):
    from quarry.session import prepare
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prepare(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before != "-1"


def test_duplicate_rows_has_no_hint(spark):
    plan = Q.duplicate_rows(spark.range(10).withColumn("x", F.col("id") % 3))._jdf.queryExecution().logical().toString()
    assert "hint" not in plan.lower() and "LogicalRDD" not in plan
