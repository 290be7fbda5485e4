import pytest
from pyspark.sql import functions as F

from quarry.operators import order_index as OI
from quarry.operators import paging as S
from quarry.session import scratch_path

SF = "/root/testdata/sf0.01"


def rows_read(df) -> int:
    """Rows that the scans of a finished query handed on."""
    def leaves(plan):
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return leaves(plan.executedPlan())
        if "QueryStage" in plan.getClass().getSimpleName():
            return leaves(plan.plan())
        children = plan.children()
        found = [x for i in range(children.size()) for x in leaves(children.apply(i))]
        return found if children.size() else [plan]
    return sum(p.metrics().apply("numOutputRows").value() for p in leaves(df._jdf.queryExecution().executedPlan())
               if p.metrics().contains("numOutputRows"))


def test_page_ten_thousand_reads_a_bounded_number_of_rows(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("n", F.monotonically_increasing_id())
    keys, size = ["l_shipdate", "n"], 5
    path = OI.build_order_index(li, keys, scratch_path(spark, "ordered"), partitions=6, page_rows=1000)
    total = li.count()
    assert total > 50_000
    for number in (1, 77, 10_000, -(-total // size)):
        got = OI.indexed_page(spark, path, number, size, row_no="row_no")
        found = got.collect()
        want = S.page(li, keys, number, size).collect()
        assert [tuple(r)[:-1] for r in found] == [tuple(r) for r in want]
        assert [r.row_no for r in found] == list(range((number - 1) * size + 1, (number - 1) * size + 1 + len(want)))
        assert rows_read(got) <= 2 * 1000 + size, number  # a page of Parquet rows, two at a border
    assert OI.indexed_page(spark, path, total, size).collect() == []


def test_pages_over_file_borders_and_nulls(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("a"), "id")
    keys = ["a", "id"]
    path = OI.build_order_index(df, keys, scratch_path(spark, "ordered"), partitions=5, file_rows=37)
    index = OI.read_index(spark, path).orderBy("before").collect()
    assert len(index) > 20 and index[0]["before"] == 0 and sum(r["n"] for r in index) == 1000
    want = [tuple(r) for r in S.newest_first(df, keys).collect()]
    for size in (1, 64, 250, 1000, 2000):
        got = []
        for number in range(1, -(-1000 // size) + 1) if size > 1 else (1, 37, 38, 500, 1000):
            page = [tuple(r) for r in OI.indexed_page(spark, path, number, size).collect()]
            assert page == want[(number - 1) * size:number * size], (size, number)
            got += page
    assert [tuple(r) for r in OI.stored_order(spark, path, keys).collect()] == want
    assert tuple(OI.indexed_summary(spark, path, 3, 300).first()) == (1000, 4, 601, 900)
    for row in (0, 400, 999):
        assert OI.page_of_key(spark, path, keys, list(want[row]), 64) == row // 64 + 1
    assert OI.page_of_key(spark, path, keys, [5, 10 ** 6], 64) is None


def test_ties_and_bad_pages_are_refused(spark):
    with pytest.raises(ValueError, match="ties"):
        OI.build_order_index(spark.range(10).selectExpr("id % 3 as k"), ["k"], scratch_path(spark, "x"))
    path = OI.build_order_index(spark.range(0), ["id"], scratch_path(spark, "none"))
    assert OI.indexed_page(spark, path, 1, 10).collect() == []
    with pytest.raises(ValueError):
        OI.indexed_page(spark, path, 0, 10)


def test_ranges_grow_in_number_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(OI, "RANGE_ROWS", 100, raising=False)
    df = spark.range(1000).select(F.col("id").alias("n"), F.lit("x").alias("file"))
    path = OI.build_order_index(df, ["n", "file"], scratch_path(spark, "ordered"))
    index = OI.read_index(spark, path).orderBy("before").collect()
    assert len({r[OI.RANGE] for r in index}) == 10 and max(r["n"] for r in index) < 250
    newest = 999
    for r in index:  # no gap between a file's last row and the next one's first
        assert (r["newest"]["n"], r["oldest"]["n"], r["before"]) == (newest, newest - r["n"] + 1, 999 - newest)
        newest -= r["n"]
    assert newest == -1
    assert [tuple(r) for r in OI.indexed_page(spark, path, 7, 30).collect()] == [(n, "x") for n in range(819, 789, -1)]


def test_the_index_sorts_no_rows(spark):
    stored = spark.range(100).selectExpr(f"1 as {OI.RANGE}", f"id as {OI.PLACE}", "'a' as quarry_path")
    plan = OI._files(stored)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
