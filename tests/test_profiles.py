import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import profiles as P
from quarry.operators.quality import quality_report
from quarry.session import scratch_path

SF = "/root/testdata/sf0.01"


def test_merged_equals_whole(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        "l_orderkey", "l_extendedprice", "l_returnflag", F.when(F.col("l_linenumber") > 2, F.col("l_tax")).alias("l_tax"),
        F.lit(None).cast("double").alias("never"))
    path = scratch_path(spark, "profile")
    for part in range(3):
        for _ in range(1 + (part == 1)):  # a run done twice counts once
            P.save_profile(li.where(F.col("l_orderkey") % 3 == part), path, f"run-{part}")
    got = {r["column"]: r for r in P.stored_profile(spark, path).collect()}
    whole = {r["column"]: r for r in P.merged_profile(P.profile_part(li).withColumn("run", F.lit("all"))).collect()}
    report = {(r["column"], r["metric"]): r["value"] for r in quality_report(li).collect()}
    distinct = li.agg(*[F.count_distinct(c).alias(c) for c in li.columns]).first()
    assert set(got) == set(li.columns)
    for c, r in got.items():
        assert (r.n_rows, r.nulls, r.n_numbers, r.least, r.most) == (whole[c].n_rows, whole[c].nulls, whole[c].n_numbers, whole[c].least, whole[c].most)
        assert r.nulls == report[c, "null_count"] and r.n_rows == report["*", "total_rows"]
        assert abs(r.distinct_estimate - distinct[c]) <= P.DISTINCT_ERROR * distinct[c]
        if report.get((c, "mean")) is not None:
            assert math.isclose(r.mean, report[c, "mean"], rel_tol=1e-12) and math.isclose(r.std, report[c, "std"], rel_tol=1e-9)
            for rank, value in zip(P.QUANTILES, r.quantiles):
                low, high = li.where(F.col(c).isNotNull()).agg(F.avg((F.col(c) < value).cast("int")), F.avg((F.col(c) <= value).cast("int"))).first()
                assert low - P.RANK_ERROR <= rank <= high + P.RANK_ERROR
        else:
            assert r.mean is None and r.quantiles is None


def test_far_means_keep_their_deviation(spark):
    """A sum of squares would lose all digits here."""
    df = spark.range(1000).select((F.lit(1e9) + F.col("id") % 10).alias("x"), "id")
    path = scratch_path(spark, "profile")
    for part in range(4):
        P.save_profile(df.where(F.col("id") % 4 == part).select("x"), path, str(part))
    assert math.isclose(P.stored_profile(spark, path).first()["std"], df.agg(F.stddev_samp("x")).first()[0], rel_tol=1e-7)


def test_empty_and_changed_types(spark):
    part = P.profile_part(spark.createDataFrame([], "a int, b string"))
    rows = {r["column"]: r for r in P.merged_profile(part.withColumn("run", F.lit("1"))).collect()}
    assert rows["a"].n_rows == 0 and rows["a"].distinct_estimate == 0 and rows["a"].std is None
    both = part.unionByName(P.profile_part(spark.createDataFrame([(1.5,)], "a double")))
    assert [tuple(r) for r in P.type_changes(both).collect()] == [("a", ["double", "int"])]
    with pytest.raises(FileNotFoundError):
        P.stored_profile(spark, scratch_path(spark, "none"))
