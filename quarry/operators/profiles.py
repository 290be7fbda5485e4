"""Profiles that merge (Q2, Q5, Q6 over runs).

A profile part holds, for each column of one run's rows, what can be put
together later without reading the rows again: counts, bounds, moments, a
HyperLogLog sketch of the distinct values and a KLL sketch of the numbers. Parts
are kept in a versioned table under their run's id, so a run that is repeated
counts once. The merged profile of all parts is that of all rows: counts,
bounds, mean and deviation exactly (up to floating-point rounding), distinct
counts and quantiles within the sketches' errors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.operators.quality import NUMERIC, _finite
from quarry.sinks.versions import append_version, read_version

HLL_LG_K = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_LG_K / 2)  # three standard errors: 4.9 %
KLL_K = 400
RANK_ERROR = 0.01  # of a quantile, by rank, with this k
QUANTILES = (0.25, 0.5, 0.75)


def profile_part(df: DataFrame) -> DataFrame:
    """(column, dtype, n_rows, nulls, n_numbers, least, most, mean, m2,
    values_sketch, numbers_sketch), one row per column, by one aggregate."""
    items, aggs = [], [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        number = _finite(c, f.dataType) if isinstance(f.dataType, NUMERIC) else F.lit(None).cast("double")
        aggs += [F.count_if(c.isNull()).alias(f"nulls{i}"), F.count(number).alias(f"k{i}"), F.min(number).alias(f"lo{i}"),
                 F.max(number).alias(f"hi{i}"), F.avg(number).alias(f"mean{i}"), F.var_pop(number).alias(f"var{i}"),
                 F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), F.lit(HLL_LG_K)).alias(f"hll{i}"),
                 F.kll_sketch_agg_double(number, F.lit(KLL_K)).alias(f"kll{i}")]
        items.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col("n").alias("n_rows"),
            F.col(f"nulls{i}").alias("nulls"), F.col(f"k{i}").alias("n_numbers"), F.col(f"lo{i}").alias("least"),
            F.col(f"hi{i}").alias("most"), F.col(f"mean{i}").alias("mean"), (F.col(f"var{i}") * F.col(f"k{i}")).alias("m2"),
            F.col(f"hll{i}").alias("values_sketch"), F.col(f"kll{i}").alias("numbers_sketch")))
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def save_profile(df: DataFrame, path: str, run: str) -> None:
    """Add a run's part to the stored profile; a run that is there stays as it is."""
    append_version(profile_part(df).withColumn("run", F.lit(run)), path, txn=run)


def _together(a: Column, b: Column) -> Column:
    """Count, mean and squared deviations of two parts together."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    share = b["n"] / n
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(F.struct(
        n.alias("n"), (a["mean"] + apart * share).alias("mean"), (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2")))


def merged_profile(parts: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(column, dtype, n_rows, nulls, n_numbers, least, most, mean, std,
    distinct_estimate, quantiles) of all parts together; no row is read again."""
    moments = F.transform(F.sort_array(F.collect_list(F.struct("run", "n_numbers", "mean", "m2"))), lambda x: F.struct(
        x["n_numbers"].cast("double").alias("n"), F.coalesce(x["mean"], F.lit(0.0)).alias("mean"), F.coalesce(x["m2"], F.lit(0.0)).alias("m2")))
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    rows = parts.groupBy("column", "dtype").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"), F.sum("n_numbers").alias("n_numbers"),
        F.min("least").alias("least"), F.max("most").alias("most"), F.aggregate(moments, none, _together).alias("m"),
        F.hll_sketch_estimate(F.hll_union_agg("values_sketch")).alias("distinct_estimate"),
        F.kll_merge_agg_double("numbers_sketch", F.lit(KLL_K)).alias("kll"))
    some = F.col("n_numbers") > 0
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    return rows.select(
        "column", "dtype", "n_rows", "nulls", "n_numbers", "least", "most", F.when(some, F.col("m.mean")).alias("mean"),
        F.when(F.col("n_numbers") > 1, F.sqrt(F.col("m.m2") / (F.col("n_numbers") - 1))).alias("std"), "distinct_estimate",
        F.when(some, F.kll_sketch_get_quantile_double("kll", ranks)).alias("quantiles"))


def stored_profile(spark: SparkSession, path: str, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The merged profile of all runs kept at ``path``."""
    return merged_profile(read_version(spark, path), quantiles)


def type_changes(parts: DataFrame) -> DataFrame:
    """(column, dtypes) of columns whose type differs between runs."""
    return parts.groupBy("column").agg(F.sort_array(F.collect_set("dtype")).alias("dtypes")).where(F.size("dtypes") > 1)
