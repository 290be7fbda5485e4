"""Registered queries of stored datasets: versions, repeatable appends, order
index, Bloom filters, rejects, merged profiles, deadlines and refreshes.

``quarry.plans.registry`` imports this module last, so its queries stand in the
same tables as all others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import order_index as OI
from quarry.operators import profiles as P
from quarry.operators import quality as Q
from quarry.plans import jobs as J
from quarry.plans import registry as R
from quarry.plans.refresh import refresh
from quarry.session import prepare, scratch_path
from quarry.sinks import versions as V
from quarry.sinks import writers as W
from quarry.sources import catalog as A_cat
from quarry.spec import DatasetSpec, FilterSpec, JobSpec
from quarry.functions.filters import apply_filters
from quarry.streaming.errors import log_error_stream, read_error_counts

register, table = R.register, R.table


# --- versions and appends -----------------------------------------------------

@register("publish_versions", """
SELECT 1 AS version, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 2, o_orderkey, o_orderstatus, o_totalprice FROM orders
""")
def publish_versions(spark, sf):
    # two versions stay readable; a third publisher that began from the first one is refused
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "orders_versions")
    W.export_parquet(o.where(F.col("o_orderstatus") != "P"), path, versioned=True)
    W.export_parquet(o, path, partition_by=["o_orderstatus"])
    try:
        V.publish_version(o.limit(0), path, expect=1)
        raise AssertionError("a stale publisher must be refused")
    except V.ConcurrentPublish:
        pass
    parts = [V.read_version(spark, path, n).withColumn("version", F.lit(n)) for n in (1, V.latest_version(spark, path))]
    return parts[0].unionByName(parts[1])


@register("append_repeated", "SELECT * FROM orders")
def append_repeated(spark, sf):
    # the second append fails after writing its files, and is then done twice
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "orders_appended")
    odd = F.col("o_orderkey") % 2 == 1
    W.append_table(o.where(odd), path, partition_by=["o_orderstatus"], txn="day-1")

    def killed():
        raise InterruptedError("killed before the commit")

    try:
        V.append_version(o.where(~odd), path, txn="day-2", partition_by=["o_orderstatus"], allowed=killed)
    except InterruptedError:
        pass
    for _ in range(2):
        W.append_table(o.where(~odd), path, partition_by=["o_orderstatus"], txn="day-2")
    return V.read_version(spark, path)


# --- order index --------------------------------------------------------------

@register("page_indexed", """
SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS row_no FROM events
ORDER BY ts DESC, event_id DESC LIMIT 50 OFFSET (SELECT (count(*) - 1) // 50 * 50 FROM events)
""")
def page_indexed(spark, sf):
    path = OI.build_order_index(table(spark, sf, "events"), ["ts", "event_id"], scratch_path(spark, "events_ordered"))
    last = OI.indexed_summary(spark, path, 1, 50).first()["total_pages"]
    return OI.indexed_page(spark, path, last, 50, row_no="row_no")


@register("page_summary_indexed", """
SELECT count(*) AS total_rows, CAST(ceil(count(*) / 100.0) AS BIGINT) AS total_pages,
       CAST(CASE WHEN count(*) >= 301 THEN 301 ELSE 0 END AS BIGINT) AS first_row, least(count(*), 400) AS last_row
FROM lineitem
""")
def page_summary_indexed(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    path = OI.build_order_index(li, ["l_orderkey", "l_linenumber"], scratch_path(spark, "lines_ordered"), check_key=False)
    return OI.indexed_summary(spark, path, 4, 100)


# --- filters ------------------------------------------------------------------

@register("filter_bloom", "SELECT * FROM orders WHERE o_custkey = 37")
def filter_bloom(spark, sf):
    path = W.export_parquet(table(spark, sf, "orders"), scratch_path(spark, "orders_bloom"), bloom_columns=["o_custkey"])
    return apply_filters(spark.read.parquet(path), [FilterSpec("o_custkey", "number", "37")])


@register("filter_number_text", R.DIRTY_SQL + """
SELECT l_orderkey, l_linenumber, qty_txt FROM dirty WHERE TRY_CAST(nullif(qty_txt, '') AS DOUBLE) = 17
""")
def filter_number_text(spark, sf):
    # a number filter on a text column that also holds 'abc', blanks and 17.5
    dirty = R.dirty_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "qty_txt")
    as_int = apply_filters(dirty, [FilterSpec("qty_txt", "int", "17")])
    return apply_filters(as_int, [FilterSpec("qty_txt", "number", "17.0")])


@register("filter_number_float", """
SELECT l_orderkey, l_linenumber, CAST(l_discount AS FLOAT) AS discount FROM lineitem
WHERE CAST(l_discount AS FLOAT) = CAST(0.07 AS FLOAT)
""")
def filter_number_float(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").cast("float").alias("discount"))
    return apply_filters(li, [FilterSpec("discount", "number", "0.07")])


@register("filter_definitions", """
SELECT n_name AS db_item, 'nation' AS table_name, CASE WHEN n_regionkey % 2 = 0 THEN 'プルダウン' ELSE 'チェックボックス' END AS input_type,
       o.code, o.label
FROM nation, (SELECT 'k' AS code, 'first label' AS label UNION ALL SELECT 'alone', 'alone') o
WHERE n_nationkey % 3 <> 0
""")
def filter_definitions(spark, sf):
    n = table(spark, sf, "nation")
    odd = F.col("n_regionkey") % 2 == 0
    sheet = n.select(F.concat(F.lit(" "), "n_name").alias("DB項目"), F.lit("nation").alias("TABLE_NAME"),
                     F.when(odd, F.lit("プルダウン")).otherwise(F.lit("チェックボックス")).alias("入力方式"),
                     F.lit("k first label\n\nalone").alias("選択項目"),
                     F.when(F.col("n_nationkey") % 3 == 0, F.lit("")).otherwise(F.lit(" true ")).alias("絞込"))
    return Q.filter_definitions(sheet).select("db_item", "table_name", "input_type", F.inline("options"))


# --- sinks --------------------------------------------------------------------

@register("export_csv_merged", "SELECT * FROM orders")
def export_csv_merged(spark, sf):
    o = table(spark, sf, "orders")
    path = W.export_csv_merged(o, scratch_path(spark, "orders_merged.csv"), keys=["o_orderkey"])
    return R.read_back_csv(spark, path, o.schema)


@register("cast_rejects", R.DIRTY_SQL + f"""
, bad AS (
  SELECT l_orderkey, l_linenumber, qty_txt, price_txt, ship_txt,
    trim(qty_txt) NOT IN ('', 'nan', 'None') AND ({R.LENIENT_QTY}) IS NULL AS b1,
    trim(price_txt) NOT IN ('', 'nan', 'None') AND {R.LENIENT_PRICE} IS NULL AS b2,
    trim(ship_txt) NOT IN ('', 'nan', 'None') AND {R.PARSED_SHIP} IS NULL AS b3
  FROM dirty)
SELECT l_orderkey, l_linenumber, CAST(NULL AS VARCHAR) AS column, CAST(NULL AS VARCHAR) AS value FROM bad WHERE NOT (b1 OR b2 OR b3)
UNION ALL SELECT l_orderkey, l_linenumber, 'qty_txt', qty_txt FROM bad WHERE b1
UNION ALL SELECT l_orderkey, l_linenumber, 'price_txt', price_txt FROM bad WHERE b2
UNION ALL SELECT l_orderkey, l_linenumber, 'ship_txt', ship_txt FROM bad WHERE b3
""")
def cast_rejects(spark, sf):
    # the good rows once each, and every value that kept a row out of them
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "rejects")
    W.export_parquet_checked(R.dirty_lineitem(spark, sf), good, bad, R.DIRTY_TYPES)
    keys = ["l_orderkey", "l_linenumber"]
    none = F.lit(None).cast("string")
    return spark.read.parquet(good).select(*keys, none.alias("column"), none.alias("value")) \
        .unionByName(spark.read.parquet(bad).select(*keys, F.inline("problems")))


# --- profiles -----------------------------------------------------------------

@register("profile_merged", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, count(*) AS n_rows, count(*) - count({c}) AS nulls, round(min({n}), 4) AS least, round(max({n}), 4) AS most, "
    f"round(avg({n}), 4) AS mean, round(stddev_samp({n}), 4) AS std, true AS distinct_within, {w} AS median_within FROM orders"
    for c, n, w in (("o_orderkey", "CAST(o_orderkey AS DOUBLE)", "true"), ("o_totalprice", "o_totalprice", "true"),
                    ("o_orderstatus", "CAST(NULL AS DOUBLE)", "CAST(NULL AS BOOLEAN)"))))
def profile_merged(spark, sf):
    # three runs, one of them repeated; the sketches are held against exact figures of the whole
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch_path(spark, "orders_profile")
    for run in ("F", "O", "P", "F"):
        P.save_profile(o.where(F.col("o_orderstatus") == run), path, run)
    merged = P.stored_profile(spark, path)
    median = {r["column"]: r["q"] for r in merged.where("quantiles is not null").select("column", F.col("quantiles")[1].alias("q")).collect()}
    checks = []
    for c in o.columns:
        # a value's own rank may span several rows
        low, high = (F.avg((F.col(c) < F.lit(median.get(c))).cast("int")), F.avg((F.col(c) <= F.lit(median.get(c))).cast("int")))
        held = (low - P.RANK_ERROR <= 0.5) & (high + P.RANK_ERROR >= 0.5) if c in median else F.lit(None).cast("boolean")
        checks.append(o.agg(F.lit(c).alias("column"), F.count_distinct(c).alias("exact"), held.alias("median_within")))
    exact = checks[0].unionByName(checks[1]).unionByName(checks[2])
    within = F.abs(F.col("distinct_estimate") - F.col("exact")) <= P.DISTINCT_ERROR * F.col("exact")
    rounded = [F.round(c, 4).alias(c) for c in ("least", "most", "mean", "std")]
    return merged.join(exact, "column").select("column", "n_rows", "nulls", *rounded, within.alias("distinct_within"), "median_within")


# --- catalog ------------------------------------------------------------------

@register("catalog_inventory", """
SELECT 'orders' AS table_name, count(*) AS row_count, false AS counted FROM orders
UNION ALL SELECT 'customer', count(*), false FROM customer
UNION ALL SELECT 'part', count(*), true FROM part
""")
def catalog_inventory(spark, sf):
    # two analysed tables and one without statistics, under names of their own
    prepare(spark)
    tag = f"inventory_{uuid.uuid4().hex}_"
    names = [f"{tag}{t}" for t in ("orders", "customer", "part")]
    for name in names:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{sf.rstrip('/')}/{name.removeprefix(tag)}.parquet'")
    A_cat.analyze(spark, names[:2])
    found = A_cat.catalog_inventory(spark, names)
    return found.select(F.substring(F.col("table_name"), len(tag) + 1, 99).alias("table_name"), "row_count", "counted")


# --- streams ------------------------------------------------------------------

@register("stream_errors_once", R.LOG_SQL + """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS n_errors
FROM (SELECT DISTINCT line, ts FROM parsed WHERE is_error AND ts IS NOT NULL) GROUP BY 1
""")
def stream_errors_once(spark, sf):
    # every log file is delivered twice
    prepare(spark)
    root = scratch_path(spark, "log_twice")
    lines = R.log_lines(table(spark, sf, "events"))
    for _ in range(2):
        lines.write.mode("append").text(f"{root}/logs")
    query = log_error_stream(spark, f"{root}/logs", f"{root}/out", f"{root}/checkpoint", once=True)
    query.awaitTermination()
    return read_error_counts(spark, f"{root}/out")


# --- batch --------------------------------------------------------------------

@register("run_manifest_deadline", """
SELECT 'slow' AS display_name, CAST(NULL AS BIGINT) AS row_count, '失敗' AS result, 'JobTimeout: not done after 2 seconds' AS error
UNION ALL SELECT 'customers', count(*), '成功', '' FROM customer
UNION ALL SELECT 'appended', count(*), '成功', '' FROM part
""")
def run_manifest_deadline(spark, sf):
    # a scan that waits at every row is cancelled at its deadline; the jobs behind it run
    prepare(spark)
    wait = F.expr("java_method('java.lang.Thread', 'sleep', 500L) is null or o_orderkey is not null")
    specs = R.dataset_specs(sf) | {"slow": DatasetSpec("slow", lambda s: table(s, sf, "orders").where(wait), ["o_orderkey"]),
                                   "part": DatasetSpec("part", lambda s: table(s, sf, "part"), ["p_partkey"])}
    jobs = [JobSpec("slow", "slow", display_name="slow", timeout_s="2"),
            JobSpec("customer_master", "customers", display_name="customers"),
            JobSpec("part", "part", target="スプシ", paste_mode="最終行積立て", sheet_name="parts", display_name="appended")]
    root = scratch_path(spark, "deadline")
    out = J.run_manifest(spark, jobs, specs, R.AS_OF_ORDERS, f"{root}/out", f"{root}/audit", run_id=uuid.uuid4().hex,
                         now=R.RUN_STAMP, timeout_s=600, retries=1, committed=True)
    return out.select("display_name", "row_count", "result", "error")


@register("refresh_changed", """
SELECT 'all' AS run, 'customer' AS display_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'all', 'supplier', count(*) FROM supplier
UNION ALL SELECT 'all', 'nation', count(*) FROM nation
UNION ALL SELECT 'changed', 'supplier', 2 * count(*) FROM supplier
""")
def refresh_changed(spark, sf):
    # three sources; then one of them gets a further file, and only its job runs
    root = scratch_path(spark, "refresh")
    names = ["customer", "supplier", "nation"]
    for name in names:
        table(spark, sf, name).write.parquet(f"{root}/in/{name}")
    specs = {n: DatasetSpec(n, lambda s, n=n: s.read.parquet(f"{root}/in/{n}")) for n in names}
    jobs = [JobSpec(n, n, display_name=n) for n in names]
    inputs = {n: [f"{root}/in/{n}"] for n in names}
    done = []
    for run in ("all", "changed"):
        audit = refresh(spark, jobs, specs, inputs, f"{root}/listing", R.AS_OF_ORDERS, f"{root}/out", f"{root}/audit", run_id=run)
        done.append(audit.select(F.lit(run).alias("run"), "display_name", "row_count"))
        table(spark, sf, "supplier").write.mode("append").parquet(f"{root}/in/supplier")
    return done[0].unionByName(done[1])
