"""The registered queries: one per operator slug of the survey, each with
the DuckDB SQL that must return the same rows.

Every query reads the given tables (or frames Spark derives from them) in
full. Where a rule needs values the tables lack (blanks, bad numbers, nulls,
JSON documents, log lines), they are derived from table columns with
``CASE`` expressions, identically in the Spark plan and in the SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quarry.functions import casting as C
from quarry.functions import filters as FL
from quarry.functions.period import criterion_columns, period_filter
from quarry.functions.text import alias_projection, preview_truncate, resolve_alias
from quarry.operators import monitor as M
from quarry.operators import paging as S
from quarry.operators import quality as Q
from quarry.operators.setops import union_chunks
from quarry.plans import jobs as J
from quarry.plans.dataset import filtered_view
from quarry.session import prepare, scratch_path
from quarry.sinks import writers as W
from quarry.sources import catalog as A_cat
from quarry.sources import files as A_files
from quarry.sources import sql as A_sql
from quarry.spec import DatasetSpec, FilterSpec, JobSpec
from quarry.streaming.errors import error_count_stream, read_error_counts

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

AS_OF_ORDERS = dt.date(1998, 6, 15)
AS_OF_EVENTS = dt.date(2024, 1, 15)
LOG_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
RUN_STAMP = dt.datetime(2024, 2, 1, 6, 0, 0)


def register(slug: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[slug] = fn
        if sql is not None:
            ORACLES[slug] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table."""
    prepare(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def read_back_csv(spark: SparkSession, path: str, like: T.StructType, encoding: str = A_files.UTF8,
                  sep: str = ",") -> DataFrame:
    """Read a written CSV as text and cast every column back to ``like``."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in like.fields])
    raw = A_files.scan_csv(spark, path, encoding=encoding, schema=text_schema, sep=sep)
    out = []
    for f in like.fields:
        c = F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit("")).cast(f.dataType)
        out.append(c.alias(f.name))
    return raw.select(*out)


# ---------------------------------------------------------------------------
# Flagship: orders -> period (P6) -> status (F7) -> date range (F8) -> page
# ---------------------------------------------------------------------------

FLAGSHIP_SQL = """
SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-06-15 00:00:00'
  AND o_orderstatus IN ('F', 'O')
  AND o_orderdate >= TIMESTAMP '1997-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-04-01 00:00:00'
ORDER BY o_orderkey DESC LIMIT 100
"""


@register("flagship_view", FLAGSHIP_SQL)
def flagship_view(spark, sf):
    orders = period_filter(table(spark, sf, "orders"), "1997年1月1日～前日まで累積", "o_orderdate", AS_OF_ORDERS)
    filters = [FilterSpec("o_orderstatus", "multi", {"F": True, "O": True, "P": False}),
               FilterSpec("o_orderdate", "date_range", {"start_date": "1997-03-01", "end_date": "1998-03-31"})]
    return filtered_view(orders, filters, ["o_orderkey"], 1, 100)


# ---------------------------------------------------------------------------
# A: scans and sources
# ---------------------------------------------------------------------------

@register("scan_parquet", """
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1999-01-01 00:00:00'
""")
def scan_parquet(spark, sf):
    prepare(spark)
    return A_files.scan_parquet(spark, f"{sf}/lineitem.parquet",
                                columns=["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"],
                                where=F.col("l_shipdate") >= F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))


@register("scan_parquet_head", """
SELECT *, (SELECT count(*) FROM orders) AS total_rows FROM orders ORDER BY o_orderkey DESC LIMIT 20
""")
def scan_parquet_head(spark, sf):
    prepare(spark)
    return A_files.scan_parquet_head(spark, f"{sf}/orders.parquet", ["o_orderkey"], 20)


REVENUE_SQL = """
SELECT o.o_orderstatus, count(*) AS n_lines,
       round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderstatus
"""


def stream_source(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """A streaming file source for a table stored either as one file (read
    its folder, filtered to that file name) or as a folder of part files."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(hpath).isDirectory():
        return path, None
    return path.rsplit("/", 1)[0], path.rsplit("/", 1)[1]


def _views(spark, sf, names):
    A_sql.register_tables(spark, {n: f"{sf}/{n}.parquet" for n in names})


@register("scan_query", REVENUE_SQL)
def scan_query(spark, sf):
    prepare(spark)
    _views(spark, sf, ["orders", "lineitem"])
    book = A_sql.QueryBook(texts={"revenue_by_status": REVENUE_SQL + ";"})
    return A_sql.scan_query(spark, book, "revenue_by_status.sql")


ADHOC_SQL = """
SELECT c_mktsegment, count(*) AS n_customers, round(avg(c_acctbal), 2) AS avg_acctbal
FROM customer GROUP BY c_mktsegment ORDER BY n_customers DESC, c_mktsegment
"""


@register("scan_adhoc_sql", ADHOC_SQL + " LIMIT 3")
def scan_adhoc_sql(spark, sf):
    prepare(spark)
    _views(spark, sf, ["customer"])
    return A_sql.scan_adhoc_sql(spark, ADHOC_SQL, limit=3)


@register("scan_fallback_table", "SELECT * FROM supplier")
def scan_fallback_table(spark, sf):
    prepare(spark)
    _views(spark, sf, ["supplier"])
    return A_sql.scan_query(spark, A_sql.QueryBook(texts={}), "supplier_report.sql", fallback_table="supplier")


@register("query_page", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 50")
def query_page(spark, sf):
    return A_sql.query_page(table(spark, sf, "orders"), ["o_orderkey"], limit=25, offset=50)


@register("query_count", "SELECT count(*) AS row_count FROM orders WHERE o_orderstatus = 'O'")
def query_count(spark, sf):
    return A_sql.query_count(table(spark, sf, "orders").where(F.col("o_orderstatus") == "O"))


@register("scan_partitioned", "SELECT * FROM lineitem")
def scan_partitioned(spark, sf):
    prepare(spark)
    return A_files.scan_partitioned(spark, f"{sf}/lineitem.parquet")


@register("scan_csv", "SELECT * FROM customer")
def scan_csv(spark, sf):
    customer = table(spark, sf, "customer")
    path = W.export_csv(customer, scratch_path(spark, "customer.csv"), encoding=A_files.CP932)
    return read_back_csv(spark, path, customer.schema, encoding=A_files.CP932)


@register("table_inventory", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS comment FROM {t}" for t in sorted(TABLES)))
def table_inventory(spark, sf):
    return A_cat.table_inventory(spark, {t: table(spark, sf, t) for t in TABLES})


# ---------------------------------------------------------------------------
# B: projections
# ---------------------------------------------------------------------------

ORDER_ALIASES = {"order_no": "o_orderkey", "customer_no": "o_custkey", "status": "o_orderstatus",
                 "amount": "o_totalprice", "ordered_on": "o_orderdate"}


@register("alias_projection", """
SELECT o_orderkey AS order_no, o_custkey AS customer_no, o_orderstatus AS status,
       o_totalprice AS amount, o_orderdate AS ordered_on
FROM orders WHERE o_orderstatus = 'F'
""")
def alias_projection_q(spark, sf):
    orders = table(spark, sf, "orders")
    source = resolve_alias(ORDER_ALIASES, "status")  # a filter on an alias hits its source column
    return alias_projection(orders.where(F.col(source) == "F"), ORDER_ALIASES)


@register("preview_truncate", """
SELECT doc_id, CASE WHEN length(text) > 35 THEN substr(text, 1, 35) || '...' ELSE text END AS text, lang
FROM documents
""")
def preview_truncate_q(spark, sf):
    return preview_truncate(table(spark, sf, "documents").select("doc_id", "text", "lang"), 35)


# ---------------------------------------------------------------------------
# F: typed filters
# ---------------------------------------------------------------------------

def _filtered(spark, sf, name, specs, cols=None, nulls_as_blank=False):
    df = FL.apply_filters(table(spark, sf, name), specs, nulls_as_blank)
    return df.select(*cols) if cols else df


@register("filter_text_ci", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(RED|Blue) ', 'i')")
def filter_text_ci(spark, sf):
    return _filtered(spark, sf, "part", [FilterSpec("p_name", "text", "^(RED|Blue) ")], ["p_partkey", "p_name"])


@register("filter_text_regex", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, 'Licen[sc]e[ds]? under')")
def filter_text_regex(spark, sf):
    return _filtered(spark, sf, "documents", [FilterSpec("text", "regex", "Licen[sc]e[ds]? under")], ["doc_id", "lang"])


@register("filter_substring", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def filter_substring(spark, sf):
    return _filtered(spark, sf, "part", [FilterSpec("p_name", "substring", "ring")], ["p_partkey", "p_name"])


@register("filter_int_equals", "SELECT * FROM part WHERE p_size = 15")
def filter_int_equals(spark, sf):
    return _filtered(spark, sf, "part", [FilterSpec("p_size", "int", " 15 ")])


@register("filter_numeric_equals", "SELECT * FROM lineitem WHERE l_quantity = 24.0")
def filter_numeric_equals(spark, sf):
    return _filtered(spark, sf, "lineitem", [FilterSpec("l_quantity", "number", "24")])


@register("filter_choice", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_choice(spark, sf):
    return _filtered(spark, sf, "customer", [FilterSpec("c_mktsegment", "choice", "BUILDING"),
                                              FilterSpec("c_nationkey", "choice", "-")])


@register("filter_multi_choice", "SELECT * FROM part WHERE p_size IN (1, 3, 50)")
def filter_multi_choice(spark, sf):
    # '02' can never equal the text of a long, so it is dropped
    return _filtered(spark, sf, "part", [FilterSpec("p_size", "multi", {"1": True, "02": True, "3": True,
                                                                      "50": True, "7": False})])


@register("filter_date_range", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-13 00:00:00'
""")
def filter_date_range(spark, sf):
    return _filtered(spark, sf, "events", [FilterSpec("ts", "date_range",
                                                      {"start_date": "2024-01-10", "end_date": "2024-01-12"})])


@register("filter_date_range_midnight", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'
""")
def filter_date_range_midnight(spark, sf):
    return _filtered(spark, sf, "events", [FilterSpec("ts", "date_range_midnight",
                                                      {"start_date": "2024/01/10", "end_date": "2024/01/12"})])


@register("filter_sql_date_range", """
SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-03-31 00:00:00'
""")
def filter_sql_date_range(spark, sf):
    return _filtered(spark, sf, "orders", [FilterSpec("o_orderdate", "sql_date_range",
                                                      {"start_date": "1996-01-01", "end_date": "1996-03-31"})])


@register("filter_date_equals", "SELECT * FROM orders WHERE o_orderdate = TIMESTAMP '1997-05-28 00:00:00'")
def filter_date_equals(spark, sf):
    return _filtered(spark, sf, "orders", [FilterSpec("o_orderdate", "date_equals", "1997-05-28")])


def _customer_json(spark, sf):
    c = table(spark, sf, "customer")
    tag = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", "c_mktsegment", "c_nationkey",
                    F.to_json(F.struct(F.col("c_mktsegment").alias("seg"), F.array(F.col("c_mktsegment"), tag).alias("tags"),
                                       F.col("c_nationkey").alias("nation"))).alias("profile"),
                    F.to_json(F.array(F.col("c_mktsegment"), tag)).alias("tag_list"))


@register("filter_json_path", """
SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
WHERE list_contains([c_mktsegment, 'n' || CAST(c_nationkey AS VARCHAR)], 'n7')
""")
def filter_json_path(spark, sf):
    # '$.nation' holds a number, so the string "7" never matches there
    specs = [FilterSpec("profile", "json_path", "n7", path="$.tags")]
    df = FL.apply_filters(_customer_json(spark, sf), specs)
    df = df.where(~FL.json_contains(F.col("profile"), "7", "$.nation"))
    return df.select("c_custkey", "c_mktsegment", "c_nationkey")


@register("filter_json_root", """
SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def filter_json_root(spark, sf):
    df = FL.apply_filters(_customer_json(spark, sf), [FilterSpec("tag_list", "json_root", "BUILDING")])
    return df.select("c_custkey", "c_mktsegment", "c_nationkey")


@register("filter_equals", "SELECT * FROM supplier WHERE s_nationkey = 7")
def filter_equals(spark, sf):
    return _filtered(spark, sf, "supplier", [FilterSpec("s_nationkey", "equals", "7")])


def _orders_soft_delete(spark, sf):
    o = table(spark, sf, "orders")
    return o.withColumn("deleted_at", F.when(F.col("o_orderstatus") == "F",
                                             F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")))


@register("filter_not_deleted", "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus <> 'F'")
def filter_not_deleted(spark, sf):
    return _orders_soft_delete(spark, sf).where(FL.not_deleted("deleted_at")) \
        .select("o_orderkey", "o_orderstatus", "o_orderdate")


@register("filter_combined", """
SELECT * FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
  AND regexp_matches(CAST(o_custkey AS VARCHAR), '1')
""")
def filter_combined(spark, sf):
    specs = [FilterSpec("o_orderstatus", "choice", "O"),
             FilterSpec("o_orderpriority", "multi", ["1-URGENT", "2-HIGH"]),
             FilterSpec("o_orderdate", "date_range", {"start_date": "1996-01-01", "end_date": "1997-12-31"}),
             FilterSpec("o_custkey", "regex", "1"),
             FilterSpec("no_such_column", "choice", "x")]
    return S.newest_first(_filtered(spark, sf, "orders", specs), ["o_orderkey"])


@register("filter_partitioned", """
SELECT * FROM lineitem
WHERE regexp_matches(l_returnflag, 'r', 'i') AND l_quantity = 10 AND l_linenumber = 2
""")
def filter_partitioned(spark, sf):
    return FL.typed_filter(table(spark, sf, "lineitem"),
                           {"l_returnflag": "r", "l_quantity": "10", "l_linenumber": "2", "l_tax": ""})


@register("null_normalize", """
SELECT l_orderkey, coalesce(nullif(l_returnflag, 'N'), '') AS flag,
       coalesce(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END, 0) AS line, l_discount
FROM lineitem WHERE l_linenumber = 1 OR l_linenumber = 0
""")
def null_normalize(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.when(F.col("l_linenumber") != 1, F.col("l_linenumber")).alias("line"), "l_discount")
    kept = FL.apply_filters(li, [FilterSpec("line", "int", "0")], nulls_as_blank=True)
    return FL.normalize_nulls(kept)


# ---------------------------------------------------------------------------
# P: period filters
# ---------------------------------------------------------------------------

def _period_orders(phrase, on_unknown="raise", category=None):
    def q(spark, sf):
        df = period_filter(table(spark, sf, "orders"), phrase, "o_orderdate", AS_OF_ORDERS,
                           category=category, on_unknown=on_unknown)
        return df.select("o_orderkey", "o_orderdate")
    return q


def _period_events(phrase):
    def q(spark, sf):
        return period_filter(table(spark, sf, "events"), phrase, "ts", AS_OF_EVENTS).select("event_id", "ts")
    return q


def _o(cond):
    return f"SELECT o_orderkey, o_orderdate FROM orders WHERE {cond}"


def _e(cond):
    return f"SELECT event_id, ts FROM events WHERE {cond}"


def _ts(day):
    return f"TIMESTAMP '{day} 00:00:00'"


PERIOD_CASES = [
    ("period_before_month", "orders", "月初未満", _o(f"o_orderdate < {_ts('1998-06-01')}")),
    ("period_today", "events", "当日", _e(f"ts >= {_ts('2024-01-15')} AND ts < {_ts('2024-01-16')}")),
    ("period_yesterday", "events", "前日", _e(f"ts >= {_ts('2024-01-14')} AND ts < {_ts('2024-01-15')}")),
    ("period_to_yesterday", "orders", "前日まで累積", _o(f"o_orderdate < {_ts('1998-06-15')}")),
    ("period_to_today", "orders", "当日まで累積", _o(f"o_orderdate < {_ts('1998-06-16')}")),
    ("period_from_to_yesterday", "orders", "1998年1月1日～前日まで累積",
     _o(f"o_orderdate >= {_ts('1998-01-01')} AND o_orderdate < {_ts('1998-06-15')}")),
    ("period_from_to_today", "events", "2024年1月10日～当日まで累積",
     _e(f"ts >= {_ts('2024-01-10')} AND ts < {_ts('2024-01-16')}")),
    ("period_between", "orders", "1997年3月1日～6月30日まで",
     _o(f"o_orderdate >= {_ts('1997-03-01')} AND o_orderdate < {_ts('1997-07-01')}")),
    ("period_between_span", "events", "2024年1月3日〜2024年1月5日〜までの期間",
     _e(f"ts >= {_ts('2024-01-03')} AND ts < {_ts('2024-01-06')}")),
    ("period_days_ago", "events", "3日前時点を1日分", _e(f"ts >= {_ts('2024-01-12')} AND ts < {_ts('2024-01-13')}")),
    ("period_on_date", "events", "2024年1月20日", _e(f"ts >= {_ts('2024-01-20')} AND ts < {_ts('2024-01-21')}")),
    ("period_last_days", "events", "過去7日間", _e(f"ts >= {_ts('2024-01-08')} AND ts < {_ts('2024-01-16')}")),
    ("period_synonyms", "events", "前日のみ", _e(f"ts >= {_ts('2024-01-14')} AND ts < {_ts('2024-01-15')}")),
]

for _slug, _table, _phrase, _sql in PERIOD_CASES:
    register(_slug, _sql)(_period_orders(_phrase) if _table == "orders" else _period_events(_phrase))


@register("period_either_column", """
SELECT o.o_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE (o.o_orderdate >= TIMESTAMP '1998-06-01 00:00:00' AND o.o_orderdate < TIMESTAMP '1998-07-01 00:00:00')
   OR (l.l_shipdate >= TIMESTAMP '1998-06-01 00:00:00' AND l.l_shipdate < TIMESTAMP '1998-07-01 00:00:00')
""")
def period_either_column(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    joined = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    df = period_filter(joined, "1998年6月1日～1998年6月30日～までの期間", ["o_orderdate", "l_shipdate"], AS_OF_ORDERS)
    return df.select("o_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")


@register("period_criteria", _o(f"o_orderdate >= {_ts('1998-06-14')} AND o_orderdate < {_ts('1998-06-15')}"))
def period_criteria(spark, sf):
    mapping = {"登録日時": "o_orderdate", "更新日時": "o_orderdate"}
    column = criterion_columns("登録日時", mapping)
    return period_filter(table(spark, sf, "orders"), "前日", column, AS_OF_ORDERS).select("o_orderkey", "o_orderdate")


register("period_bypass", "SELECT o_orderkey, o_orderdate FROM orders")(
    _period_orders("前日", category="マスタ"))
register("period_unknown", "SELECT o_orderkey, o_orderdate FROM orders")(
    _period_orders("来月の第二週", on_unknown="ignore"))


# ---------------------------------------------------------------------------
# T: typing and cleaning
# ---------------------------------------------------------------------------

DIRTY_SQL = """
WITH dirty AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 7 = 0 THEN '' WHEN l_orderkey % 7 = 1 THEN 'abc'
         WHEN l_orderkey % 7 = 2 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.5'
         WHEN l_orderkey % 7 = 3 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0'
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qty_txt,
    CASE WHEN l_orderkey % 5 = 0 THEN 'None' ELSE CAST(l_extendedprice AS VARCHAR) END AS price_txt,
    CASE WHEN l_orderkey % 6 = 0 THEN strftime(l_shipdate, '%Y/%m/%d') WHEN l_orderkey % 6 = 1 THEN 'x'
         ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS ship_txt
  FROM lineitem)
"""
LENIENT_QTY = ("CASE WHEN TRY_CAST(trim(qty_txt) AS DECIMAL(38,10)) = floor(TRY_CAST(trim(qty_txt) AS DECIMAL(38,10))) "
               "THEN CAST(TRY_CAST(trim(qty_txt) AS DECIMAL(38,10)) AS BIGINT) END")
LENIENT_PRICE = "TRY_CAST(trim(price_txt) AS DOUBLE)"
PARSED_SHIP = ("coalesce(try_strptime(ship_txt, '%Y-%m-%d %H:%M:%S'), try_strptime(ship_txt, '%Y/%m/%d %H:%M:%S'), "
               "try_strptime(ship_txt, '%Y-%m-%d'), try_strptime(ship_txt, '%Y/%m/%d'))")
DIRTY_TYPES = {"qty_txt": "int", "price_txt": "float", "ship_txt": "date"}


def dirty_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.lit("abc")).when(k % 7 == 2, F.concat(qty, F.lit(".5")))
         .when(k % 7 == 3, F.concat(qty, F.lit(".0"))).otherwise(qty).alias("qty_txt"),
        F.when(k % 5 == 0, F.lit("None")).otherwise(F.col("l_extendedprice").cast("string")).alias("price_txt"),
        F.when(k % 6 == 0, F.date_format("l_shipdate", "yyyy/MM/dd")).when(k % 6 == 1, F.lit("x"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("ship_txt"))


@register("cast_strict", """
SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS qty, l_extendedprice AS price,
       CAST(l_shipdate AS DATE) AS ship, l_returnflag
FROM lineitem
""")
def cast_strict(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("bigint").cast("string").alias("qty"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship"), "l_returnflag")
    return C.cast_strict(li, {"qty": "int", "price": "float", "ship": "date", "l_returnflag": "txt", "absent": "int"})


@register("cast_lenient", DIRTY_SQL + f"""
SELECT l_orderkey, l_linenumber, {LENIENT_QTY} AS qty_txt, {LENIENT_PRICE} AS price_txt,
       CAST({PARSED_SHIP} AS DATE) AS ship_txt
FROM dirty
""")
def cast_lenient(spark, sf):
    return C.cast_lenient(dirty_lineitem(spark, sf), DIRTY_TYPES)


@register("cast_format", DIRTY_SQL + f"""
SELECT l_orderkey, l_linenumber, {LENIENT_QTY} AS qty_txt, {LENIENT_PRICE} AS price_txt,
       strftime({PARSED_SHIP}, '%Y/%m/%d') AS ship_txt
FROM dirty
""")
def cast_format(spark, sf):
    return C.cast_format(dirty_lineitem(spark, sf), DIRTY_TYPES)


@register("format_dates", """
SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS ts, strftime(ts, '%Y/%m/%d') AS day
FROM events
""")
def format_dates(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return C.format_dates(ev, {"ts": "datetime", "day": "date"})


@register("blank_nulls", """
SELECT doc_id,
       CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN '' ELSE lang END AS lang,
       CASE WHEN doc_id % 4 = 0 THEN '' ELSE source END AS source
FROM documents
""")
def blank_nulls(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    raw = d.select("doc_id", F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit("nan")).otherwise(F.col("lang")).alias("lang"),
                   F.when(k % 4 == 0, F.lit("None")).otherwise(F.col("source")).alias("source"))
    return C.blank_nulls(raw)


@register("zero_blank_ints", """
SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS qty
FROM lineitem
""")
def zero_blank_ints(spark, sf):
    li = table(spark, sf, "lineitem")
    qty = F.when(F.col("l_orderkey") % 7 == 0, F.lit("")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    return C.zero_blank_ints(li.select("l_orderkey", qty.alias("qty")), {"qty": "int"})


INTEGRAL_TEXT = "CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


@register("integral_text", f"""
SELECT l_orderkey, {INTEGRAL_TEXT.format(c='l_quantity')} AS l_quantity,
       {INTEGRAL_TEXT.format(c='l_discount')} AS l_discount, {INTEGRAL_TEXT.format(c='l_tax')} AS l_tax
FROM lineitem
""")
def integral_text(spark, sf):
    return C.to_text(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax")) \
        .withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))


@register("csv_prepare", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
       CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS l_quantity,
       {INTEGRAL_TEXT.format(c='l_extendedprice')} AS l_extendedprice,
       {INTEGRAL_TEXT.format(c='l_discount')} AS l_discount, {INTEGRAL_TEXT.format(c='l_tax')} AS l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem
""")
def csv_prepare(spark, sf):
    return C.csv_prepare(table(spark, sf, "lineitem"), {"l_quantity": "int", "l_extendedprice": "float"})


@register("csv_prepare_v2", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_prepare_v2(spark, sf):
    return C.csv_prepare_v2(table(spark, sf, "orders"))


@register("decimal_to_double", """
SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price FROM lineitem
""")
def decimal_to_double(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    return C.decimal_to_double(li)


@register("display_clean", """
SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_discount, l_returnflag FROM lineitem
""")
def display_clean(spark, sf):
    return C.display_clean(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_returnflag"))


@register("drop_empty_rows", "SELECT l_orderkey AS k, l_returnflag AS flag FROM lineitem WHERE l_linenumber <> 1")
def drop_empty_rows(spark, sf):
    li = table(spark, sf, "lineitem")
    gone = F.col("l_linenumber") == 1
    return C.drop_empty_rows(li.select(F.when(~gone, F.col("l_orderkey")).alias("k"),
                                       F.when(~gone, F.col("l_returnflag")).alias("flag")))


@register("infer_types", """
SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d,
       o_totalprice AS p, o_orderpriority AS prio, CAST(o_orderdate AS TIMESTAMP) AS dt19
FROM orders
""")
def infer_types(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("k"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
        F.col("o_totalprice").cast("string").alias("p"), F.col("o_orderpriority").alias("prio"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dt19"))
    return C.infer_types(o)


@register("downcast_types", """
SELECT CAST(c_custkey AS SMALLINT) AS c_custkey, c_name, CAST(c_nationkey AS TINYINT) AS c_nationkey,
       c_acctbal, c_mktsegment
FROM customer
""")
def downcast_types(spark, sf):
    frame, _report = C.downcast_types(table(spark, sf, "customer"))
    return frame


@register("sheet_cells", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
""")
def sheet_cells(spark, sf):
    return C.sheet_cells(table(spark, sf, "orders"))


# ---------------------------------------------------------------------------
# Q: validation and profiling
# ---------------------------------------------------------------------------

@register("validate_rules", """
WITH s AS (SELECT count(*) AS n, count(*) - count(l_orderkey) AS n1, count(*) - count(l_shipdate) AS n2 FROM lineitem)
SELECT 'min_columns' AS rule, CAST(NULL AS VARCHAR) AS column, '5' AS expected, '11' AS actual, true AS passed FROM s
UNION ALL SELECT 'min_rows', NULL, '100', CAST(n AS VARCHAR), n >= 100 FROM s
UNION ALL SELECT 'required_columns', 'l_orderkey', 'present', 'present', true FROM s
UNION ALL SELECT 'required_columns', 'l_comment', 'present', 'missing', false FROM s
UNION ALL SELECT 'no_null_columns', 'l_orderkey', '0', CAST(n1 AS VARCHAR), n1 = 0 FROM s
UNION ALL SELECT 'no_null_columns', 'l_shipdate', '0', CAST(n2 AS VARCHAR), n2 = 0 FROM s
UNION ALL SELECT 'column_types', 'l_quantity', 'float', 'double', true FROM s
UNION ALL SELECT 'column_types', 'l_linenumber', 'int', 'int', true FROM s
UNION ALL SELECT 'column_types', 'l_returnflag', 'int', 'string', false FROM s
""")
def validate_rules(spark, sf):
    rules = {"min_columns": 5, "min_rows": 100, "required_columns": ["l_orderkey", "l_comment"],
             "no_null_columns": ["l_orderkey", "l_shipdate"],
             "column_types": {"l_quantity": "float", "l_linenumber": "int", "l_returnflag": "int"}}
    return Q.validate_rules(table(spark, sf, "lineitem"), rules)


LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_NUMERIC = LINEITEM_COLUMNS[:8]


def _quality_sql() -> str:
    parts = ["SELECT '*' AS column, 'total_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM lineitem",
             "SELECT '*', 'total_columns', 11.0",
             "SELECT '*', 'duplicate_rows', CAST(coalesce(sum(n - 1), 0) AS DOUBLE) FROM "
             f"(SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(LINEITEM_COLUMNS)})"]
    for c in LINEITEM_COLUMNS:
        parts.append(f"SELECT '{c}', 'null_count', CAST(count(*) - count({c}) AS DOUBLE) FROM lineitem")
    for c in LINEITEM_NUMERIC:
        for metric, fn in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp")):
            # "+ 0.0" folds DuckDB's -0.0 from round() into 0.0
            parts.append(f"SELECT '{c}', '{metric}', round(CAST({fn}({c}) AS DOUBLE), 4) + 0.0 FROM lineitem")
    return "\nUNION ALL ".join(parts)


@register("quality_report", _quality_sql())
def quality_report(spark, sf):
    rep = Q.quality_report(table(spark, sf, "lineitem"))
    return rep.select("column", "metric", F.round("value", 4).alias("value"))


@register("duplicate_rows", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text)
""")
def duplicate_rows(spark, sf):
    return Q.duplicate_rows(table(spark, sf, "documents"), ["text"])


@register("type_conformance", DIRTY_SQL + f"""
SELECT 'qty_txt' AS column, 'int' AS expected, true AS exists,
       count_if(nullif(trim(qty_txt), '') IS NOT NULL AND TRY_CAST(trim(qty_txt) AS DOUBLE) IS NULL) = 0 AS valid,
       count_if(nullif(trim(qty_txt), '') IS NOT NULL AND TRY_CAST(trim(qty_txt) AS DOUBLE) IS NULL) AS bad_values FROM dirty
UNION ALL
SELECT 'price_txt', 'float', true,
       count_if(trim(price_txt) NOT IN ('', 'nan', 'None') AND TRY_CAST(trim(price_txt) AS DOUBLE) IS NULL) = 0,
       count_if(trim(price_txt) NOT IN ('', 'nan', 'None') AND TRY_CAST(trim(price_txt) AS DOUBLE) IS NULL) FROM dirty
UNION ALL
SELECT 'ship_txt', 'date', true, count_if({PARSED_SHIP} IS NULL) = 0, count_if({PARSED_SHIP} IS NULL) FROM dirty
UNION ALL
SELECT 'absent', 'int', false, false, CAST(NULL AS BIGINT)
""")
def type_conformance(spark, sf):
    return Q.type_conformance(dirty_lineitem(spark, sf), {**DIRTY_TYPES, "absent": "int"})


@register("column_profile", """
SELECT 'o_orderkey' AS column, 'bigint' AS dtype, count(o_orderkey) AS non_null, count(*) - count(o_orderkey) AS nulls FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus), count(*) - count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice), count(*) - count(o_totalprice) FROM orders
UNION ALL SELECT 'prio', 'string', count(nullif(o_orderpriority, '5-LOW')), count(*) - count(nullif(o_orderpriority, '5-LOW')) FROM orders
""")
def column_profile(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                          F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("prio"))
    return Q.column_profile(o)


@register("dataset_metrics", """
SELECT count(*) AS n_rows, (SELECT CAST(count(*) AS BIGINT) FROM (DESCRIBE lineitem)) AS n_columns FROM lineitem
""")
def dataset_metrics(spark, sf):
    prepare(spark)
    return Q.dataset_metrics(spark, f"{sf.rstrip('/')}/lineitem.parquet").drop("size_mb")  # the size has a unit test


@register("distinct_options", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL ORDER BY o_custkey")
def distinct_options(spark, sf):
    return Q.distinct_options(table(spark, sf, "orders"), "o_custkey")


# ---------------------------------------------------------------------------
# S: order and page
# ---------------------------------------------------------------------------

@register("newest_first", "SELECT * FROM orders ORDER BY o_orderkey DESC")
def newest_first(spark, sf):
    return S.newest_first(table(spark, sf, "orders"), ["o_orderkey"])


@register("page", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 50 OFFSET 100")
def page_q(spark, sf):
    return S.page(table(spark, sf, "events"), ["ts", "event_id"], 3, 50)


@register("page_summary", """
SELECT count(*) AS total_rows, CAST(ceil(count(*) / 100.0) AS BIGINT) AS total_pages,
       CAST(CASE WHEN count(*) >= 101 THEN 101 ELSE 0 END AS BIGINT) AS first_row,
       least(count(*), 200) AS last_row
FROM orders WHERE o_orderstatus = 'F'
""")
def page_summary(spark, sf):
    return S.page_summary(table(spark, sf, "orders").where(F.col("o_orderstatus") == "F"), 2, 100)


@register("page_prefetch", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 50 OFFSET 100")
def page_prefetch(spark, sf):
    return S.page_prefetch(table(spark, sf, "events"), ["ts", "event_id"], 2, 50)


@register("row_numbers", """
SELECT *, row_number() OVER (ORDER BY o_orderkey DESC) + 20 AS row_no
FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 20 OFFSET 20)
""")
def row_numbers(spark, sf):
    return S.row_numbers(table(spark, sf, "orders"), ["o_orderkey"], 2, 20)


@register("head_preview", "SELECT * FROM nation LIMIT 10")
def head_preview(spark, sf):
    return S.head_preview(table(spark, sf, "nation"), 10)


# ---------------------------------------------------------------------------
# U: union
# ---------------------------------------------------------------------------

@register("union_chunks", """
SELECT * FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P'
""")
def union_chunks_q(spark, sf):
    o = table(spark, sf, "orders")
    return union_chunks([o.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")])


# ---------------------------------------------------------------------------
# W: sinks (write to the shared folder, read back)
# ---------------------------------------------------------------------------

@register("export_csv", "SELECT * FROM customer")
def export_csv(spark, sf):
    customer = table(spark, sf, "customer")
    path = W.export_csv(customer, scratch_path(spark, "customer.csv"), types={"c_acctbal": "float"},
                        encoding=A_files.CP932)
    return read_back_csv(spark, path, customer.schema, encoding=A_files.CP932)


@register("export_csv_documents", "SELECT * FROM documents")
def export_csv_documents(spark, sf):
    docs = table(spark, sf, "documents")  # texts with line ends, quotes, commas and edge blanks
    path = W.export_csv(docs, scratch_path(spark, "documents.csv"))
    return read_back_csv(spark, path, docs.schema)


@register("export_csv_chunked", "SELECT * FROM lineitem")
def export_csv_chunked(spark, sf):
    li = table(spark, sf, "lineitem")
    path = W.export_csv_chunked(li, scratch_path(spark, "lineitem.csv"), chunk_rows=2000)
    return read_back_csv(spark, path, li.schema)


@register("export_parquet", DIRTY_SQL + f"""
SELECT l_orderkey, l_linenumber, {LENIENT_QTY} AS qty_txt, {LENIENT_PRICE} AS price_txt,
       CAST({PARSED_SHIP} AS DATE) AS ship_txt
FROM dirty
""")
def export_parquet(spark, sf):
    path = W.export_parquet(dirty_lineitem(spark, sf), scratch_path(spark, "dirty.parquet"), types=DIRTY_TYPES)
    return spark.read.parquet(path)


@register("export_parquet_newest", "SELECT * FROM orders")
def export_parquet_newest(spark, sf):
    path = W.export_parquet_newest(table(spark, sf, "orders"), scratch_path(spark, "orders.parquet"), ["o_orderkey"])
    return spark.read.parquet(path)


@register("export_tsv", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 100")
def export_tsv(spark, sf):
    o = table(spark, sf, "orders")
    path = W.export_tsv(S.page(o, ["o_orderkey"], 1, 100), scratch_path(spark, "page.tsv"))
    return read_back_csv(spark, path, o.schema, sep="\t")


@register("append_table", "SELECT * FROM orders")
def append_table(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "orders_log")
    odd = F.col("o_orderkey") % 2 == 1
    for half in (o.where(odd), o.where(~odd)):
        W.append_table(half, path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).select(*o.columns)


@register("replace_table", "SELECT * REPLACE (p_size + 1 AS p_size) FROM part")
def replace_table(spark, sf):
    p = table(spark, sf, "part")
    path = scratch_path(spark, "part_table")
    W.replace_table(p, path)
    W.replace_table(p.withColumn("p_size", F.col("p_size") + 1), path, W.PASTE_REPLACE)
    return spark.read.parquet(path)


@register("load_csv_to_table", "SELECT * FROM supplier")
def load_csv_to_table(spark, sf):
    s = table(spark, sf, "supplier")
    csv = W.export_csv(s, scratch_path(spark, "supplier.csv"), encoding=A_files.CP932)
    target = scratch_path(spark, "supplier_table")
    W.replace_table(s.limit(0), target)  # an existing table with its header only
    W.load_csv_to_table(spark, {csv: target}, encoding=A_files.CP932, schemas={csv: s.schema})
    return spark.read.parquet(target)


@register("audit_append", """
SELECT 'all_orders' AS display_name, 'orders' AS main_table, 'parquet' AS target,
       count(*) AS row_count, '成功' AS result FROM orders
UNION ALL
SELECT 'customers', 'customer', 'CSV', count(*), '成功' FROM customer
""")
def audit_append(spark, sf):
    audit = scratch_path(spark, "audit")
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n1 = W.write_counted(o, lambda d: W.export_parquet(d, scratch_path(spark, "all_orders.parquet")))
    W.audit_append(spark, audit, "all_orders", "", "orders", "", "parquet", n1, True)
    n2 = W.write_counted(c, lambda d: W.export_csv(d, scratch_path(spark, "customers.csv")))
    W.audit_append(spark, audit, "customers", "", "customer", "", "CSV", n2, True)
    return J.read_audit(spark, audit).select("display_name", "main_table", "target", "row_count", "result")


@register("export_view_csv", """
SELECT * FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
""")
def export_view_csv(spark, sf):
    o = table(spark, sf, "orders")
    folder = scratch_path(spark, "exports")
    path = W.export_view_csv(o, folder, [FilterSpec("o_orderstatus", "choice", "P"),
                                         FilterSpec("o_orderdate", "date_range", {"start_date": "1996-01-01"})],
                             now=RUN_STAMP)
    return read_back_csv(spark, path, o.schema, encoding=A_files.CP932)


# ---------------------------------------------------------------------------
# J: batch jobs over a manifest of test-table datasets
# ---------------------------------------------------------------------------

def dataset_specs(sf: str) -> dict[str, DatasetSpec]:
    def revenue_shape(df):
        li = df.sparkSession.read.parquet(f"{sf}/lineitem.parquet")
        return df.join(li, df["o_orderkey"] == li["l_orderkey"]).groupBy("o_orderstatus") \
            .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))

    return {
        "orders_by_date": DatasetSpec("orders_by_date", lambda s: table(s, sf, "orders"), ["o_orderkey"],
                                      criteria={"登録日時": "o_orderdate"}),
        "lineitem_shipped": DatasetSpec("lineitem_shipped", lambda s: table(s, sf, "lineitem"),
                                        ["l_orderkey", "l_linenumber"], criteria={"更新日時": "l_shipdate"},
                                        types={"l_quantity": "int", "l_extendedprice": "float"}),
        "customer_master": DatasetSpec("customer_master", lambda s: table(s, sf, "customer"), ["c_custkey"]),
        "orders_live": DatasetSpec("orders_live", lambda s: _orders_soft_delete(s, sf), ["o_orderkey"]),
        "revenue_by_status": DatasetSpec("revenue_by_status", lambda s: table(s, sf, "orders"), ["o_orderstatus"],
                                         shape=revenue_shape, criteria={"登録日時": "o_orderdate"}),
    }


MANIFEST = [
    JobSpec("orders_by_date", "orders_recent", "前日まで累積", "登録日時", "batch", "parquet",
            display_name="orders_recent", main_table="orders"),
    JobSpec("lineitem_shipped", "lineitem_1998", "1998年1月1日～前日まで累積", "更新日時", "batch", "CSV",
            display_name="lineitem_1998", main_table="lineitem"),
    JobSpec("customer_master", "customers", "前日", "登録日時", "batch", "parquet", category="マスタ",
            display_name="customers", main_table="customer"),
    JobSpec("orders_live", "orders_live", "", "", "batch", "parquet", exclude_deleted=True,
            display_name="orders_live", main_table="orders"),
    JobSpec("revenue_by_status", "revenue", "1998年1月1日～1998年3月31日～までの期間", "登録日時", "batch", "スプシ",
            paste_mode="全張替え", sheet_name="revenue_sheet", display_name="revenue", main_table="orders"),
    JobSpec("orders_by_date", "broken", "来週のどこか", "登録日時", "batch", "parquet",
            display_name="broken", main_table="orders"),
    JobSpec("customer_master", "customer_sheet", target="スプシ", paste_mode="数式", sheet_name="customer_sheet",
            display_name="formula", main_table="customer"),
]

MANIFEST_SQL = """
SELECT 'orders_recent' AS display_name, 'parquet' AS target, count(*) AS row_count, '成功' AS result
FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-15 00:00:00'
UNION ALL SELECT 'lineitem_1998', 'CSV', count(*), '成功' FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1998-06-15 00:00:00'
UNION ALL SELECT 'customers', 'parquet', count(*), '成功' FROM customer
UNION ALL SELECT 'orders_live', 'parquet', count(*), '成功' FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'revenue', 'スプシ', count(DISTINCT o_orderstatus), '成功'
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-04-01 00:00:00'
UNION ALL SELECT 'broken', 'parquet', CAST(NULL AS BIGINT), '失敗'
UNION ALL SELECT 'formula', 'スプシ', CAST(NULL AS BIGINT), '失敗'
"""


def _run(spark, sf, jobs):
    root = scratch_path(spark, "jobs")
    return J.run_manifest(spark, jobs, dataset_specs(sf), AS_OF_ORDERS, f"{root}/out", f"{root}/audit",
                          run_id=uuid.uuid4().hex, parallelism=3, now=RUN_STAMP)


@register("run_manifest", MANIFEST_SQL)
def run_manifest(spark, sf):
    prepare(spark)
    return _run(spark, sf, MANIFEST).select("display_name", "target", "row_count", "result")


@register("run_one", """
SELECT 'lineitem_1998' AS display_name, 'CSV' AS target, count(*) AS row_count, '成功' AS result FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1998-06-15 00:00:00'
""")
def run_one(spark, sf):
    prepare(spark)
    root = scratch_path(spark, "jobs")
    out = J.run_one(spark, MANIFEST, dataset_specs(sf), "lineitem", AS_OF_ORDERS, f"{root}/out",
                    f"{root}/audit", run_id=uuid.uuid4().hex, now=RUN_STAMP)
    return out.select("display_name", "target", "row_count", "result")


@register("job_summary", """
SELECT count(*) AS total_jobs, count(*) FILTER (WHERE o_orderstatus <> 'P') AS succeeded,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS failed,
       round(count(*) FILTER (WHERE o_orderstatus <> 'P') / count(*), 4) AS success_rate,
       CAST(epoch(max(o_orderdate + to_seconds(o_orderkey % 5000))) - epoch(min(o_orderdate)) AS BIGINT) AS duration_s
FROM orders
""")
def job_summary(spark, sf):
    # an audit table derived from orders: each order is a job that started on its date
    ok = F.when(F.col("o_orderstatus") != "P", W.RESULT_OK).otherwise(W.RESULT_FAILED)
    start = F.col("o_orderdate").cast("timestamp_ntz")
    audit = table(spark, sf, "orders").select(
        ok.alias("result"), start.alias("started_at"),
        (start + F.make_dt_interval(secs=(F.col("o_orderkey") % 5000).cast("decimal(18,6)"))).alias("logged_at"))
    return J.job_summary(audit).withColumn("success_rate", F.round("success_rate", 4))


# ---------------------------------------------------------------------------
# M: monitoring over log lines derived from events
# ---------------------------------------------------------------------------

LOG_SQL = r"""
WITH log AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN '?' ELSE '' END || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' - ' ||
    CASE event_type
      WHEN 'error' THEN 'ERROR - ★失敗★　q' || CAST(user_id % 17 AS VARCHAR) || '.sql: ' ||
        CASE user_id % 3 WHEN 0 THEN 'MySQL Connection lost' WHEN 1 THEN 'APIError quota exceeded' ELSE 'エラー unexpected' END
      WHEN 'purchase' THEN 'INFO - 処理完了: t' || CAST(user_id % 11 AS VARCHAR) || ' ' || CAST(event_id AS VARCHAR) || ' レコード処理完了'
      WHEN 'signup' THEN 'WARNING - 取込 ' || CAST(event_id AS VARCHAR) || ' レコード'
      ELSE 'INFO - ' || event_type END AS line
  FROM events),
parsed AS (
  SELECT line,
    CASE WHEN regexp_matches(substr(line, 1, 19), '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$')
         THEN try_strptime(substr(line, 1, 19), '%Y-%m-%d %H:%M:%S') END AS ts,
    (contains(line, 'ERROR') OR contains(line, 'エラー') OR contains(line, '失敗')) AS is_error
  FROM log)
"""


def log_lines(events: DataFrame) -> DataFrame:
    """Log text in the reference's layout, made from event rows."""
    uid, eid, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    error_msg = F.concat(F.lit("ERROR - ★失敗★　q"), (uid % 17).cast("string"), F.lit(".sql: "),
                         F.when(uid % 3 == 0, F.lit("MySQL Connection lost"))
                          .when(uid % 3 == 1, F.lit("APIError quota exceeded")).otherwise(F.lit("エラー unexpected")))
    msg = F.when(kind == "error", error_msg) \
        .when(kind == "purchase", F.concat(F.lit("INFO - 処理完了: t"), (uid % 11).cast("string"), F.lit(" "),
                                           eid.cast("string"), F.lit(" レコード処理完了"))) \
        .when(kind == "signup", F.concat(F.lit("WARNING - 取込 "), eid.cast("string"), F.lit(" レコード"))) \
        .otherwise(F.concat(F.lit("INFO - "), kind))
    line = F.concat(F.when(eid % 97 == 0, F.lit("?")).otherwise(F.lit("")),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" - "), msg)
    return events.select(line.alias("value"))


def parsed_log(spark, sf):
    return M.parse_log(log_lines(table(spark, sf, "events")))


@register("recent_errors", LOG_SQL + """
SELECT ts, line FROM parsed WHERE is_error AND ts IS NOT NULL AND ts > TIMESTAMP '2024-01-28 00:00:00'
""")
def recent_errors(spark, sf):
    return M.recent_errors(parsed_log(spark, sf), LOG_AS_OF, hours=72)


@register("error_classes", LOG_SQL + """
SELECT CASE WHEN regexp_matches(line, 'データベース接続|MySQL Connection|Lost connection', 'i') THEN 'database'
            WHEN regexp_matches(line, 'APIError|API', 'i') THEN 'api' ELSE 'other' END AS error_class,
       count(*) AS n_errors
FROM parsed WHERE is_error GROUP BY 1
""")
def error_classes(spark, sf):
    return M.error_classes(parsed_log(spark, sf).where("is_error"))


@register("failed_jobs", LOG_SQL + """
SELECT DISTINCT trim(regexp_extract(line, '★失敗★[\\s　]+([^:]+):', 1)) AS job FROM parsed
WHERE is_error AND regexp_extract(line, '★失敗★[\\s　]+([^:]+):', 1) <> '' ORDER BY job
""")
def failed_jobs(spark, sf):
    return M.failed_jobs(parsed_log(spark, sf).where("is_error"))


@register("error_severity", LOG_SQL + """
SELECT bucket, n_errors, CASE WHEN n_errors = 0 THEN 'none' WHEN n_errors < 5 THEN 'low'
                              WHEN n_errors < 20 THEN 'medium' ELSE 'high' END AS severity
FROM (SELECT date_trunc('hour', ts) AS bucket, count(*) AS n_errors FROM parsed
      WHERE is_error AND ts IS NOT NULL GROUP BY 1)
""")
def error_severity(spark, sf):
    errors = parsed_log(spark, sf).where(F.col("is_error") & F.col("ts").isNotNull())
    return M.error_severity(errors, F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz"))


@register("latest_errors", LOG_SQL + """
SELECT ts, line, is_error FROM parsed WHERE is_error AND ts IS NOT NULL ORDER BY ts DESC, line DESC LIMIT 5
""")
def latest_errors(spark, sf):
    log = parsed_log(spark, sf)
    return M.latest_errors(log.where(F.col("is_error") & F.col("ts").isNotNull()), 5)


@register("output_record_counts", LOG_SQL + """
SELECT ts, CAST(coalesce(nullif(regexp_extract(line, '(\\d+) レコード処理完了', 1), ''),
                         nullif(regexp_extract(line, '(\\d+) レコード', 1), '')) AS BIGINT) AS records,
       nullif(regexp_extract(line, '処理完了: ([\\p{L}\\p{N}_]+)', 1), '') AS table_name
FROM parsed
WHERE regexp_extract(line, '(\\d+) レコード', 1) <> '' OR regexp_extract(line, '処理完了: ([\\p{L}\\p{N}_]+)', 1) <> ''
""")
def output_record_counts(spark, sf):
    return M.output_record_counts(parsed_log(spark, sf))


AGE_SQL = ("round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 3600000000.0, 4)")


@register("stale_datasets", f"""
SELECT user_id AS dataset, max(ts) AS last_modified, {AGE_SQL} AS age_hours
FROM events GROUP BY user_id HAVING {AGE_SQL} > 24
""")
def stale_datasets(spark, sf):
    out = M.stale_datasets(table(spark, sf, "events"), "user_id", "ts", LOG_AS_OF, hours=24)
    return out.withColumn("age_hours", F.round("age_hours", 4))


@register("freshness_band", f"""
SELECT user_id AS dataset, {AGE_SQL} AS age_hours,
       CASE WHEN {AGE_SQL} < 1 THEN 'データは最新です' WHEN {AGE_SQL} < 24 THEN 'データは比較的新しいです'
            ELSE 'データが古い可能性があります' END AS freshness
FROM events GROUP BY user_id
""")
def freshness_band(spark, sf):
    latest = M.last_update(table(spark, sf, "events"), "user_id", "ts")
    age = F.round(M.hours_between(F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), F.col("last_modified")), 4)
    return latest.select("dataset", age.alias("age_hours")).withColumn("freshness", M.freshness_band(F.col("age_hours")))


@register("stream_error_counts", """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS n_errors FROM events
WHERE event_type = 'error' GROUP BY 1
""")
def stream_error_counts(spark, sf):
    prepare(spark)
    schema = table(spark, sf, "events").schema
    root = scratch_path(spark, "error_stream")
    source, glob = stream_source(spark, f"{sf.rstrip('/')}/events.parquet")
    query = error_count_stream(spark, source, schema, f"{root}/out", f"{root}/checkpoint", glob=glob)
    query.awaitTermination()
    return read_error_counts(spark, f"{root}/out")


# ---------------------------------------------------------------------------
# Variants: deep pages, wildcards, login criterion, counted losses, log stream
# ---------------------------------------------------------------------------

@register("page_keyset_nulls", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id FROM events
ORDER BY CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END DESC NULLS LAST, event_id DESC
LIMIT 200 OFFSET (SELECT count(*) - 100 FROM events WHERE event_id % 3 <> 0)
""")
def page_keyset_nulls(spark, sf):
    # pages over a key with nulls, walked over the border between values and nulls
    key = F.when(F.col("event_id") % 3 != 0, F.col("user_id"))
    events = table(spark, sf, "events").select("event_id", key.alias("user_id"))
    keys = ["user_id", "event_id"]
    before = events.where("user_id is not null").orderBy("user_id", "event_id").limit(101).agg(
        F.max(F.struct(*keys)).alias("last")).first()["last"]
    first = S.page_after(events, keys, list(before), 100)
    last = first.collect()[-1]
    pages = first
    for _ in range(2):
        pages = pages.unionByName(S.page_after(events, keys, [last["user_id"], last["event_id"]], 50))
        last = pages.collect()[-1]
    return pages


@register("page_keyset", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 50 OFFSET 100")
def page_keyset(spark, sf):
    events = table(spark, sf, "events")
    keys = ["ts", "event_id"]
    last = S.page(events, keys, 2, 50).select(*keys).collect()[-1]   # the previous page's last row
    return S.page_after(events, keys, [last["ts"], last["event_id"]], 50)


@register("filter_like_wildcards", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%r_d%'")
def filter_like_wildcards(spark, sf):
    return _filtered(spark, sf, "part", [FilterSpec("p_name", "like", "r_d")], ["p_partkey", "p_name"])


@register("period_login_either", """
WITH users AS (SELECT o_custkey AS user_id, max(o_orderdate) AS updated_at, min(o_orderdate) AS last_login_at
               FROM orders GROUP BY o_custkey)
SELECT * FROM users
WHERE (updated_at >= TIMESTAMP '1998-06-01 00:00:00' AND updated_at < TIMESTAMP '1998-07-01 00:00:00')
   OR (last_login_at >= TIMESTAMP '1998-06-01 00:00:00' AND last_login_at < TIMESTAMP '1998-07-01 00:00:00')
""")
def period_login_either(spark, sf):
    users = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.max("o_orderdate").alias("updated_at"), F.min("o_orderdate").alias("last_login_at"))
    columns = criterion_columns("ログイン日時", is_users_query=True)
    return period_filter(users, "1998年6月1日～1998年6月30日～までの期間", columns, AS_OF_ORDERS)


@register("cast_lenient_losses", DIRTY_SQL + f"""
SELECT 'qty_txt' AS column,
       count_if(trim(qty_txt) NOT IN ('', 'nan', 'None') AND ({LENIENT_QTY}) IS NULL) AS lost FROM dirty
UNION ALL
SELECT 'price_txt', count_if(trim(price_txt) NOT IN ('', 'nan', 'None') AND {LENIENT_PRICE} IS NULL) FROM dirty
UNION ALL
SELECT 'ship_txt', count_if(trim(ship_txt) NOT IN ('', 'nan', 'None') AND {PARSED_SHIP} IS NULL) FROM dirty
""")
def cast_lenient_losses(spark, sf):
    return C.lenient_losses(dirty_lineitem(spark, sf), DIRTY_TYPES)


@register("log_stream_error_counts", LOG_SQL + """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS n_errors FROM parsed
WHERE is_error AND ts IS NOT NULL GROUP BY 1
""")
def log_stream_error_counts(spark, sf):
    from quarry.streaming.errors import log_error_stream
    prepare(spark)
    root = scratch_path(spark, "log_stream")
    log_lines(table(spark, sf, "events")).write.text(f"{root}/logs")
    query = log_error_stream(spark, f"{root}/logs", f"{root}/out", f"{root}/checkpoint")
    query.awaitTermination()
    return read_error_counts(spark, f"{root}/out")


@register("filter_json_number", r"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 2 = 1 THEN regexp_replace(props, '(\d+)', '"\1"') ELSE props END AS props
           FROM events)
SELECT event_id, props FROM e
WHERE json_type(props, '$.k') = 'VARCHAR' AND json_extract_string(props, '$.k') = '9'
""")
def filter_json_number(spark, sf):
    # {"k": 9} in even rows, {"k": "9"} in odd ones: the quoted candidate "9" never
    # matches the number 9 (a text extraction would say it does)
    quoted = F.when(F.col("event_id") % 2 == 1, F.regexp_replace("props", r"(\d+)", '"$1"')).otherwise(F.col("props"))
    df = table(spark, sf, "events").select("event_id", quoted.alias("props"))
    return FL.apply_filters(df, [FilterSpec("props", "json_path", "9", path="$.k")])


def labeled_documents(spark, sf):
    """Documents with their labels; unlabelled documents get null labels."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


@register("validate_labels", """
WITH j AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
     s AS (SELECT count(*) AS n, count(*) - count(quality) AS nq, count(*) - count(toxic) AS nt FROM j)
SELECT 'required_columns' AS rule, 'quality' AS column, 'present' AS expected, 'present' AS actual, true AS passed FROM s
UNION ALL SELECT 'no_null_columns', 'doc_id', '0', '0', true FROM s
UNION ALL SELECT 'no_null_columns', 'quality', '0', CAST(nq AS VARCHAR), nq = 0 FROM s
UNION ALL SELECT 'no_null_columns', 'toxic', '0', CAST(nt AS VARCHAR), nt = 0 FROM s
UNION ALL SELECT 'column_types', 'quality', 'int', 'int', true FROM s
""")
def validate_labels(spark, sf):
    rules = {"required_columns": ["quality"], "no_null_columns": ["doc_id", "quality", "toxic"],
             "column_types": {"quality": "int"}}
    return Q.validate_rules(labeled_documents(spark, sf), rules)


@register("column_profile_labels", """
WITH j AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS column, 'bigint' AS dtype, count(doc_id) AS non_null, count(*) - count(doc_id) AS nulls FROM j
UNION ALL SELECT 'lang', 'string', count(lang), count(*) - count(lang) FROM j
UNION ALL SELECT 'n_chars', 'bigint', count(n_chars), count(*) - count(n_chars) FROM j
UNION ALL SELECT 'quality', 'int', count(quality), count(*) - count(quality) FROM j
UNION ALL SELECT 'toxic', 'int', count(toxic), count(*) - count(toxic) FROM j
""")
def column_profile_labels(spark, sf):
    return Q.column_profile(labeled_documents(spark, sf))


from quarry.plans import registry_storage  # noqa: E402, F401 - its queries are registered here
