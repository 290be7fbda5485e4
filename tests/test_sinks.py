import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F


from quarry.session import scratch_path
from quarry.sinks import writers as W
from quarry.sources.files import CP932, scan_csv
from quarry.spec import FilterSpec


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_cp932_csv_replaces_unencodable(spark):
    df = spark.createDataFrame([(1, "日本語①", ""), (2, "emoji 😀", None)], "id long, s string, t string")
    path = W.export_csv(df, scratch_path(spark, "jp.csv"), encoding=CP932)
    files = glob.glob(os.path.join(local(path), "part-*.csv"))
    raw = b"".join(open(f, "rb").read() for f in files).decode("cp932")
    assert "日本語①" in raw and "emoji ?" in raw
    assert '""' not in raw                         # empty text and null both written as nothing
    back = scan_csv(spark, path, encoding=CP932, schema="id long, s string, t string")
    assert {r["id"]: r["s"] for r in back.collect()} == {1: "日本語①", 2: "emoji ?"}


def test_chunked_keeps_every_row(spark):
    df = spark.range(2500).withColumnRenamed("id", "k").coalesce(1)
    path = W.export_csv_chunked(df, scratch_path(spark, "chunks.csv"), chunk_rows=1000)
    files = glob.glob(os.path.join(local(path), "part-*.csv"))
    assert len(files) == 3
    assert scan_csv(spark, path, schema="k long").count() == 2500


def test_publish_replaces_and_leaves_no_staging(spark):
    target = scratch_path(spark, "table")
    W.export_parquet(spark.range(5), target)
    W.export_parquet(spark.range(3), target)
    assert spark.read.parquet(target).count() == 3
    parent = os.path.dirname(local(target))
    assert sorted(os.listdir(parent)) == ["table"]


def test_lenient_parquet_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "id long, n string")
    path = W.export_parquet(df, scratch_path(spark, "typed"), types={"n": "int"})
    out = {r["id"]: r["n"] for r in spark.read.parquet(path).collect()}
    assert out == {1: 5, 2: None, 3: None}


def test_newest_first_files(spark):
    path = W.export_parquet_newest(spark.range(100).withColumnRenamed("id", "k"),
                                   scratch_path(spark, "newest"), ["k"], partitions=4)
    files = sorted(glob.glob(os.path.join(local(path), "part-*.parquet")))
    import pyarrow.parquet as pq
    firsts = [pq.read_table(f).column("k")[0].as_py() for f in files]
    assert firsts == sorted(firsts, reverse=True) and firsts[0] == 99


def test_tables_and_modes(spark):
    path = scratch_path(spark, "t")
    W.append_table(spark.range(2), path)
    W.append_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 5
    W.replace_table(spark.range(4), path, W.PASTE_REPLACE)
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        W.replace_table(spark.range(1), path, "数式")


def test_observed_count_and_audit(spark):
    audit = scratch_path(spark, "audit")
    n = W.write_counted(spark.range(42), lambda d: d.write.format("noop").mode("overwrite").save())
    assert n == 42
    W.audit_append(spark, audit, "ds", "sheet", "main", "データ", "CSV", n, True,
                   logged_at=dt.datetime(2024, 1, 1, 1, 2, 3))
    W.audit_append(spark, audit, "ds2", "", "main", "", "CSV", None, False, error="boom")
    rows = {r["display_name"]: r for r in W.read_audit(spark, audit).collect()}
    assert rows["ds"]["row_count"] == 42 and rows["ds"]["result"] == "成功"
    assert rows["ds2"]["result"] == "失敗" and rows["ds2"]["error"] == "boom"


def test_view_export(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "id long, s string")
    folder = scratch_path(spark, "exports")
    path = W.export_view_csv(df, folder, [FilterSpec("s", "choice", "-")], now=dt.datetime(2024, 5, 6, 7, 8, 9))
    assert path.endswith("/2024-05-06-070809_export.csv")
    assert scan_csv(spark, path, encoding=CP932, schema="id string, s string").count() == 2


def test_publish_recovers_interrupted_swap(spark):
    target = scratch_path(spark, "swap")
    W.export_parquet(spark.range(5), target)
    aside = local(target) + ".old-crash"
    os.rename(local(target), aside)               # crash after moving the old version aside
    W.export_parquet(spark.range(2), target)      # next publish restores, then swaps
    assert spark.read.parquet(target).count() == 2
    assert not glob.glob(local(target) + ".old-*")


def test_utf8_bom(spark):
    df = spark.createDataFrame([(1, "日本"), (2, "x")], "id long, s string").repartition(2)
    path = W.export_csv(df, scratch_path(spark, "bom.csv"), bom=True)
    files = [f for f in glob.glob(os.path.join(local(path), "part-*.csv")) if os.path.getsize(f)]
    assert files and all(open(f, "rb").read().startswith(b"\xef\xbb\xbfid,s") for f in files)
    back = scan_csv(spark, path, schema="id long, s string")
    assert sorted(r["s"] for r in back.collect()) == ["x", "日本"]
    with pytest.raises(ValueError):
        W.export_csv(df, scratch_path(spark, "bad.csv"), encoding=CP932, bom=True)


@pytest.mark.parametrize("encoding", ["UTF-8", CP932])
def test_csv_keeps_every_character(spark, encoding):
    texts = ["  edge blanks  ", 'say "hi", ok', "back\\slash\\", "two\nlines", "a,b", '"', "'", "tab\there", "日本語", "\\\"mixed\"\n, x "]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, s string")
    path = W.export_csv(df, scratch_path(spark, "odd.csv"), encoding=encoding)
    back = scan_csv(spark, path, encoding=encoding, schema="id long, s string")
    assert {r.id: r.s for r in back.collect()} == dict(enumerate(texts))
    import csv
    import io
    rows = []
    for f in glob.glob(os.path.join(local(path), "part-*.csv")):
        raw = open(f, "rb").read().decode("cp932" if encoding == CP932 else "utf-8")
        rows += list(csv.reader(io.StringIO(raw, newline="")))[1:]
    assert {int(i): s for i, s in rows} == dict(enumerate(texts))  # as any other CSV reader sees it


def test_append_keeps_the_header(spark):
    path = scratch_path(spark, "log")
    W.append_table(spark.createDataFrame([(1, "a")], "id long, s string"), path)
    W.append_table(spark.createDataFrame([("b", 2)], "s string, id int"), path)
    assert sorted((r.id, r.s) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    for bad in ("id long", "id long, t string", "id long, s string, t string"):
        with pytest.raises(ValueError):
            W.append_table(spark.createDataFrame([], bad), path)


def test_newest_first_spreads_a_hot_key(spark):
    df = spark.range(4000).selectExpr("7 as k", "id as v")
    path = W.export_parquet_newest(df, scratch_path(spark, "hot"), ["k"], partitions=4)
    assert len(glob.glob(os.path.join(local(path), "part-*.parquet"))) == 4


def test_shared_folder_rules(spark):
    from types import SimpleNamespace
    from quarry import session as S
    conf = SimpleNamespace(get=lambda key, default: default)
    away = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(RuntimeError):
        S.shared_dir(away)


def test_scratch_is_cleared(spark):
    from quarry.session import clear_scratch
    path = scratch_path(spark, "left")
    W.export_parquet(spark.range(3), path)
    work = os.path.dirname(os.path.dirname(local(path)))
    assert os.listdir(work)
    clear_scratch(spark)
    assert not os.path.exists(work)


def test_skip_empty_export(spark):
    target = scratch_path(spark, "empty.csv")
    assert W.export_csv(spark.range(0), target, skip_empty=True) is None
    assert not os.path.exists(local(target)) and not glob.glob(local(target) + ".staging-*")
    assert W.export_csv(spark.range(2), target, skip_empty=True) == target


def test_newest_first_follows_shuffled_bytes_not_the_plan(spark):
    """A join whose estimated size is beyond any number of partitions."""
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    p = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    joined = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    path = W.export_parquet_newest(joined, scratch_path(spark, "joined"), ["o_orderkey", "l_linenumber"])
    files = glob.glob(os.path.join(local(path), "part-*.parquet"))
    assert 1 <= len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.read.parquet(path).count() == li.count()


def test_single_file_keeps_the_upstream_parallel(spark):
    df = spark.range(0, 1000, 1, 6).where(F.col("id") >= 0)
    path = W.export_csv(df, scratch_path(spark, "one.csv"), single_file=True)
    assert len(glob.glob(os.path.join(local(path), "part-*.csv"))) == 1
    assert scan_csv(spark, path, schema="id long").count() == 1000


@pytest.mark.parametrize("encoding", ["UTF-8", CP932])
def test_merged_csv_is_one_file_with_one_header(spark, encoding):
    texts = ["a,b", 'say "hi"', "two\nlines", "日本語", "", None]
    df = spark.createDataFrame([(i, texts[i % 6]) for i in range(300)], "`番号` long, s string").repartition(7)
    path = W.export_csv_merged(df, scratch_path(spark, "all.csv"), keys=["番号"], encoding=encoding)
    assert os.path.isfile(local(path)) and [n for n in os.listdir(os.path.dirname(local(path))) if not n.endswith(".crc")] == ["all.csv"]
    import csv
    import io
    rows = list(csv.reader(io.StringIO(open(local(path), "rb").read().decode("cp932" if encoding == CP932 else "utf-8"), newline="")))
    assert rows[0] == ["番号", "s"] and len(rows) == 301
    assert [(int(a), b) for a, b in rows[1:]] == [(i, texts[i % 6] or "") for i in reversed(range(300))]


def test_merged_csv_keeps_parallel_tasks(spark):
    df = spark.range(0, 4000, 1, 8)
    path = W.export_csv_merged(df, scratch_path(spark, "all.csv"), bom=True)
    raw = open(local(path), "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfid\n0\n1\n") and raw.count(b"\n") == 4001 and raw.count(b"id") == 1
    empty = W.export_csv_merged(spark.range(0), scratch_path(spark, "none.csv"))
    assert open(local(empty)).read() == "id\n"


def test_bloom_filters_skip_row_groups(spark):
    from tests.test_order_index import rows_read
    df = spark.range(0, 60_000, 2).select("id", F.sha1(F.col("id").cast("string")).alias("key"), (F.col("id") * 1_000_003 % 999_983).alias("n"))
    plain = W.export_parquet(df.coalesce(1), scratch_path(spark, "plain"))
    bloom = W.export_parquet(df.coalesce(1), scratch_path(spark, "bloom"), bloom_columns={"key": 40_000, "id": 40_000})
    known = df.where("id = 4242").first()
    missing = {"key": "8" * 40, "id": 4243}  # inside the bounds, not in the data
    for column in ("key", "id"):
        for value, n in ((known[column], 1), (missing[column], 0)):
            from quarry.functions.filters import apply_filters
            read = {}
            for name, path in (("plain", plain), ("bloom", bloom)):
                found = apply_filters(spark.read.parquet(path), [FilterSpec(column, "equals", value)])
                assert len(found.collect()) == n
                read[name] = rows_read(found)
            assert (read["bloom"] == 0) == (n == 0), (column, value, read)
    assert rows_read_of_missing(spark, plain, missing["key"]) > 0


def rows_read_of_missing(spark, path, key):
    from tests.test_order_index import rows_read
    found = spark.read.parquet(path).where(F.col("key") == key)
    assert found.collect() == []
    return rows_read(found)


def test_rejects_and_rows_add_up(spark):
    rows = [(1, "5", "2024-01-02"), (2, "x", "2024-01-02"), (3, None, "soon"), (4, "", None), (5, "y", "never"), (5, "y", "never")]
    df = spark.createDataFrame(rows, "id long, n string, d string")
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    assert W.export_parquet_checked(df, good, bad, {"n": "int", "d": "date", "absent": "int"}) == (2, 4)
    import datetime
    assert sorted(map(tuple, spark.read.parquet(good).collect())) == [(1, 5, datetime.date(2024, 1, 2)), (4, None, None)]
    out = spark.read.parquet(bad)
    assert out.columns == ["id", "n", "d", "problems"]
    got = sorted((r.id, r.n, r.d, tuple((p["column"], p["value"]) for p in r.problems)) for r in out.collect())
    assert got == [(2, "x", "2024-01-02", (("n", "x"),)), (3, None, "soon", (("d", "soon"),))] + \
        [(5, "y", "never", (("n", "y"), ("d", "never")))] * 2
    assert W.export_parquet_checked(df.limit(0), good, bad, {"n": "int"}) == (0, 0)
    with pytest.raises(ValueError):
        W.export_parquet_checked(df.withColumn("problems", F.lit(1)), good, bad, {})


def test_chunks_are_bounded(spark):
    df = spark.range(0, 5000, 1, 2)
    path = W.export_csv_chunked(df, scratch_path(spark, "c.csv"), chunk_rows=700)
    sizes = sorted(sum(1 for _ in open(f)) - 1 for f in glob.glob(os.path.join(local(path), "part-*.csv")))
    assert sum(sizes) == 5000 and max(sizes) == 700 and len(sizes) == 8


def test_csv_splits_unless_quoted_line_ends(spark):
    from quarry.sources import files as A
    plain = scratch_path(spark, "plain.csv")
    odd = scratch_path(spark, "odd.csv")
    big = "x" * 200
    spark.range(0, 20_000, 1, 1).select("id", F.lit(f'"{big}"').alias("s")).coalesce(1).write.option("header", True).option("escape", '"').csv(plain)
    spark.range(0, 20_000, 1, 1).select("id", F.when(F.col("id") == 777, "two\nlines").otherwise(big).alias("s")).coalesce(1) \
        .write.option("header", True).csv(odd)
    assert not A.has_quoted_line_ends(spark, plain) and A.has_quoted_line_ends(spark, odd)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    try:
        assert scan_csv(spark, plain, schema="id long, s string").rdd.getNumPartitions() > 4
        assert scan_csv(spark, odd, schema="id long, s string").rdd.getNumPartitions() == 1
        assert {r.s for r in scan_csv(spark, odd, schema="id long, s string").where("id = 777").collect()} == {"two\nlines"}
        assert scan_csv(spark, plain, schema="id long, s string").agg(F.sum("id")).first()[0] == 19_999 * 10_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
