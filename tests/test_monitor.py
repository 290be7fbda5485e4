import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import monitor as M


def log(spark, lines):
    return M.parse_log(spark.createDataFrame([(x,) for x in lines], "value string"))


LINES = [
    "2024-01-01 10:00:00 - ERROR - ★失敗★　users.sql: MySQL Connection lost",
    "2024-01-01 10:30:00 - ERROR - ★失敗★ apps.sql: APIError quota",
    "2024-01-01 11:00:00 - INFO - 処理完了: users 120 レコード処理完了",
    "2024-01-01 11:30:00 - WARNING - 取込 30 レコード",
    "bad line with ERROR",
    "2024-01-01 09:00:00 - エラー: unexpected",
]


def test_recent_and_classes(spark):
    parsed = log(spark, LINES)
    recent = M.recent_errors(parsed, dt.datetime(2024, 1, 1, 11, 0), hours=1)
    assert recent.count() == 1                     # the 10:30 line; 10:00 is not newer than the cutoff
    classes = {r[0]: r[1] for r in M.error_classes(parsed.where("is_error")).collect()}
    assert classes == {"database": 1, "api": 1, "other": 2}
    jobs = [r[0] for r in M.failed_jobs(parsed.where("is_error")).collect()]
    assert jobs == ["apps.sql", "users.sql"]      # the U+3000 blank is matched too


def test_counts_and_bands(spark):
    parsed = log(spark, LINES)
    rec = {r["records"]: r["table_name"] for r in M.output_record_counts(parsed).collect()}
    assert rec == {120: "users", 30: None}
    sev = spark.createDataFrame([(0,), (4,), (19,), (20,)], "n long").select(M.severity(F.col("n"))).collect()
    assert [r[0] for r in sev] == ["none", "low", "medium", "high"]
    bands = spark.createDataFrame([(0.5,), (5.0,), (30.0,)], "h double").select(M.freshness_band(F.col("h"))).collect()
    assert [r[0] for r in bands] == [M.FRESH_TEXT, M.FAIRLY_FRESH_TEXT, M.OLD_TEXT]
    latest = M.latest_errors(parsed.where("is_error AND ts IS NOT NULL"), 2).collect()
    assert [r["ts"].hour for r in latest] == [10, 10]


def test_stale_and_files(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 2, 12))],
                               "name string, ts timestamp_ntz")
    stale = M.stale_datasets(df, "name", "ts", dt.datetime(2024, 1, 3), hours=24).collect()
    assert [(r["dataset"], r["age_hours"]) for r in stale] == [("a", 48.0)]
    fresh = M.file_freshness(spark.read.parquet("/root/testdata/sf0.001/region.parquet"),
                             dt.datetime.now() + dt.timedelta(days=1)).first()
    assert fresh["age_hours"] > 0


def test_first_errors(spark):
    parsed = log(spark, LINES).where("is_error AND ts IS NOT NULL")
    assert [r["ts"].hour for r in M.first_errors(parsed, 2).collect()] == [9, 10]


def test_case_and_unicode_rules(spark):
    parsed = log(spark, ["2024-01-01 10:00:00 - ERROR - lost CONNECTION to mysql connection",
                         "2024-01-01 10:00:01 - ERROR - api quota",
                         "2024-01-01 11:00:00 - INFO - 処理完了: 顧客_2024 12 レコード処理完了"])
    classes = {r[0]: r[1] for r in M.error_classes(parsed.where("is_error")).collect()}
    assert classes == {"database": 1, "api": 1}
    assert [r["table_name"] for r in M.output_record_counts(parsed).collect()] == ["顧客_2024"]


def test_stale_files(spark):
    import os
    import time

    from quarry.session import scratch_path
    folder = scratch_path(spark, "datasets")
    spark.range(3).write.parquet(f"{folder}/fresh.parquet")
    spark.range(3).write.parquet(f"{folder}/old.parquet")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    two_days_ago = time.time() - 48 * 3600
    for root, _, files in os.walk(f"{local}/old.parquet"):
        for name in files:
            os.utime(os.path.join(root, name), (two_days_ago, two_days_ago))
    stale = M.stale_files(spark, folder, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), hours=24).collect()
    assert [r["dataset"] for r in stale] == ["old.parquet"] and 47 < stale[0]["age_hours"] < 49


def test_stale_files_over_mixed_datasets(spark):
    import os
    from quarry.session import scratch_path
    folder = scratch_path(spark, "datasets")
    spark.range(5).write.parquet(f"{folder}/plain.parquet")
    spark.range(6).selectExpr("id", "id % 2 as p").write.partitionBy("p").parquet(f"{folder}/split.parquet")
    spark.range(3).toPandas().to_parquet(f"{folder.removeprefix('file:')}/single.parquet")
    root = folder.removeprefix("file://").removeprefix("file:")
    for base, _, names in os.walk(root):
        for name in names:
            if "single" not in name:
                os.utime(os.path.join(base, name), (1_700_000_000, 1_700_000_000))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = M.stale_files(spark, folder, now, hours=24)
    assert sorted(r.dataset for r in out.collect()) == ["plain.parquet", "split.parquet"]
    assert M.stale_files(spark, folder, now + dt.timedelta(days=3), hours=24).count() == 3
