import datetime as dt

from pyspark.sql import functions as F

from quarry.plans import jobs as J
from quarry.plans.registry import MANIFEST, dataset_specs
from quarry.session import scratch_path
from quarry.spec import JobSpec

SF = "/root/testdata/sf0.001"


def test_select_jobs(spark):
    m = spark.createDataFrame([("a", "TRUE", ""), ("b", "true", "月初"), ("c", "1", ""), ("d", "YES", ""),
                               ("e", "FALSE", ""), ("f", None, "")], "sql_name string, enabled string, frequency string")
    mid = [r[0] for r in J.select_jobs(m, dt.date(2024, 1, 15)).collect()]
    first = [r[0] for r in J.select_jobs(m, dt.date(2024, 2, 1)).collect()]
    assert sorted(mid) == ["a", "c", "d"] and sorted(first) == ["a", "b", "c", "d"]


def test_file_names():
    now = dt.datetime(2024, 3, 4, 5, 6, 7)
    assert J.job_file_name("yyyyMMdd_{filename}", "users.csv", now) == "20240304_users"
    assert J.job_file_name("{filename}_yyyy-MM-dd", "users", now) == "users_2024-03-04"
    assert J.job_file_name("{filename}yyyy-MM-dd", "users", now) == "users2024-03-04"
    assert J.job_file_name("{filename}_yyyyMMddhhmmss", "users", now) == "users_20240304050607"
    assert J.job_file_name("{filename}_yyyy-MM", "users", now) == "users_2024-03"
    assert J.job_file_name("plain", "users", now, ".csv") == "plain.csv"
    assert J.job_file_name("yyyyMMdd_{filename}", "test1.csv", now, ".csv") == "20240304_test1.csv"
    assert J.job_file_name("", "test1.csv", now, ".csv") == "test1.csv"


def test_test_target():
    csv = J.test_target(JobSpec("q", "o", save_path="out", target="CSV", test=True))
    sheet = J.test_target(JobSpec("q", "o", target="スプシ", sheet_name="s", test=True))
    assert csv.save_path == "out/test" and sheet.sheet_name == "s_test"


def test_validate_jobs(spark):
    m = spark.createDataFrame([("a", "o", "CSV", ""), ("", "o", "スプシ", ""), ("c", "", "fax", "")],
                              "sql_name string, output_name string, target string, sheet_name string")
    problems = sorted((r[0], r[1]) for r in J.validate_jobs(m).collect())
    assert problems == [("", "missing sheet name"), ("", "missing sql name"), ("c", "missing output name"),
                        ("c", "unknown target")]
    assert J.validate_run_settings(0, -1, 0) != []


def test_manifest_isolates_failures(spark):
    root = scratch_path(spark, "jobs")
    audit = J.run_manifest(spark, MANIFEST, dataset_specs(SF), dt.date(1998, 6, 15), f"{root}/out",
                           f"{root}/audit", run_id="r1")
    results = {r["display_name"]: r for r in audit.collect()}
    assert results["broken"]["result"] == "失敗" and "unknown period" in results["broken"]["error"]
    assert results["formula"]["result"] == "失敗" and "paste mode" in results["formula"]["error"]
    assert all(r["result"] == "成功" for k, r in results.items() if k not in ("broken", "formula"))
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert results["customers"]["row_count"] == spark.read.parquet(f"{SF}/customer.parquet").count()
    assert results["orders_live"]["row_count"] == orders.where(F.col("o_orderstatus") != "F").count()
    summary = J.job_summary(audit).first()
    assert (summary["total_jobs"], summary["succeeded"], summary["failed"]) == (7, 5, 2)


def test_run_one_by_table_or_synonym(spark):
    root = scratch_path(spark, "jobs")
    out = J.run_one(spark, MANIFEST, dataset_specs(SF), "customer_list", dt.date(1998, 6, 15), f"{root}/o",
                    f"{root}/a", run_id="r2", synonyms={"customer_list": "customers"})
    assert [r["display_name"] for r in out.collect()] == ["customers"]


def test_run_log_feeds_the_monitors(spark):
    from quarry.operators import monitor as M
    root = scratch_path(spark, "jobs")
    J.run_manifest(spark, MANIFEST, dataset_specs(SF), dt.date(1998, 6, 15), f"{root}/out", f"{root}/audit",
                   run_id="r3", now=dt.datetime(2024, 1, 1, 12, 0, 0))
    log = M.parse_log(spark.read.text(J.run_log_dir(f"{root}/out")))
    assert log.count() == 7
    assert [r[0] for r in M.failed_jobs(log.where("is_error")).collect()] == ["customer_master", "orders_by_date"]
    ok_lines = [r["line"] for r in log.where(F.col("line").contains("★成功★")).collect()]
    assert any("-> customers.parquet" in x for x in ok_lines)


def test_jobs_from_manifest(spark):
    import pytest
    rows = [("orders_by_date", "o1", "前日", "登録日時", "parquet", "TRUE", "", "true"),
            ("customer_master", "c1", "", "", "CSV", "false", "", "FALSE"),
            ("orders_live", "l1", "", "", "parquet", "1", "月初", "")]
    m = spark.createDataFrame(rows, "`sqlファイル名` string, `出力ファイル名` string, `期間` string, `期間基準` string, "
                                    "`出力先` string, `実行対象` string, `実行頻度` string, `削除除外` string")
    mapping = {"sql_name": "sqlファイル名", "output_name": "出力ファイル名", "period": "期間", "criterion": "期間基準",
               "target": "出力先", "enabled": "実行対象", "frequency": "実行頻度", "exclude_deleted": "削除除外"}
    jobs = J.jobs_from_manifest(m, dt.date(1998, 6, 15), mapping)
    assert [(j.sql_name, j.exclude_deleted) for j in jobs] == [("orders_by_date", True)]
    assert len(J.jobs_from_manifest(m, dt.date(1998, 6, 1), mapping)) == 2      # month-start job on day 1
    broken = m.withColumn("出力先", F.lit("fax"))
    with pytest.raises(ValueError):
        J.jobs_from_manifest(broken, dt.date(1998, 6, 15), mapping)


def test_two_row_manifest(spark):
    """A CSV job with a dated name, and a sheet job with a paste mode that no table sink has."""
    root = scratch_path(spark, "jobs")
    jobs = [JobSpec("customer_master", "test1.csv", target="CSV", filename_format="yyyyMMdd_{filename}", display_name="one"),
            JobSpec("customer_master", "test2", target="スプシ", paste_mode="数式", sheet_name="sheet", display_name="two")]
    # the sheet's table exists: a refused mode must leave it alone
    spark.range(6).write.parquet(f"{root}/out/sheet")
    out = J.run_manifest(spark, jobs, dataset_specs(SF), dt.date(2024, 2, 1), f"{root}/out", f"{root}/audit", "r",
                         now=dt.datetime(2024, 2, 1))
    results = {r.display_name: r.result for r in out.collect()}
    assert results == {"one": "成功", "two": "失敗"}
    assert spark.read.parquet(f"{root}/out/sheet").count() == 6
    raw = b"".join(spark.read.format("binaryFile").load(f"{root}/out/20240201_test1.csv/*.csv").select("content").first())
    raw.decode("cp932")


def test_jobs_with_one_output_are_refused(spark):
    import pytest
    jobs = [JobSpec("customer_master", "same"), JobSpec("orders_live", "same")]
    with pytest.raises(ValueError, match="two jobs write"):
        J.run_manifest(spark, jobs, dataset_specs(SF), dt.date(2024, 2, 1), "/nowhere/out", "/nowhere/audit", "r")


def test_missing_soft_delete_column_fails_the_job(spark):
    root = scratch_path(spark, "jobs")
    job = JobSpec("customer_master", "c", exclude_deleted=True, display_name="c")
    row = J.run_manifest(spark, [job], dataset_specs(SF), dt.date(2024, 2, 1), f"{root}/o", f"{root}/a", "r").first()
    assert row.result == "失敗" and "soft-delete" in row.error


def test_retries_repeat_reads_but_never_appends(spark):
    from quarry.spec import DatasetSpec
    calls = []

    def flaky(s):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("source away")
        return s.range(4)

    specs = {"q": DatasetSpec("q", flaky)}
    root = scratch_path(spark, "jobs")
    run = lambda job, n: J.run_manifest(spark, [job], specs, dt.date(2024, 2, 1), f"{root}/o", f"{root}/a", f"r{n}",
                                        retries=2).first()
    assert run(JobSpec("q", "q"), 1).row_count == 4 and len(calls) == 3
    calls.clear()
    assert run(JobSpec("q", "q", target="スプシ", paste_mode="最終行積立て", sheet_name="s"), 2).result == "失敗" and len(calls) == 1


def test_durations(spark):
    rows = [("成功", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 50)),
            ("失敗", dt.datetime(2024, 1, 1, 0, 0, 10), dt.datetime(2024, 1, 1, 0, 0, 20))]
    audit = spark.createDataFrame(rows, "result string, started_at timestamp_ntz, logged_at timestamp_ntz")
    assert J.job_summary(audit).first().duration_s == 50


def test_modes_choose_table_and_flag(spark):
    import pytest
    schema = "sql_name string, output_name string, target string, `実行対象` string, `テスト実行` string"
    main = spark.createDataFrame([("a", "a", "CSV", "TRUE", ""), ("b", "b", "CSV", "", "TRUE")], schema)
    raw = spark.createDataFrame([("c", "c", "parquet", "", "1")], schema)
    names = lambda mode: [j.sql_name for j in J.jobs_for_mode(mode, main, raw, dt.date(2024, 1, 2))]
    assert (names("production"), names("test"), names("raw")) == (["a"], ["b"], ["c"])
    with pytest.raises(ValueError):
        names("other")


def slow_frame(spark, ms=500):
    wait = F.expr(f"java_method('java.lang.Thread', 'sleep', {ms}L) is null or id >= 0")
    return spark.range(0, 2000, 1, 4).where(wait)


def test_a_slow_job_ends_at_its_deadline_and_the_next_one_runs(spark):
    import time
    from quarry.spec import DatasetSpec
    specs = {"slow": DatasetSpec("slow", slow_frame), "quick": DatasetSpec("quick", lambda s: s.range(3))}
    for target, more in (("parquet", {}), ("CSV", {}), ("スプシ", {"paste_mode": "全張替え", "sheet_name": "sheet"})):
        root = scratch_path(spark, "jobs")
        jobs = [JobSpec("slow", "slow", target=target, display_name="slow", timeout_s="1.5", **more),
                JobSpec("quick", "quick", display_name="quick")]
        began = time.time()
        out = J.run_manifest(spark, jobs, specs, dt.date(2024, 2, 1), f"{root}/o", f"{root}/a", "r", retries=3, timeout_s=300)
        rows = {r.display_name: r for r in out.collect()}
        assert time.time() - began < 60
        assert rows["slow"].result == "失敗" and rows["slow"].error == "JobTimeout: not done after 1.5 seconds"
        assert rows["quick"].result == "成功" and rows["quick"].row_count == 3
        names = [p for p in __import__("os").listdir(f"{root}/o".removeprefix("file:")) if not p.startswith((".", "_"))]
        assert names == ["quick.parquet"] or all("staging" in n or n == "quick.parquet" for n in names)


def test_deadlines_of_jobs_that_run_at_once(spark):
    from quarry.spec import DatasetSpec
    specs = {"slow": DatasetSpec("slow", slow_frame), "quick": DatasetSpec("quick", lambda s: s.range(3))}
    root = scratch_path(spark, "jobs")
    # the quick job waits for the slow ones' task slots
    jobs = [JobSpec("slow", f"slow{i}", display_name=f"slow{i}") for i in range(2)] + [JobSpec("quick", "quick", display_name="quick", timeout_s="100")]
    out = J.run_manifest(spark, jobs, specs, dt.date(2024, 2, 1), f"{root}/o", f"{root}/a", "r", parallelism=3, timeout_s=2)
    assert {r.display_name: r.result for r in out.collect()} == {"slow0": "失敗", "slow1": "失敗", "quick": "成功"}
    assert spark.range(5).count() == 5  # the session goes on


def test_a_run_is_stopped(spark):
    import threading
    from quarry.spec import DatasetSpec
    stop = threading.Event()
    specs = {"slow": DatasetSpec("slow", slow_frame), "quick": DatasetSpec("quick", lambda s: s.range(3))}
    root = scratch_path(spark, "jobs")
    threading.Timer(1.5, stop.set).start()
    out = J.run_manifest(spark, [JobSpec("slow", "slow"), JobSpec("quick", "quick")], specs, dt.date(2024, 2, 1), f"{root}/o",
                         f"{root}/a", "r", stop=stop)
    assert {r.error for r in out.collect()} == {"JobStopped: the run was stopped"}


def test_timeouts_are_checked(spark):
    import pytest
    specs = dataset_specs(SF)
    run = lambda job, **kw: J.run_manifest(spark, [job], specs, dt.date(2024, 2, 1), "/nowhere/o", "/nowhere/a", "r", **kw)
    for bad in ("0", "0.5", "soon", "nan"):
        with pytest.raises(ValueError, match="timeout"):
            run(JobSpec("customer_master", "c", timeout_s=bad))
    with pytest.raises(ValueError, match="timeout"):
        run(JobSpec("customer_master", "c"), timeout_s=0)
    m = spark.createDataFrame([("a", "o", "CSV", "", "30"), ("b", "o", "CSV", "", "0"), ("c", "o", "CSV", "", "x"), ("d", "o", "CSV", "", None)],
                              "sql_name string, output_name string, target string, sheet_name string, timeout_s string")
    assert sorted(tuple(r) for r in J.validate_jobs(m).collect()) == [("b", J.SHORT_TIMEOUT), ("c", J.SHORT_TIMEOUT)]


def test_an_append_beside_a_replace_is_refused(spark):
    import pytest
    sheet = {"target": "スプシ", "sheet_name": "t"}
    append, replace = {"paste_mode": "最終行積立て", **sheet}, {"paste_mode": "全張替え", **sheet}
    for first, second in ((append, replace), (replace, append), (replace, replace)):
        jobs = [JobSpec("customer_master", "a", **first), JobSpec("orders_live", "b", **second)]
        with pytest.raises(ValueError, match="two jobs write"):
            J.run_manifest(spark, jobs, dataset_specs(SF), dt.date(2024, 2, 1), "/nowhere/o", "/nowhere/a", "r")


def test_appends_share_a_table(spark):
    from quarry.spec import DatasetSpec
    specs = {"q": DatasetSpec("q", lambda s: s.range(5))}
    root = scratch_path(spark, "jobs")
    jobs = [JobSpec("q", "q", target="スプシ", paste_mode="最終行積立て", sheet_name="t")] * 3
    out = J.run_manifest(spark, jobs, specs, dt.date(2024, 2, 1), f"{root}/o", f"{root}/a", "r", parallelism=3)
    assert [r.result for r in out.collect()] == ["成功"] * 3
    assert spark.read.parquet(f"{root}/o/t").count() == 15


def test_committed_runs_may_be_run_again(spark):
    """An append that fails half-way is retried; the whole run, run again under
    its id, changes nothing; under another id it appends again."""
    from quarry.sinks.versions import read_dataset
    from quarry.spec import DatasetSpec
    calls = []

    def flaky(s):
        calls.append(1)
        bad = F.when((F.col("id") == 39) & F.lit(len(calls) == 1), F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id"))
        return s.range(0, 40, 1, 4).select(bad.alias("id"))

    specs = {"q": DatasetSpec("q", flaky), "p": DatasetSpec("p", lambda s: s.range(7))}
    root = scratch_path(spark, "jobs")
    jobs = [JobSpec("q", "q", target="スプシ", paste_mode="最終行積立て", sheet_name="t", display_name="q"),
            JobSpec("p", "p", display_name="p"), JobSpec("p", "s", target="スプシ", paste_mode="全張替え", sheet_name="s", display_name="s")]
    run = lambda run_id: {r.display_name: (r.result, r.row_count) for r in J.run_manifest(
        spark, jobs, specs, dt.date(2024, 2, 1), f"{root}/o", f"{root}/a", run_id, retries=1, committed=True).collect()}
    want = {"q": ("成功", 40), "p": ("成功", 7), "s": ("成功", 7)}
    assert run("r1") == want and len(calls) == 2
    assert run("r1") == want and read_dataset(spark, f"{root}/o/t").count() == 40
    assert run("r2") == want and read_dataset(spark, f"{root}/o/t").count() == 80
    assert read_dataset(spark, f"{root}/o/p.parquet").count() == 7 and read_dataset(spark, f"{root}/o/s").count() == 7
