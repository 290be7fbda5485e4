import datetime as dt
import os
import time

from pyspark.sql import functions as F

from quarry.plans import refresh as R
from quarry.session import scratch_path
from quarry.sinks.versions import read_version
from quarry.spec import DatasetSpec, JobSpec


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def setup(spark, names="abc"):
    root = scratch_path(spark, "refresh")
    for n in names:
        spark.range(4).repartition(2).write.parquet(f"{root}/in/{n}")
    calls = []

    def base(n):
        def read(s):
            calls.append(n)
            if os.path.exists(f"{local(root)}/broken-{n}"):
                raise OSError("source away")
            return s.read.parquet(f"{root}/in/{n}")
        return read

    specs = {n: DatasetSpec(n, base(n)) for n in names}
    jobs = [JobSpec(n, n, display_name=f"job {n}") for n in names]
    run_ids = iter(range(100))
    run = lambda: sorted(r.display_name for r in R.refresh(
        spark, jobs, specs, {n: [f"{root}/in/{n}"] for n in names}, f"{root}/listing", dt.date(2024, 1, 1), f"{root}/out",
        f"{root}/audit", run_id=f"r{next(run_ids)}").collect())
    return root, run, calls


def test_only_the_touched_source_runs(spark):
    root, run, calls = setup(spark)
    assert run() == ["job a", "job b", "job c"] and sorted(calls) == ["a", "b", "c"]
    assert run() == [] and len(calls) == 3
    spark.range(2).write.mode("append").parquet(f"{root}/in/b")       # a new file
    assert run() == ["job b"] and calls[3:] == ["b"]
    part = next(f for f in os.listdir(f"{local(root)}/in/c") if f.endswith(".parquet"))
    os.utime(f"{local(root)}/in/c/{part}", (time.time() + 50,) * 2)   # a rewritten one
    assert run() == ["job c"]
    os.remove(f"{local(root)}/in/a/" + next(f for f in os.listdir(f"{local(root)}/in/a") if f.endswith(".parquet")))
    assert run() == ["job a"] and run() == []                         # one that is gone


def test_a_failed_job_runs_again(spark):
    root, run, calls = setup(spark, "ab")
    open(f"{local(root)}/broken-b", "w").close()
    assert run() == ["job a", "job b"]
    assert {r.source for r in read_version(spark, f"{root}/listing").collect()} == {"a"}
    os.remove(f"{local(root)}/broken-b")
    assert run() == ["job b"] and run() == []


def test_kinds_of_change(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    before = spark.createDataFrame([("s", "1", t(1), 5), ("s", "2", t(1), 5), ("s", "3", t(1), 5)], R.LISTING)
    now = spark.createDataFrame([("s", "1", t(1), 5), ("s", "2", t(2), 5), ("s", "4", t(1), 5), ("z", "1", t(1), 5)], R.LISTING)
    got = sorted(map(tuple, R.changed_files(before, now).collect()))
    assert got == [("s", "2", "changed"), ("s", "3", "gone"), ("s", "4", "new"), ("z", "1", "new")]
    assert R.changed_files(now, now.where(F.lit(True))).isEmpty()
