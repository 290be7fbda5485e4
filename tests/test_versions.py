import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sinks import versions as V
from quarry.sinks import writers as W
from quarry.sinks.fs import create_if_absent, read_text
from quarry.sources.files import scan_parquet


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_one_of_many_creates_the_file(spark):
    path = scratch_path(spark, "pointer")
    made = []
    threads = [threading.Thread(target=lambda i=i: made.append((create_if_absent(spark, path, f"by {i}"), i))) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winner = [i for ok, i in made if ok]
    assert len(winner) == 1 and read_text(spark, path) == f"by {winner[0]}"
    assert os.listdir(os.path.dirname(local(path))) == ["pointer"]


def test_two_publishers_and_a_reader(spark):
    """Publishers meet again and again while a reader reads: no read fails or
    mixes versions, and of two publishers that began together one raises."""
    path = scratch_path(spark, "data")
    V.publish_version(spark.range(10).withColumn("v", F.lit(0)), path)
    stop, seen, errors, outcomes = threading.Event(), [], [], []

    def reader():
        while not stop.is_set():
            try:
                rows = V.read_version(spark, path).groupBy("v").count().collect()
                seen.append((len(rows), rows[0]["count"]))
            except Exception as exc:
                errors.append(exc)

    def publisher(v, base, gate):
        gate.wait()
        try:
            V.publish_version(spark.range(10).withColumn("v", F.lit(v)), path, expect=base)
            outcomes.append("won")
        except V.ConcurrentPublish:
            outcomes.append("lost")

    watching = threading.Thread(target=reader)
    watching.start()
    for turn in range(4):
        base, gate = V.latest_version(spark, path), threading.Barrier(2)
        pair = [threading.Thread(target=publisher, args=(2 * turn + k + 1, base, gate)) for k in range(2)]
        [t.start() for t in pair]
        [t.join() for t in pair]
    stop.set()
    watching.join()
    assert not errors and seen and set(seen) == {(1, 10)}
    assert sorted(outcomes) == ["lost"] * 4 + ["won"] * 4
    assert len(os.listdir(f"{local(path)}/_data")) == 5  # a loser's files are gone


def test_failed_write_leaves_the_version(spark):
    path = scratch_path(spark, "data")
    V.publish_version(spark.range(5), path)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        V.publish_version(broken.repartition(3), path)
    assert V.read_version(spark, path).count() == 5 and V.latest_version(spark, path) == 1


def test_append_killed_half_way_and_run_again(spark):
    path = scratch_path(spark, "log")
    rows = spark.range(0, 100, 1, 4)
    W.append_table(rows, path, txn="a")
    half = rows.select((F.col("id") + 100 + F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("long")).otherwise(0)).alias("id"))
    with pytest.raises(Exception, match="killed"):
        W.append_table(half, path, txn="b")
    assert V.read_version(spark, path).count() == 100  # what the killed attempt wrote is not read
    for _ in range(3):
        W.append_table(rows.select((F.col("id") + 100).alias("id")), path, txn="b")
    assert sorted(r.id for r in V.read_version(spark, path).collect()) == list(range(200))
    assert [r.txn for r in V.version_log(spark, path).orderBy("version").collect()] == ["a", "b"]


def test_same_append_twice_at_once(spark):
    path = scratch_path(spark, "log")
    gate = threading.Barrier(4)

    def run(txn):
        gate.wait()
        V.append_version(spark.range(10), path, txn=txn)

    threads = [threading.Thread(target=run, args=(t,)) for t in ("x", "x", "y", "y")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert V.read_version(spark, path).count() == 20


def test_replace_then_append_and_time_travel(spark):
    path = scratch_path(spark, "t")
    one = spark.createDataFrame([(1, "a", 5)], "id long, part string, n int")
    V.publish_version(one, path, partition_by=["part"])
    V.append_version(spark.createDataFrame([("b", 6, 2)], "part string, n int, id int"), path, partition_by=["part"])
    W.replace_table(spark.createDataFrame([(9, "c", 7)], "id long, part string, n int"), path)
    as_rows = lambda n=None: sorted(map(tuple, V.read_version(spark, path, n).collect()))
    assert as_rows(1) == [(1, "a", 5)] and as_rows(2) == [(1, "a", 5), (2, "b", 6)] and as_rows() == [(9, "c", 7)]
    assert V.read_version(spark, path).columns == ["id", "part", "n"]
    assert scan_parquet(spark, path).count() == 1
    with pytest.raises(ValueError):
        W.append_table(spark.range(1), path)
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, path, 4)


def test_empty_frames_and_odd_names(spark):
    path = scratch_path(spark, "t")
    V.publish_version(spark.createDataFrame([], "`a b` long, `日付` date"), path, partition_by=["日付"])
    assert V.read_version(spark, path).collect() == [] and V.read_version(spark, path).columns == ["a b", "日付"]


def test_partition_filter_prunes_files(spark):
    from tests.conftest import plan_text
    path = scratch_path(spark, "t")
    V.publish_version(spark.range(100).withColumn("p", F.col("id") % 5), path, partition_by=["p"])
    V.append_version(spark.range(100).withColumn("p", F.col("id") % 5), path, partition_by=["p"])
    found = V.read_version(spark, path).where("p = 3 and id > 50")
    assert found.count() == 20
    text = plan_text(found)
    assert "PartitionFilters: [isnotnull(p" in text and "GreaterThan(id,50)" in text


def test_prune(spark):
    path = scratch_path(spark, "t")
    for n in range(4):
        V.publish_version(spark.range(n + 1), path)
    V.append_version(spark.range(3), path, txn="x")
    os.makedirs(f"{local(path)}/_data/{V.COMMIT}=c-orphan")
    assert V.prune_versions(spark, path, keep=2, older_than_s=3600) == []  # all is young
    time.sleep(1.1)
    assert V.prune_versions(spark, path, keep=2, older_than_s=1) == [1, 2]
    assert V.read_version(spark, path).count() == 7 and V.read_version(spark, path, 3).count() == 3
    assert len(os.listdir(f"{local(path)}/_data")) == 3
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, path, 1)
    V.publish_version(spark.range(1), path)
    assert V.latest_version(spark, path) == 6


def test_plain_and_versioned_never_mix(spark):
    path = scratch_path(spark, "plain")
    W.export_parquet(spark.range(3), path)
    for write in (lambda: W.export_parquet(spark.range(1), path, versioned=True), lambda: W.append_table(spark.range(1), path, txn="x")):
        with pytest.raises(ValueError):
            write()
    assert spark.read.parquet(path).count() == 3


def test_other_readers_know_versions(spark):
    """Head, metrics, freshness and refreshes of a versioned dataset."""
    import datetime as dt

    from quarry.operators.monitor import stale_files
    from quarry.operators.quality import dataset_metrics, stored_bytes
    from quarry.plans.refresh import changed_files, file_listing
    from quarry.sources.files import scan_parquet_head
    folder = scratch_path(spark, "datasets")
    path, plain = f"{folder}/kept.parquet", f"{folder}/plain.parquet"
    V.publish_version(spark.range(50), path)
    W.export_parquet(spark.range(5), plain)
    before = file_listing(spark, {"kept": [path], "plain": [plain]}).cache()
    before.count()
    V.publish_version(spark.range(20), path)
    assert [r.id for r in scan_parquet_head(spark, path, ["id"], 2).collect()] == [19, 18]
    assert dataset_metrics(spark, path).first()["n_rows"] == 20
    assert 0 < stored_bytes(spark, path) < 2 * sum(f.stat().st_size for f in __import__("pathlib").Path(local(path)).rglob("*.parquet"))
    changes = {r.source for r in changed_files(before, file_listing(spark, {"kept": [path], "plain": [plain]})).collect()}
    assert changes == {"kept"}
    far = dt.datetime.now() + dt.timedelta(days=400)
    assert {r.dataset for r in stale_files(spark, folder, far).collect()} == {"kept.parquet", "plain.parquet"}
