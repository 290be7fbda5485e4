from quarry.plans.registry import QUERIES, table
from quarry.streaming.errors import hourly_error_counts

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_twin(spark):
    streamed = {r["window_start"]: r["n_errors"] for r in QUERIES["stream_error_counts"](spark, SF).collect()}
    batch = {r["window_start"]: r["n_errors"] for r in hourly_error_counts(table(spark, SF, "events")).collect()}
    assert streamed == batch and len(batch) > 0


def test_log_stream_counts_error_lines(spark):
    from pyspark.sql import functions as F

    from quarry.operators.monitor import parse_log
    from quarry.plans.registry import log_lines
    from quarry.session import scratch_path
    from quarry.streaming.errors import log_error_stream, read_error_counts

    lines = log_lines(table(spark, SF, "events"))
    log_dir = scratch_path(spark, "logs")
    lines.coalesce(2).write.text(log_dir)
    root = scratch_path(spark, "log_stream")
    log_error_stream(spark, log_dir, f"{root}/out", f"{root}/ckpt").awaitTermination()
    streamed = {r["window_start"]: r["n_errors"] for r in read_error_counts(spark, f"{root}/out").collect()}
    parsed = parse_log(spark.read.text(log_dir)).where("is_error AND ts IS NOT NULL")
    batch = {r[0]: r[1] for r in parsed.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz")).count().collect()}
    assert streamed == batch and len(batch) > 0


def test_restart_from_checkpoint_and_late_data(spark):
    import datetime as dt

    from quarry.session import scratch_path
    from quarry.streaming.errors import error_count_stream, read_error_counts

    schema = "event_id long, ts timestamp_ntz, event_type string"
    src, root = scratch_path(spark, "src"), scratch_path(spark, "late")
    h = lambda hour, minute=0: dt.datetime(2024, 1, 1, hour, minute)
    first = [(1, h(0, 5), "error"), (2, h(0, 50), "error"), (3, h(5), "error"), (4, h(10), "view"),
             (5, h(10, 30), "error")]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{src}/part=1")

    def run():
        error_count_stream(spark, src, spark.createDataFrame([], schema).schema, f"{root}/out",
                           f"{root}/ckpt").awaitTermination()
        return {r["window_start"].hour: r["n_errors"] for r in read_error_counts(spark, f"{root}/out").collect()}

    assert run() == {0: 2, 5: 1, 10: 1}
    # a new file after a restart: one on-time error, one older than the watermark (10:30 - 2 h)
    late = [(6, h(11), "error"), (7, h(0, 10), "error"), (8, h(10, 40), "error")]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{src}/part=2")
    assert run() == {0: 2, 5: 1, 10: 2, 11: 1}


def test_a_file_delivered_twice_counts_once_and_late_lines_are_told(spark):
    from quarry.operators.monitor import parse_log
    from quarry.session import scratch_path
    from quarry.streaming.errors import late_rows, log_error_stream, read_error_counts

    log_dir, root = scratch_path(spark, "logs"), scratch_path(spark, "once")
    deliver = lambda lines: spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(log_dir)

    def run():
        query = log_error_stream(spark, log_dir, f"{root}/out", f"{root}/ckpt", once=True)
        query.awaitTermination()
        return late_rows(query)

    first = [f"2024-01-01 {h:02d}:{m:02d}:00 - ERROR - q{m}" for h in (8, 9, 10) for m in (1, 2, 30)]
    deliver(first)
    deliver(first)
    assert run() == 0
    deliver(first[3:])  # once more, in a later batch (09:01 and later lie within the watermark, 10:30 - 2 h)
    late = [f"2024-01-01 {h:02d}:05:00 - ERROR - late {i}" for h in (1, 2) for i in range(3)]
    deliver(["2024-01-01 10:45:00 - ERROR - new", "2024-01-01 08:59:00 - ERROR - in time", "no time ERROR", *late])
    dropped = run()
    counted = {r["window_start"].hour: r["n_errors"] for r in read_error_counts(spark, f"{root}/out").collect()}
    assert counted == {8: 4, 9: 3, 10: 4} and dropped == len(late)
    batch = parse_log(spark.read.text(log_dir)).where("is_error AND ts IS NOT NULL").select("ts", "line").distinct().count()
    assert sum(counted.values()) + dropped == batch
