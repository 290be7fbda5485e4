import pytest

from quarry.operators import paging as S

SF = "/root/testdata/sf0.001"


def test_pages_and_keyset(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    keys = ["ts", "event_id"]
    p1 = S.page(ev, keys, 1, 7).collect()
    p2 = S.page(ev, keys, 2, 7).collect()
    last = p1[-1]
    after = S.page_after(ev, keys, [last["ts"], last["event_id"]], 7).collect()
    assert [r["event_id"] for r in after] == [r["event_id"] for r in p2]
    assert S.page_prefetch(ev, keys, 1, 7).collect() == p2
    nums = [r["row_no"] for r in S.row_numbers(ev, keys, 2, 7).collect()]
    assert sorted(nums) == list(range(8, 15))


def test_summary(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    total = ev.count()
    row = S.page_summary(ev, 2, 30).first()
    assert row["total_rows"] == total and row["total_pages"] == -(-total // 30)
    assert row["first_row"] == 31 and row["last_row"] == min(60, total)


def test_refuses_without_key(spark):
    import pytest
    with pytest.raises(ValueError):
        S.page(spark.range(3), [], 1, 2)


def test_keyset_walks_over_nulls(spark):
    rows = [(i, None if i % 3 == 0 else i // 4) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, k long")
    keys = ["k", "id"]
    want = [tuple(r) for r in S.newest_first(df, keys).select(*keys).collect()]
    got = [tuple(r) for r in S.page(df, keys, 1, 7).select(*keys).collect()]
    while len(got) < len(want):
        step = S.page_after(df, keys, list(got[-1]), 7).select(*keys).collect()
        assert step
        got += [tuple(r) for r in step]
    assert got == want and S.page_after(df, keys, list(got[-1]), 7).count() == 0


def test_order_key_with_ties_is_refused(spark):
    import pytest
    df = spark.createDataFrame([(1, None), (2, None), (3, 5)], "id long, k long")
    S.verify_order_key(df, ["k", "id"])
    with pytest.raises(ValueError):
        S.verify_order_key(df, "k")


def test_too_few_key_values_are_refused(spark):
    df = spark.createDataFrame([(5, 1), (5, 2), (4, 3)], "ts int, id int")
    for bad in ([5], [5, 1, 1], []):
        with pytest.raises(ValueError):
            S.page_after(df, ["ts", "id"], bad, 10)
