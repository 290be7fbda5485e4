from quarry.sources.catalog import table_inventory


def test_inventory_lists_the_whole_catalog(spark):
    spark.sql("DROP TABLE IF EXISTS inv_b")
    spark.sql("CREATE TABLE inv_b (id BIGINT) USING parquet COMMENT 'kept rows'")
    try:
        spark.range(3).write.insertInto("inv_b")
        spark.range(2).createOrReplaceTempView("inv_a")
        rows = [(r.table_name, r.row_count, r.comment) for r in table_inventory(spark).collect() if r.table_name.startswith("inv_")]
        assert rows == [("inv_a", 2, None), ("inv_b", 3, "kept rows")]
    finally:
        spark.sql("DROP TABLE IF EXISTS inv_b")
        spark.catalog.dropTempView("inv_a")


def test_stored_statistics_spare_the_scan(spark):
    from quarry.sources import catalog as C
    names = ["st_known", "st_new"]
    try:
        for i, name in enumerate(names):
            spark.range(3 + i).write.mode("overwrite").saveAsTable(name)
        assert C.stored_row_count(spark, "st_known") is None
        C.analyze(spark, ["st_known"])
        known = C.catalog_inventory(spark, ["st_known"])
        assert [tuple(r) for r in known.collect()] == [("st_known", 3, False, None)]
        assert "Scan parquet" not in known._jdf.queryExecution().executedPlan().toString()
        both = [tuple(r)[:3] for r in C.catalog_inventory(spark, names).collect()]
        assert both == [("st_known", 3, False), ("st_new", 4, True)]
        unknown = [tuple(r)[:3] for r in C.catalog_inventory(spark, names, scan_missing=False).collect()]
        assert unknown == [("st_known", 3, False), ("st_new", None, False)]
        listed = {r.table_name for r in C.catalog_inventory(spark).collect()}
        assert set(names) <= listed
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
