"""Helpers shared by the operators: input selection, lineage cuts, hashing."""

from __future__ import annotations

import sys
import types
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, renamed, so that further columns of the
    caller's table can never clash with the ones an operator makes."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def whole_text(column: Column | str) -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there:
    what it cost is paid once, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def crc_bucket(id_column: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets`` (null id: of '')."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % F.lit(buckets)


def hex_text(column: Column) -> Column:
    """A 64-bit integer as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def documents(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, for what is
    expensive to load. Task functions are shipped by value, so a module
    global would be new in every task."""
    return sys.modules.setdefault("_quarry_llm_worker", types.ModuleType("_quarry_llm_worker")).__dict__


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, place) and the same with one row per place; place
    orders the documents. It is the id itself,
    where ids are whole numbers, all different and none null; else the rank of
    (doc_id, hash of the text), numbered along a distributed sort."""
    if rows.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        n, different = rows.agg(F.count("*"), F.count_distinct("doc_id")).first()
        if n == different:
            every = rows.withColumn("place", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
            return every, every
    copies = rows.withColumn("copy", F.xxhash64("text"))
    ranked = cut(copies.select("doc_id", "copy").distinct().orderBy("doc_id", "copy")
                 .withColumn("place", F.monotonically_increasing_id())) \
        .select(F.col("doc_id").alias("of_id"), F.col("copy").alias("of_copy"), F.coalesce("place", F.lit(0)).alias("place"))
    same = copies.doc_id.eqNullSafe(ranked.of_id) & (copies["copy"] == ranked.of_copy)
    every = copies.join(ranked, same).select("doc_id", "text", "place")
    return every, every.dropDuplicates(["place"])
