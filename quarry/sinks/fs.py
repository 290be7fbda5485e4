"""File-system steps of the sinks, through Hadoop's API, and the counted write."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def file_system(spark: SparkSession, path: str):
    """(file system, path, jvm) of a location."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath, _ = file_system(spark, path)
    return bool(fs.exists(hpath))


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath, _ = file_system(spark, path)
    fs.delete(hpath, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; none if there is no folder."""
    fs, hpath, _ = file_system(spark, folder)
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath)]


def modified_at(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of a path's last change."""
    fs, hpath, _ = file_system(spark, path)
    return fs.getFileStatus(hpath).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath, jvm = file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file with its whole content in one step, unless a file of that
    name is there: True for exactly one of any number of writers. On a local
    folder a hard link decides, elsewhere a rename that does not overwrite
    (one step on HDFS and on stores with a hierarchical name space)."""
    fs, hpath, jvm = file_system(spark, path)
    fs.mkdirs(hpath.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{hpath.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    where = fs.makeQualified(hpath).toUri()
    try:
        if where.getScheme() == "file":
            nio = jvm.java.nio.file.Paths
            jvm.java.nio.file.Files.createLink(nio.get(where.getPath(), _none(spark)), nio.get(beside.toUri().getPath(), _none(spark)))
        else:
            kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            options = spark.sparkContext._gateway.new_array(kinds, 1)
            options[0] = kinds.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(where, spark.sparkContext._jsc.hadoopConfiguration()) \
                .rename(beside, hpath, options)
        return True
    except Exception:
        if fs.exists(hpath):
            return False
        raise
    finally:
        fs.delete(beside, False)


def _none(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.String, 0)


def write_counted(df: DataFrame, write) -> int:
    """Run ``write(frame)`` and return the rows written, counted on the way
    through the write (an Observation), not by a second scan."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get.get("rows", 0))
