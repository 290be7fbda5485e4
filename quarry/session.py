"""Session defaults and the shared working folder.

Outputs that must outlive a task (sink staging, streaming state, audit
tables) go under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is missing (a laptop or a unit test) do we create a
local one.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # wide projection (CSV text of many columns) fused into one larger
    # method would run interpreted. Past this size Spark falls back to
    # per-expression generated code instead (3-4x faster for such stages).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Settings the operators rely on at run time; applied to sessions we did not
# build ourselves (e.g. the one a scheduler hands us).
RUNTIME_SETTINGS = (
    "spark.sql.session.timeZone",
    "spark.sql.ansi.enabled",
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.legacy.javaCharsets",
)


def build_session(master: str | None = None, app_name: str = "quarry",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on."""
    for key in RUNTIME_SETTINGS:
        spark.conf.set(key, SESSION_DEFAULTS[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide working folder (``spark.checkpoint.dir``).

    Set by the cluster; only when it is unset and the master is local do we
    make a folder and register it (deleted at exit). On a cluster a folder of
    one machine would lose what other machines write, so that raises.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, in this session's
    working folder; ``clear_scratch`` deletes that folder."""
    return f"{shared_dir(spark)}/quarry-work/{_work_name(spark)}/{uuid.uuid4().hex}/{name}"


def _work_name(spark: SparkSession) -> str:
    return f"{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote under ``scratch_path``. Call
    it when the results that read from there are done with, at the latest
    before the session stops."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/quarry-work/{_work_name(spark)}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
