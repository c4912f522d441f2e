"""Session defaults and the one place that decides where lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session with the engine's defaults; an existing session is reused as it is."""
    builder = SparkSession.builder.appName("humusgrid")
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches.

    A cluster names it in spark.checkpoint.dir. Only where that is unset (local
    tests) a folder of this machine is used, and then only by a local master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = os.path.join(tempfile.gettempdir(), f"humusgrid-{os.getpid()}")
    if not os.path.isdir(path):
        os.makedirs(path)
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return "file://" + path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    Survives the loss of any executor, keeps columns compressed, and gives the
    next plan exact sizes. The table is deleted by drop_stage(), by
    drop_stages(), or when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_drop_at_exit, spark)
    _WRITTEN.append(path)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


#: Tables of cut_lineage() that are still there.
_WRITTEN: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_stage(df: DataFrame) -> None:
    """Delete the table that cut_lineage() wrote for df; nothing that reads it may run afterwards."""
    path = df.stage_path
    _delete(df.sparkSession, path)
    _WRITTEN.remove(path)


def drop_stages(spark: SparkSession) -> None:
    """Delete all tables of cut_lineage(): for long sessions, once their results are written."""
    while _WRITTEN:
        _delete(spark, _WRITTEN.pop())


def _drop_at_exit(spark: SparkSession) -> None:
    try:
        drop_stages(spark)
    except Exception as error:  # the JVM may be gone; the folder's owner then removes it
        print(f"tables left in the shared folder: {error}", file=sys.stderr)
