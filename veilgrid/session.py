"""Session helpers shared by queries, tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it was started from a checkout.

    On a cluster the package comes with ``--py-files``; the extra path then does no harm.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a local session gets one; a cluster must name it."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is unset: intermediate tables need a folder that the driver and all executors share")
        at = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at)
    return at


_CLEARED: set[str] = set()


def work_dir(spark: SparkSession) -> str:
    """This application's own folder for intermediate tables; it is removed when the driver ends."""
    at = f"{shared_dir(spark)}/veilgrid/{spark.sparkContext.applicationId}"
    if at not in _CLEARED:
        _CLEARED.add(at)
        atexit.register(_at_exit, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), at)
    return at


def _at_exit(jvm: object, conf: object, at: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # the Java side may have gone before; nothing is left to do then
        pass


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that were not written yet can no longer be read."""
    remove(spark, work_dir(spark))


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later steps start from files that outlive executors."""
    path = f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a few small files would keep most of them idle; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
