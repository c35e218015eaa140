"""Session defaults, the UTC pin and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

#: What a task gets at most of a shuffle and of a scan, compressed.
TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}


def spark_session(
    app_name: str, master: str | None = None, options: dict[str, str] | None = None
) -> SparkSession:
    """Session for the jobs.  Shuffle width and memory are left to ``options``
    and the cluster: adaptive execution coalesces what is too wide."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """All ``*_utc`` columns are UTC whatever zone the host or the JVM runs in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return bound_tasks(spark)


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Narrow rows take many times their stored bytes in a sort, so tasks are given fewer bytes
    than Spark's defaults; a session that names its own sizes keeps them."""
    for key, size in TASK_BYTES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, size)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master without that setting gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/contrail/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a written table: later actions neither recompute the
    plan nor depend on the executor that produced it.  Returns the frame and its
    path, so that the caller can ``discard`` it."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``stage`` with a denser codec, for rows of ids that no dictionary helps."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return bool(fs.exists(hadoop_path))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder made by ``stage``."""
    if not path.startswith(f"{shared_dir(spark)}/contrail/"):
        raise ValueError(f"not a staged folder: {path}")
    remove_folder(spark, path)
