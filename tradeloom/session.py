"""Session settings and the places where a plan meets storage or a size check."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "tradeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. `conf` uses `__` for dots."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
        "spark.executor.extraJavaOptions": "-Duser.timezone=UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which every executor can reach."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tradeloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that is used several times to the shared folder and read it back.

    The copy is columnar, so later scans still prune columns, and it outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_garbage(spark: SparkSession) -> None:
    """Collect the driver's garbage: Spark deletes the files of a shuffle only when its plan is collected."""
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame, label: str) -> DataFrame:
    """The stored frame. Its shuffles are not read again, and Spark deletes their files when the driver forgets them."""
    stored = stage(df, label)
    drop_garbage(df.sparkSession)
    return stored


def unstage(*frames: DataFrame | None) -> None:
    """Delete the stored copies of these frames, each from `stage`, once nothing reads them any more, and the driver's garbage."""
    spark = None
    for frame in frames:
        for file in frame.inputFiles()[:1] if frame is not None else []:
            folder, spark = file.rsplit("/", 1)[0], frame.sparkSession
            if "/staged/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if spark is not None:
        drop_garbage(spark)


def clear_staged(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
