"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", name: str = "hazeline", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, else a folder in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/hazeline/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts lineage in a way that outlives lost executors, and as Parquet it
    keeps column pruning and filter pushdown for the passes that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of the session. What was read from them can't be read again."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/hazeline")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
