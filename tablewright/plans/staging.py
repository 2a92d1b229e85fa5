"""Durable intermediate tables in the folder that the cluster shares.

Executors can be lost, so an intermediate that is read twice, or whose rows must not
change between two reads, is written to the shared checkpoint folder and read back.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDER_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a session on one machine without that setting
    (tests, local runs) gets a temporary folder of its own."""
    folder = spark.conf.get(_FOLDER_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_FOLDER_KEY} to a folder that all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tablewright-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tablewright/{label}-{uuid.uuid4().hex}"


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make the folder if it isn't there, so that it can be scanned though nothing was written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table: no lineage, columnar, prunable."""
    spark = df.sparkSession
    path = new_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
