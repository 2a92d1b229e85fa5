"""Table scans, caching and catalog tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession

from tablewright.base import StageBase, as_bool, param


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Parquet table ``directory/name.parquet``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def load_csv(spark: SparkSession, path: str, schema=None, header: bool = True,
             sep: str = ",") -> DataFrame:
    """Delimited text. With a schema nothing is read for inference."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


class Cacher(StageBase, Transformer):
    """Persist the table when it is first computed."""

    disable = param("disable", "pass the input through", as_bool)
    _defaults = {"disable": False}

    def _transform(self, df: DataFrame) -> DataFrame:
        return df if self.getDisable() else df.persist(StorageLevel.MEMORY_AND_DISK)


class CheckpointData(StageBase, Transformer):
    """Persist in memory, or in memory and on disk; or drop what was persisted."""

    diskIncluded = param("diskIncluded", "persist to disk as well as memory", as_bool)
    removeCheckpoint = param("removeCheckpoint", "unpersist instead", as_bool)
    _defaults = {"diskIncluded": False, "removeCheckpoint": False}

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.getRemoveCheckpoint():
            return df.unpersist()
        level = StorageLevel.MEMORY_AND_DISK if self.getDiskIncluded() else StorageLevel.MEMORY_ONLY
        return df.persist(level)


def persist_to_table(df: DataFrame, database: str, table: str) -> None:
    """Replace a catalog table by the rows of ``df``."""
    df.write.mode("overwrite").saveAsTable(f"`{database}`.`{table}`")
