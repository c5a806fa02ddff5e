"""What the operators of this subpackage share: shared storage, session settings, Arrow helpers."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from granary.sources import shared

#: Rows that one Arrow batch may hold. Texts can be long, so batches are kept short.
BATCH_ROWS = 512


def tune(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Keep Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    return shared.folder(spark)


def free_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that the table does not have, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared folder, computed now."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder as Parquet and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/granary-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go the shuffle files of tables that have been cut off or are no longer held: Spark deletes them
    when the driver has collected what referred to them, which it may not do for long by itself."""
    gc.collect()
    spark._jvm.System.gc()


class Work:
    """Tables that are written while something is computed, and are deleted when it is done. Shuffles
    that nothing needs any more are let go then, too."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(self.spark)}/granary-{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *_) -> None:
        for p in self.paths:
            shared.delete(self.spark, p)
        release(self.spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
