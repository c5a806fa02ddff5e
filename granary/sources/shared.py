"""The folder that driver and executors share, and small files in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where none is named a local one is made, if Spark runs in
    this process alone; a cluster has to name one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = context._jsc.sc().getCheckpointDir()
        if held.isDefined():
            named = held.get()
        elif context.master.startswith("local") and "cluster" not in context.master:
            named = tempfile.mkdtemp(prefix="granary-")
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing is at."""
    return f"{folder(spark)}/granary-{name}-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, text: str) -> str:
    """One small file, written whole by the driver."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return path


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """The same if nothing is at the path; False, and nothing changed, if something is. Of several that try at once one
    succeeds, where the file system creates files in one step (HDFS and local ones do)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(where):
        return False
    try:
        out = files.create(where, False)
    except Exception as e:
        if files.exists(where):
            return False
        raise e
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
