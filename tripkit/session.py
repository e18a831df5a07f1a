"""Session helpers: where shared intermediates live and how they are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local-mode session without that setting gets a fresh temporary folder; a
    cluster session without it is an error, because a machine-local folder would be
    lost together with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tripkit-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, as Parquet, and read it back.

    Later passes read only the columns and row groups they need, and a lost executor costs no
    recomputation. The files stay until ``clear_scratch`` or the end of the folder's life.
    """
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder, once its results are stored elsewhere."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
