"""Where intermediate tables go: the folder the session names for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="yieldloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for one run's tables inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """`df` computed once and read back from reliable storage wherever it is used."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read from there: for data that a checkpoint would hold uncompressed."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def forget(spark: SparkSession, folder: str) -> None:
    """Removes a folder that `new_folder` named, once nothing reads it any more."""
    if not folder.startswith(shared_folder(spark).rstrip("/") + "/"):
        raise ValueError(f"{folder} is not in the shared folder")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
