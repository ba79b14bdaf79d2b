"""The shared folder used to cut lineage, and the size of what goes to Python at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_FOLDER = "/tmp/checkpoints"
BATCH_BYTES = "4m"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset, a session on one machine (``local[n]``) uses
    LOCAL_FOLDER; on a cluster that is an error, as executors would not see each other's files."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if context.master == "local" or context.master.startswith("local["):
        return LOCAL_FOLDER
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def stage(df: DataFrame) -> DataFrame:
    """Write once as Parquet in the shared folder and read from there, so that later readers take only their columns."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder, so several readers reuse one computation and a lost executor costs
    nothing."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows; from now on the session hands at most BATCH_BYTES at once to Python, so that long texts cost
    executors little memory. The default is 64 MB, in the JVM and again in every Python worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df
