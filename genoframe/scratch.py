"""Tables and checkpoints that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else the context's checkpoint directory.

    Where neither is set, local masters get a new folder of their own; on a cluster that is an error, as a folder of the
    driver's machine is none of the executors'.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.genoframe.folder", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='spark-genoframe-')}"
        spark.conf.set("spark.genoframe.folder", at)
    return at


def own_folder(spark: SparkSession) -> str:
    """Where this application puts its tables and files, within the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/genoframe-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, kind: str) -> str:
    """A path in own_folder() that nothing else uses."""
    return f"{own_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> None:
    """Remove what this application has written there. Results that are read from it cannot be worked out again."""
    files, at = pa.fs.FileSystem.from_uri(own_folder(spark))
    if files.get_file_info(at).type != pa.fs.FileType.NotFound:
        files.delete_dir(at)


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder; unlike a checkpoint it can be read by column and holds no partitioning."""
    at = new_path(df.sparkSession, "table")
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
