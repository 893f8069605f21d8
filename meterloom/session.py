"""Session helpers: the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="meterloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a folder of
    one machine is lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage like a checkpoint, survives lost executors, and unlike a checkpoint
    still lets later scans read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
