"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a cluster session
    is refused, because a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cadence-"))
    return sc.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For results that several later steps read: the lineage ends here, survives lost
    executors, and each reader scans only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cadence-stage/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
