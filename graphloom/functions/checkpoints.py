"""Lineage cuts that survive the loss of executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share. Where it is unset, a local session gets
    a folder of its own, as in tests; on a cluster that is an error, since executors would not see each other's files."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="graphloom-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared folder and read it back."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
