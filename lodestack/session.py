"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it (a cluster gets it by --py-files)."""
    here = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [here, env.get("PYTHONPATH", "")]))


def checkpoint_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a folder of this machine is made, but in local mode only: on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return root or held.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lodestack-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def settled(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder, as compressed columns, and reads it back: cuts lineage, as a checkpoint does."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
