"""Tables written between the steps of a plan, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset and the driver runs all tasks itself, a
    temporary folder. On a cluster no executor would see that, so there the setting is required."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors of {master} share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return f"file://{_own['dir']}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: lineage ends there,
    a lost executor costs nothing that was written, and what comes after computes nothing twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
