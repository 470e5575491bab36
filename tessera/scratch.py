"""Where intermediate tables go that must not be lost with an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def _own_dir(spark: SparkSession) -> str:
    """A folder that goes when this process ends; only for one machine, as executors elsewhere would not see it."""
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    at = tempfile.mkdtemp(prefix="tessera-")
    atexit.register(shutil.rmtree, at, True)
    return at


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """``spark.checkpoint.dir`` of the session counts; only where it is unset (tests) a temporary folder is taken."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir", None) or f"file://{_own_dir(spark)}")


def kept(df: DataFrame, name: str = "") -> DataFrame:
    """The rows, written once to the shared checkpoint folder; lineage ends there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
