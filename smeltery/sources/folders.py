"""Where intermediate tables go: a folder all executors can reach."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_base() -> str:
    """One temporary folder for a local session, removed when Python ends."""
    base = tempfile.mkdtemp(prefix="smeltery-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def shared_base(configured: str | None, master: str) -> str:
    """The configured shared folder; a temporary one only where there are no executors."""
    if configured:
        return configured.rstrip("/")
    if not is_local(master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_base()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the session's ``spark.checkpoint.dir``."""
    base = shared_base(spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master)
    return f"{base}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there."""
    spark = df.sparkSession
    path = working_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
