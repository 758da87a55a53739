"""Make this package importable where Python runs for Spark."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent


@functools.cache
def _archive() -> str:
    folder = tempfile.mkdtemp(prefix="smeltery-package-")
    path = os.path.join(folder, "smeltery.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as made:
        for file in sorted(ROOT.rglob("*.py")):
            made.write(file, file.relative_to(ROOT.parent))
    return path


@functools.cache
def _shipped(application: str, context) -> None:
    context.addPyFile(_archive())


def ship(spark: SparkSession) -> None:
    """Send the package's sources (about 100 KB) to the workers once, unless their path has it."""
    given = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(ROOT.parent) not in given:
        _shipped(spark.sparkContext.applicationId, spark.sparkContext)


def shipped(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``run``, whose first argument is a session, with the package sent before."""

    @functools.wraps(run)
    def wrapper(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return run(spark, *args)

    return wrapper
