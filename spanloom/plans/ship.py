"""Sending the package to the executors' Python workers, where their path does not have it."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Once per context: the package as a zip among the files Spark serves to its workers."""
    sc = spark.sparkContext
    if getattr(sc, "_spanloom_sent", False):
        return
    folder = tempfile.mkdtemp(prefix="spanloom-")  # the driver serves the file from here as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = Path(folder, "spanloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(_PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(_PACKAGE.parent))
    sc.addPyFile(str(target))
    sc._spanloom_sent = True


def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``f``, with the package sent before it runs."""
    @functools.wraps(f)
    def run(spark: SparkSession, root: str) -> DataFrame:
        ship(spark)
        return f(spark, root)

    return run
