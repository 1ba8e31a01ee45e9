"""Parquet scans of the engine's tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root/name.parquet``; column pruning and filters reach the scan through Catalyst."""
    return spark.read.parquet(f"{root}/{name}.parquet")
