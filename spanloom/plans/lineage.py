"""Cutting lineage in iterative jobs so that a lost executor costs a re-read, not a recomputation."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir`` (shared by all executors).  Only where that is unset *and* the
    master is a single JVM does a temporary folder serve; on a cluster without the setting this raises.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    have = sc.getCheckpointDir()
    if have:
        return have
    if named:
        sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="spanloom-ckpt-")
    sc.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint of ``df``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
