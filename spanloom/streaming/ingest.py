"""Incremental ingestion: new files are taken once, resumably, into a table, and streamed counts by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def ingest_jsonl(spark: SparkSession, folder: str, schema: T.StructType, table: str, checkpoint: str, key: list[str], late: str = "7 days", time_col: str | None = None) -> StreamingQuery:
    """Take every new JSON-lines file of ``folder`` into the Parquet table ``table`` and stop.

    The checkpoint makes a file count once across runs.  With ``time_col`` rows repeated within the watermark are dropped in a
    bounded state; without it rows are only taken once per file.
    """
    rows = spark.readStream.schema(schema).json(folder)
    if time_col:
        rows = rows.withWatermark(time_col, late).dropDuplicatesWithinWatermark(key)
    return rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()


def windowed_counts(events: DataFrame, time_col: str, kind: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(start, kind, n) per window of event time; on a stream late rows beyond the watermark are left out."""
    rows = events.withWatermark(time_col, late) if events.isStreaming else events
    return rows.groupBy(F.window(time_col, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
