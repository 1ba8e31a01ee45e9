"""Per-key results where a handful of keys holds most rows (problem 6).

Everything here is an algebraic aggregate: each task combines its own rows into one bounded hash table of mergeable
per-key states (Spark's partial aggregation, which spills when full) and only those compact states are shuffled.  A key
with a third of all rows therefore sends at most one state per map task.  Distinct counts take two such rounds: first
over (key, value), whose partial states collapse repeats before the shuffle and whose hash spreads a hot key's values
over all tasks; then over key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def key_counts(df: DataFrame, key: str, out_key: str = "key") -> DataFrame:
    """(out_key, n): stored rows of every key, the null key and repeated rows included.  Empty table: no row."""
    return df.groupBy(F.col(key).alias(out_key)).agg(F.count(F.lit(1)).alias("n"))


def heavy_keys(df: DataFrame, key: str, share: float = 0.01, out_key: str = "heavy_key") -> DataFrame:
    """(out_key, n, n_total) of every non-null key in at least ``share`` of all stored rows.

    The total counts rows with a null key and repeated rows; ties at exactly ``share`` are kept; an empty table has no
    heavy key.  The share is compared in integers, in millionths.  The compact counts are aggregated once more for the total, a
    scalar subquery over the same exchange: the null key is left out by its count, as a filter on the key would reach one of the two
    scans only and the table would be read and shuffled twice.
    """
    counts = key_counts(df, key, out_key)
    total = counts.agg(F.sum("n").alias("n_total")).scalar()
    own = F.when(F.col(out_key).isNull(), F.lit(0)).otherwise(F.col("n"))
    return counts.withColumn("n_total", total).where((own > 0) & (own * 1_000_000 >= F.col("n_total") * round(share * 1_000_000)))


def distinct_per_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(key, out): number of distinct non-null ``value`` per key, in two map-side-combined rounds."""
    pairs = df.groupBy(key, value).agg(F.lit(1).alias("_one"))
    return pairs.groupBy(key).agg(F.count(value).alias(out))


def key_profile(df: DataFrame, key: str, value: str, measures: dict[str, Column]) -> DataFrame:
    """Per key: ``n_rows``, ``n_distinct`` of ``value`` and the given min/max/sum ``measures``, without a hot task.

    ``measures`` maps an output name to ("min" | "max" | "sum", column).  The first round groups by (key, value), the
    second merges its states by key.  Null keys form a group of their own; null values count as rows, not as distinct.
    """
    fold = {"min": F.min, "max": F.max, "sum": F.sum}
    first = df.groupBy(key, F.col(value).alias("_value")).agg(
        F.count(F.lit(1)).alias("_n"), *[fold[how](column).alias(f"_m_{name}") for name, (how, column) in measures.items()]
    )
    return first.groupBy(key).agg(
        F.sum("_n").alias("n_rows"),
        F.count("_value").alias("n_distinct"),
        *[fold[how](f"_m_{name}").alias(name) for name, (how, _) in measures.items()],
    )
