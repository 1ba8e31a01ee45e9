"""Filling containers of fixed capacity (problem 8): first-fit decreasing on a tournament tree, in randomised groups.

Items are hashed into groups of about ``GROUP_ITEMS`` (their number follows from the counted items), each group is packed
by one task, and the loss against packing all at once is at most about one part-filled container a group.  A repeated row is
an item of its own: equal rows are counted first (map-side combined) and numbered when they are spread, so a row that
makes up a third of the table still falls evenly into all groups.

Defined results.  A text over the capacity is cut into pieces of the capacity and a rest; full pieces are containers of
their own, the rest is packed like any item.  Texts of no tokens (null, empty) are items of size 0 and go to the first
container of their group.  Null ids are kept.  Equal sizes are taken in the order of their ids.  An empty table gives an
empty result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from spanloom.plans.lineage import cut

CAPACITY = 2048
GROUP_ITEMS = 20_000


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size (given in falling order): the leftmost bin with room, found in a tournament of free room."""
    width = 1 << max(0, (len(sizes) - 1).bit_length())
    room = [capacity] * (2 * width)  # bins not yet opened are empty, so the leftmost fit opens them in order
    bins = []
    for size in sizes:
        if size > capacity:
            raise ValueError("an item exceeds the capacity")
        k = 1
        while k < width:
            k *= 2
            if room[k] < size:
                k += 1
        bins.append(k - width)
        room[k] -= size
        while k > 1:
            k >>= 1
            a, b = room[2 * k], room[2 * k + 1]
            room[k] = a if a > b else b
    return bins


def pack(sized: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, seed: int = 7) -> DataFrame:
    """(id_col, copy, piece, piece_start, piece_tokens, container) for every piece of every row of ``sized``.

    The counted sizes are written once: the number of groups, the full pieces and the rests are all taken from them.
    """
    counted = cut(sized.groupBy(F.col(id_col).alias("_id"), F.col(size_col).cast("int").alias("_size")).agg(F.count(F.lit(1)).alias("_n")))
    groups = max(1, -(-(counted.agg(F.sum("_n")).first()[0] or 0) // group_items))
    items = counted.select("_id", "_size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_copy"))
    last = F.greatest((F.col("_size") / capacity).cast("int") - F.when(F.col("_size") % capacity == 0, 1).otherwise(0), F.lit(0))
    full = (
        items.where(F.col("_size") >= capacity)
        .select("_id", "_size", "_copy", F.explode(F.sequence(F.lit(0), (F.col("_size") / capacity).cast("int") - 1)).alias("_piece"))
        .select("_id", "_copy", "_piece", F.lit(capacity).alias("_part"),
                F.concat_ws(":", F.lit("full"), F.coalesce(F.col("_id").cast("string"), F.lit("null")), "_size", "_copy", "_piece").alias("container"))
    )
    rest = items.where((F.col("_size") % capacity > 0) | (F.col("_size") == 0)).select(
        F.pmod(F.xxhash64("_id", "_size", "_copy", F.lit(seed)), F.lit(groups)).alias("_group"), "_id", "_copy", last.alias("_piece"), (F.col("_size") % capacity).alias("_part")
    )
    kind = sized.schema[id_col].dataType.simpleString()

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_part", "_id", "_copy", "_piece"], ascending=[False, True, True, True], na_position="last", kind="stable")
        bins = first_fit_decreasing(pdf["_part"].tolist(), capacity)
        return pdf.assign(container=[f"{g}:{b}" for g, b in zip(pdf["_group"], bins)])[["_id", "_copy", "_piece", "_part", "container"]]

    packed = rest.groupBy("_group").applyInPandas(fill, f"_id {kind}, _copy long, _piece int, _part int, container string")
    both = full.unionByName(packed)
    return both.select(F.col("_id").alias(id_col), F.col("_copy").alias("copy"), F.col("_piece").alias("piece"),
                       (F.col("_piece") * capacity).alias("piece_start"), F.col("_part").alias("piece_tokens"), "container")
