"""Span algebra over character positions: windows, covers, merges, containment and overlap joins.

Spans are half-open and count code points.  Every join of spans has the document *and* a position bin as equi keys, so a
document with very many spans is spread over its bins and no task compares all of a document's spans with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

BIN = 2_048  # characters a bin; a span is listed in every bin it touches


def fixed_windows(df: DataFrame, length: Column, size: int = 30_000, overlap: int = 1_500) -> DataFrame:
    """``df`` with window_index, window_start, window_end for every window; none for a null or non-positive length."""
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("size must be positive and the overlap in [0, size)")
    step = size - overlap
    count = F.when(length <= size, F.lit(1)).otherwise(F.ceil((length - overlap) / F.lit(step)).cast("int"))
    out = df.where(length > 0).withColumn("window_index", F.explode(F.sequence(F.lit(0), count - 1)))
    start = F.col("window_index") * step
    return out.withColumns({"window_start": start, "window_end": F.least(start + size, length).cast("int")})


def piece(text: Column, start: Column, end: Column) -> Column:
    """The characters [start, end) of ``text``."""
    return F.substring(text, start + 1, end - start)


def cover_label(sections: Column, position: Column) -> Column:
    """The first label of the narrowest section that covers ``position`` (the earliest of equals); 'unknown' without one."""
    keyed = F.transform(sections, lambda s, i: F.struct((s["end"] - s["start"]).alias("n"), i.alias("i"), s["start"].alias("a"), s["end"].alias("b"), F.get(s["labels"], F.lit(0)).alias("label")))
    return F.coalesce(F.array_min(F.filter(keyed, lambda s: (s["a"] <= position) & (position < s["b"])))["label"], F.lit("unknown"))


def section_at(points: DataFrame, parsed: DataFrame, position: str, out: str = "section") -> DataFrame:
    """``points`` with the section label at ``position``; the texts stay behind, only the section lists are joined."""
    return points.join(parsed.select("doc_id", "sections"), "doc_id", "left").withColumn(out, cover_label(F.col("sections"), F.col(position))).drop("sections")


def section_shares(parsed: DataFrame) -> DataFrame:
    """(doc_id, label, share): how much of each text each label holds, by each position's narrowest section."""
    length = F.length("text")
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), length), F.transform("sections", lambda x: x["start"]), F.transform("sections", lambda x: x["end"]))))
    base = parsed.where("text IS NOT NULL AND length(text) > 0").select("doc_id", length.alias("n"), "sections", F.coalesce(cuts, F.array(F.lit(0), length)).alias("cuts"))
    parts = base.select("doc_id", "n", "sections", F.explode(F.arrays_zip(F.slice("cuts", F.lit(1), F.size("cuts") - 1).alias("lo"), F.slice("cuts", F.lit(2), F.size("cuts") - 1).alias("hi"))).alias("p"))
    labelled = parts.select("doc_id", "n", cover_label(F.col("sections"), F.col("p.lo")).alias("label"), (F.col("p.hi") - F.col("p.lo")).alias("part"))
    return labelled.groupBy("doc_id", "label").agg(F.round(F.sum("part") / F.max("n"), 6).alias("share"))


def _islands(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans merged where they touch or overlap, per ``keys``."""
    order = W.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") > reach, 1).otherwise(0)).over(order)
    return spans.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def merge_spans(spans: DataFrame, key: str, bin_chars: int = 16 * BIN) -> DataFrame:
    """(key, start, end): spans of a key merged where they touch or overlap.

    Repeated spans collapse first (map-side), then spans merge within bins, so what meets per key is at most a few islands
    for every bin of its text, however many spans it has.
    """
    once = spans.select(key, "start", "end").where("start IS NOT NULL AND end IS NOT NULL").distinct()
    partial = _islands(once.withColumn("_bin", F.floor(F.col("start") / bin_chars)), [key, "_bin"])
    return _islands(partial.drop("_bin"), [key])


def anchor_windows(anchors: DataFrame, lengths: DataFrame, radius: int = 1_500) -> DataFrame:
    """(doc_id, start, end): anchors widened by ``radius``, clamped to the text and merged. ``lengths`` has doc_id, n."""
    wide = anchors.join(lengths, "doc_id").select(
        "doc_id", F.greatest(F.col("start") - radius, F.lit(0)).alias("start"), F.least(F.col("end") + radius, F.col("n")).alias("end"))
    return merge_spans(wide, "doc_id")


def binned(spans: DataFrame, start: str, end: str) -> DataFrame:
    """``spans`` once for every bin they touch (``_bin``)."""
    last = F.greatest(F.col(start), F.col(end) - 1)
    return spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / BIN), F.floor(last / BIN))))


def inner_bin(spans: DataFrame, start: str) -> DataFrame:
    """``spans`` with the bin of their start only."""
    return spans.withColumn("_bin", F.floor(F.col(start) / BIN))


def holds_any(outer: DataFrame, inner: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct spans of ``outer`` (keys, start, end) that contain a span of ``inner``."""
    o = binned(outer.select(*keys, "start", "end").distinct(), "start", "end")
    i = inner_bin(inner.select(*keys, F.col("start").alias("_s"), F.col("end").alias("_e")).distinct(), "_s")
    cond = [o[k] == i[k] for k in [*keys, "_bin"]] + [i["_s"] >= o["start"], i["_e"] <= o["end"]]
    return o.join(i, cond, "left_semi").drop("_bin").distinct()


def outside_all(inner: DataFrame, outer: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The rows of ``inner`` whose span no span of ``outer`` (keys, start, end) contains."""
    i = inner_bin(inner, start)
    o = binned(outer.select(*keys, F.col("start").alias("_s"), F.col("end").alias("_e")).distinct(), "_s", "_e")
    cond = [i[k] == o[k] for k in [*keys, "_bin"]] + [i[start] >= o["_s"], i[end] <= o["_e"]]
    return i.join(o, cond, "left_anti").drop("_bin")


def overlaps_any(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct spans of ``left`` (keys, start, end) that overlap a span of ``right``."""
    a = binned(left.select(*keys, "start", "end").distinct(), "start", "end")
    b = binned(right.select(*keys, F.col("start").alias("_s"), F.col("end").alias("_e")).distinct(), "_s", "_e")
    cond = [a[k] == b[k] for k in [*keys, "_bin"]] + [b["_s"] < a["end"], a["start"] < b["_e"]]
    return a.join(b, cond, "left_semi").drop("_bin").distinct()


def context(text: Column, start: Column, end: Column, around: int = 400) -> Column:
    """The stretch and ``around`` characters on both sides, clamped to the text."""
    low = F.greatest(start - around, F.lit(0))
    return piece(text, low, F.least(end + around, F.length(text)))
