"""Locating quotations in their source: exact, then tolerant of blanks and typographic marks, then of case.

Among several places the one whose start is nearest to the hint wins, the first of equals.  A document's quotations are gathered in
parts of about ``PART``, each part meets the text once and goes through an Arrow batch with it, where Python's ``re`` gives the
tolerant tiers: a text is sent once for ``PART`` quotations, and a document with very many is spread over its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

PART = 200  # quotations that share a text
#: Marks of a quotation that may be typeset otherwise in the source.
VARIANTS = {"'": "['‘’]", '"': '["“”]', "-": "[-‐‑‒–—]"}


def tolerant_pattern(quote: str) -> str:
    """Words as they are, any blanks between them, straight marks also as typeset ones."""
    word = lambda w: "".join(VARIANTS.get(c) or re.escape(c) for c in w)
    return r"\s+".join(map(word, quote.split()))


def locate(quote: str | None, text: str | None, hint: int | None = None) -> tuple[int, int, str] | None:
    """(start, end, status) of the best place of ``quote``; None where it is not in the text or empty."""
    quote = (quote or "").strip()
    if not quote or text is None:
        return None
    places, at = [], text.find(quote)
    while at >= 0:
        places.append((at, at + len(quote)))
        at = text.find(quote, at + 1)
    status = "match_exact"
    if not places:
        pattern = tolerant_pattern(quote)
        for status, flags in (("match_fuzzy", 0), ("match_lesser", re.IGNORECASE)):
            places = [m.span() for m in re.finditer(pattern, text, flags)]
            if places:
                break
    if not places:
        return None
    start, end = places[0] if hint is None else min(places, key=lambda p: abs(p[0] - hint))
    return start, end, status


def align(quotes: DataFrame, texts: DataFrame, part: int = PART) -> DataFrame:
    """``quotes`` (doc_id, source_quote, hint, ...) with aligned_start, aligned_end, aligned_status and aligned_quote, the
    source's own characters (null: not in the text).  Repeated quotations are placed once."""
    keys = ["doc_id", "source_quote", "hint"]
    asked = quotes.select(*keys).distinct()
    counts = asked.groupBy(F.col("doc_id").alias("_doc")).agg(F.ceil(F.count(F.lit(1)) / part).cast("long").alias("_parts"))
    items = asked.join(counts, asked["doc_id"].eqNullSafe(counts["_doc"]))
    items = items.groupBy("doc_id", F.pmod(F.xxhash64("source_quote", "hint"), "_parts").alias("_part")).agg(F.collect_list(F.struct("source_quote", "hint")).alias("_items"))
    joined = items.join(texts.select("doc_id", "text"), "doc_id", "left").select("doc_id", "_items", "text")
    more = [("aligned_start", T.IntegerType(), pa.int32()), ("aligned_end", T.IntegerType(), pa.int32()), ("aligned_status", T.StringType(), pa.string()), ("aligned_quote", T.StringType(), pa.string())]
    schema = T.StructType([*(T.StructField(f"_{k}", quotes.schema[k].dataType, True) for k in keys), *(T.StructField(n, t, True) for n, t, _ in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sizes = batch.column(1).flatten(), batch.column(1).value_lengths().to_pylist()
            pairs = zip(items.field("source_quote").to_pylist(), items.field("hint").to_pylist())
            found = []
            for text, n in zip(batch.column(2).to_pylist(), sizes):
                for q, h in islice(pairs, n):
                    at = locate(q, text, h)
                    found.append((*at, text[at[0] : at[1]]) if at else (None,) * 4)
            docs = batch.column(0).take(pa.array([i for i, n in enumerate(sizes) for _ in range(n)], pa.int64()))
            made = [pa.array([f[k] for f in found], t) for k, (_, _, t) in enumerate(more)]
            yield pa.RecordBatch.from_arrays([docs, items.field("source_quote"), items.field("hint"), *made], schema.names)

    placed = joined.mapInArrow(run, schema)
    same = [quotes[k].eqNullSafe(placed[f"_{k}"]) for k in keys]
    return quotes.join(placed, same, "left").drop(*[f"_{k}" for k in keys])
