"""Splitting long texts at natural boundaries, with overlap (problem 5).

Sentences are the units of lexical cohesion: at every gap between two sentences the words of the ``BLOCK`` sentences before
it are compared (cosine) with those of the ``BLOCK`` after it.  A valley of that similarity, measured from the peaks on both
sides, marks a change of topic.  Windows are cut greedily: in the second half of the longest window that may begin at a
position, the cut goes to the deepest valley (the latest of equals); the next window begins ``overlap`` characters before
it.  Where a half window holds no gap between sentences, the cut goes behind its last blank, else before its last
character that is not between two letters or digits, else to the limit.

Given windows are reviewed against the same rules, and each faulty one comes out with its faults and the end the
segmentation would give it.

Defined results.  Null text: no windows, and of given windows only those faults that need no text.  Empty text: no windows,
and any given window with an end above 0 is past the end.  A window with a null position has the fault ``null``.  Windows are
taken in the order of their index, repeated rows as separate windows in order of their positions; the different windows of a
document are at most a few for every 30,000 characters of one string, so they are gathered per document, equal ones counted first.  Empty tables give empty results.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from math import sqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LIMIT, OVERLAP, BLOCK = 30_000, 1_500, 6

_END = re.compile(r"[.!?…][\"'”’)\]]*(?=\s)|\n+")
_TERM = re.compile(r"[^\W\d_]{4,}")


def gaps(text: str) -> list[int]:
    """The positions just behind sentences and headings, inside the text."""
    out, last = [], 0
    for m in _END.finditer(text):
        at = m.start() if m.group()[0] == "\n" else m.end()
        if at > last and not text[last:at].isspace():
            out.append(at)
            last = at
    return [g for g in out if 0 < g < len(text)]


def valley_depths(text: str, at: list[int], block: int = BLOCK) -> list[float]:
    """The depth of the similarity valley at each gap; 0 where it is none."""
    starts = [0, *at]
    units = [Counter(_TERM.findall(text[a:b].lower())) for a, b in zip(starts, [*at, len(text)])]
    # both blocks slide by one sentence: their product and squared lengths change by that sentence's words only
    left: dict[str, int] = {}
    right: dict[str, int] = {}
    product = 0

    def add(to: dict[str, int], other: dict[str, int], unit: Counter, sign: int) -> int:
        nonlocal product
        grown = 0
        for word, n in unit.items():
            have = to.get(word, 0)
            to[word] = have + sign * n
            grown += (2 * have + sign * n) * sign * n
            if word in other:
                product += sign * n * other[word]
        return grown

    near, a, b = [], 0, 0
    for u in units[:block]:
        b += add(right, left, u, 1)
    for i in range(1, len(units)):
        b += add(right, left, units[i - 1], -1)
        a += add(left, right, units[i - 1], 1)
        if i > block:
            a += add(left, right, units[i - 1 - block], -1)
        if i + block - 1 < len(units):
            b += add(right, left, units[i + block - 1], 1)
        near.append(product / sqrt(a * b) if a and b else 0.0)
    n = len(near)
    before, after = near[:], near[:]  # the peak reached by climbing from each gap
    for i in range(1, n):
        if near[i - 1] >= near[i]:
            before[i] = before[i - 1]
    for i in range(n - 2, -1, -1):
        if near[i + 1] >= near[i]:
            after[i] = after[i + 1]
    return [before[i] + after[i] - 2 * near[i] for i in range(n)]


def inside_word(text: str, at: int) -> bool:
    """Does ``at`` lie between two characters that are both letters or digits?"""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()


#: Kinds of places where a text may be cut, from the worst.
INSIDE_WORD, BETWEEN_SIGNS, BEHIND_BLANK, GAP = range(4)


class Cutter:
    """Ends of windows over one text: those it makes, and what given ones are worth by the same ladder of kinds of places.

    The segmentation is made once, when it is first needed.
    """

    def __init__(self, text: str, limit: int, overlap: int) -> None:
        if not 0 <= overlap < limit // 2:
            raise ValueError("the overlap must be less than half of the limit")
        self.text, self.limit, self.overlap = text, limit, overlap
        self._gaps: tuple[list[int], list[float]] | None = None

    def segments(self) -> tuple[list[int], list[float]]:
        """The gaps between sentences and the depth of cohesion's valley at each."""
        if self._gaps is None:
            at = gaps(self.text)
            self._gaps = (at, valley_depths(self.text, at))
        return self._gaps

    def kind(self, at: int) -> int:
        """What kind of place ``at`` is, gaps between sentences aside."""
        if inside_word(self.text, at):
            return INSIDE_WORD
        return BEHIND_BLANK if self.text[at - 1 : at].isspace() else BETWEEN_SIGNS

    def end(self, start: int) -> int:
        """The end of the window that begins at ``start``: the deepest valley, else the last place of the best other kind."""
        stop, least = start + self.limit, start + self.limit // 2
        if stop >= len(self.text):
            return len(self.text)
        at, depth = self.segments()
        inside = range(bisect_left(at, least), bisect_right(at, stop))
        if inside:
            return at[max(inside, key=lambda i: (depth[i], i))]
        for kind in (BEHIND_BLANK, BETWEEN_SIGNS):
            for k in range(stop, least, -1):
                if self.kind(k) >= kind:
                    return k
        return stop

    def faults(self, start: int, end: int) -> list[str]:
        """What this cutter would never do: a window over the limit, past the text, or cut at a place of the worst kind."""
        past = end > len(self.text)
        return ["too_long"] * (end - start > self.limit) + ["past_end"] * past + ["inside_word"] * (not past and self.kind(end) == INSIDE_WORD)

    def windows(self) -> list[tuple[int, int]]:
        out, start = [], 0
        while start < len(self.text):
            end = self.end(start)
            out.append((start, end))
            if end == len(self.text):
                break
            start = end - self.overlap
        return out


def faults(text: str | None, given: list[tuple[int | None, int | None]], limit: int, overlap: int) -> list[list[str]]:
    """The faults of each of a document's windows, in their order."""
    out, last, cutter = [], None, Cutter(text or "", limit, overlap)
    for k, (start, end) in enumerate(given):
        if start is None or end is None:
            found = ["null"]
        else:
            found = cutter.faults(start, end) if text is not None else ["too_long"] * (end - start > limit)
            if k and last is not None and start != last - overlap:
                found.append("overlap")
        last = end
        out.append(found)
    return out


def split_texts(parsed: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, window_index, window_start, window_end) of every text; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, k, a, b) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t
                    for k, (a, b) in enumerate(Cutter(t, limit, overlap).windows())]
            made = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, (pa.string(), *[pa.int32()] * 3))], ["doc_id", "window_index", "window_start", "window_end"])

    return parsed.select("doc_id", "text").mapInArrow(run, "doc_id string, window_index int, window_start int, window_end int")


def review_windows(windows: DataFrame, parsed: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, window_index, window_start, window_end, faults, better_end) of every faulty window.

    Windows are gathered per document (compact) and joined once with its text; a text without windows is not shipped on.
    ``better_end`` is the segmentation's end for a window that begins where this one does, null without text.
    """
    # equal rows are counted first; a third copy has the faults of the second, so two stand for any number
    once = windows.where("doc_id IS NOT NULL").groupBy("doc_id", "window_index", "window_start", "window_end").agg(F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("n"))
    copies = F.array_repeat(F.struct("window_index", "window_start", "window_end"), F.col("n"))
    given = once.groupBy("doc_id").agg(F.array_sort(F.flatten(F.collect_list(copies))).alias("given"))
    joined = given.join(parsed.select("doc_id", "text"), "doc_id", "left").select("doc_id", "text", "given")
    names = ["doc_id", "window_index", "window_start", "window_end", "faults", "better_end"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, ws in zip(*(c.to_pylist() for c in batch.columns)):
                cutter = Cutter(text, limit, overlap) if text else None
                found = faults(text, [(w["window_start"], w["window_end"]) for w in ws], limit, overlap)
                for w, f in zip(ws, found):
                    if f:
                        start = w["window_start"]
                        better = cutter.end(start) if cutter and start is not None and 0 <= start < len(text) else None
                        rows.append((doc, w["window_index"], start, w["window_end"], f, better))
            made = list(zip(*rows)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)], names)

    return joined.mapInArrow(run, "doc_id string, window_index int, window_start int, window_end int, faults array<string>, better_end int")
