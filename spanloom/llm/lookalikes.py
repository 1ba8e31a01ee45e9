"""One form for text that looks the same but differs in its characters (problem 3).

The form is NFC, with: format characters of no width removed; every blank of one character a plain space; full- and
half-width forms, non-breaking hyphens, typographic ligatures and the micro sign in their ordinary characters; Greek and
Cyrillic letters that look like Latin ones as those.  Case, words, digits, raised digits and accents stay apart.

A quick check isolates the unstable segments: a run of characters that are not stable in the form (they change, or
may join with what stands before them) together with the stable character before the run, which is its boundary context.
Only these segments are rewritten and spliced into the untouched text; a text without unstable characters is returned as
it is after one scan.

Defined results.  Null: null.  Empty: empty.  Texts of any length are handled whole.  The form is idempotent.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Letters of other scripts shown like a Latin letter, and the Latin letters in the same order.
CYRILLIC, CYRILLIC_AS = "АВЕКМНОРСТХІЅЈУԌԚԜҺаеорсухіѕјһԁԛԝӏ", "ABEKMHOPCTXISJYGQWhaeopcyxisjhdqwl"
GREEK, GREEK_AS = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧον", "ABEZHIKMNOPTYXov"
#: Other characters shown like one or more ordinary ones.
OTHER = {"‐": "-", "‑": "-", "µ": "μ", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
#: Characters of no width that are not of the general category Cf.
NO_WIDTH = "͏ᅟᅠ឴឵ㅤﾠ"

#: Blocks of characters that are all stable in the form (ideographs, syllables, surrogates, private use, unassigned).
STABLE = [(0x3400, 0x4DBF), (0x4E00, 0xA48C), (0xAC00, 0xD7A3), (0xD800, 0xF8FF), (0x17000, 0x1AFFF), (0x20000, 0x2F7FF), (0x2FA20, 0xE0000), (0xE01F0, 0x10FFFF)]


@lru_cache(maxsize=1)
def _tables() -> tuple[dict[int, str], re.Pattern, frozenset[str]]:
    """The folding of single characters, the pattern of a run of unstable ones, and those characters."""
    fold = {ord(a): b for a, b in [*zip(CYRILLIC, CYRILLIC_AS), *zip(GREEK, GREEK_AS), *OTHER.items()]}
    unstable = set()
    for code in chain.from_iterable(range(a, b) for a, b in zip([0, *(b + 1 for _, b in STABLE)], [a for a, _ in STABLE])):
        ch = chr(code)
        kind = unicodedata.category(ch)
        if kind in ("Cn", "Co"):
            continue
        if kind == "Cf" or ch in NO_WIDTH or 0xFE00 <= code <= 0xFE0F:
            fold[code] = ""
        elif kind in ("Zs", "Zl", "Zp") and ch != " " or ch in "\t\n\v\f\r\x85":
            fold[code] = " "
        else:
            parts = unicodedata.decomposition(ch).split()
            if parts and parts[0] in ("<wide>", "<narrow>"):
                fold.setdefault(code, "".join(chr(int(x, 16)) for x in parts[1:]))
            if parts and parts[0][0] != "<" and len(parts) == 2 and unicodedata.is_normalized("NFC", ch):
                unstable.add(int(parts[1], 16))  # may join with the character before it
            if unicodedata.combining(ch) or not unicodedata.is_normalized("NFC", ch):
                unstable.add(code)
    unstable |= set(fold) | set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    runs, start, last = [], None, None
    for code in sorted(unstable):
        if last is None or code != last + 1:
            runs.append([code, code])
        runs[-1][1] = last = code
    inside = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" if a != b else re.escape(chr(a)) for a, b in runs)
    return fold, re.compile(f"[{inside}]+"), frozenset(map(chr, unstable))


def same_form(text: str | None) -> str | None:
    """The one form of ``text``."""
    if not text or text.isascii() and not re.search(r"[\t\n\v\f\r]", text):
        return text
    fold, unstable, characters = _tables()
    if characters.isdisjoint(text):
        return text
    out, at, found = [], 0, unstable.search(text)
    while found:
        start = max(at, found.start() - 1)  # with its boundary context
        out += text[at:start], unicodedata.normalize("NFC", text[start : found.end()].translate(fold))
        at = found.end()
        found = unstable.search(text, at)
    return "".join(out) + text[at:]


def in_one_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``NAME_form`` for each of ``columns`` (a column of that name is replaced); no shuffle."""
    df = df.drop(*[f"{c}_form" for c in columns])
    schema = df.select("*", *[F.col(c).alias(f"{c}_form") for c in columns]).schema
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = [pa.array([same_form(x) for x in batch.column(names.index(c)).to_pylist()], pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*names, *(f"{c}_form" for c in columns)])

    return df.mapInArrow(run, schema)


def quoted_stretches(records: DataFrame, parsed: DataFrame) -> DataFrame:
    """(record_id, source_quote, stretch): the stretch of its document's text each quotation names, by code points.

    Positions are half-open; a stretch reaching past the text is what there is of it; a null or negative position or an
    end before the start is left out, as is a document without text.  Repeated records give repeated rows.  One join by
    document; where one document has very many records, adaptive execution splits their side of it.
    """
    asked = records.where("doc_id IS NOT NULL AND source_quote IS NOT NULL AND char_start >= 0 AND char_end >= char_start")
    asked = asked.select("record_id", "doc_id", "source_quote", "char_start", "char_end")
    texts = parsed.where("text IS NOT NULL").select("doc_id", "text")
    return asked.join(texts, "doc_id").select(
        "record_id", "source_quote", F.expr("substring(text, char_start + 1, char_end - char_start)").alias("stretch")
    )
