"""Encoding texts with a public byte-level BPE vocabulary (problem 7).

A text is cut by the vocabulary's pattern; each piece's bytes are merged with a segment tree over the ranks of adjacent
pairs: the root holds the leftmost pair of lowest rank, a merge changes two neighbouring leaves, and each change climbs
the tree in logarithmic time.  A piece of n bytes thus costs O(n log n), also when a text is one long run.  Short pieces
are remembered, within a bound, per worker.

The vocabulary file is a parameter; the driver reads it once and ships its bytes, whose size the vocabulary fixes (under
1 MB here, refused above ``MAX_VOCABULARY_BYTES``).

Defined results.  Null text and empty text: the empty list.  Strings that look like special tokens are ordinary text.
Whole texts are encoded, however long.  Repeated rows give repeated results.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
MAX_VOCABULARY_BYTES = 64_000_000
#: Fixed value: the pattern the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_REMEMBERED, _SHORT = 200_000, 64
_NONE = 1 << 62


def merge_ranks(piece: bytes, rank_of: Callable[[bytes], int | None]) -> list[bytes]:
    """The parts that remain of ``piece`` when the leftmost pair of lowest rank is merged until none has a rank."""
    n = len(piece)
    if n < 2:
        return [piece] if n else []
    width = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [_NONE] * (2 * width)
    shift = width.bit_length()

    def key(i: int, left: bytes, right: bytes) -> int:
        rank = rank_of(left + right)
        return _NONE if rank is None else rank << shift | i

    for i in range(n - 1):
        tree[width + i] = key(i, piece[i : i + 1], piece[i + 1 : i + 2])
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b

    def put(i: int, value: int) -> None:
        k = width + i
        tree[k] = value
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                return
            tree[k] = least

    # part i begins at byte i and ends where the next part begins
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    mask = (1 << shift) - 1
    while (least := tree[1]) != _NONE:
        i = least & mask
        j = after[i]
        k = after[j]
        after[i] = k
        put(j, _NONE) if j < n - 1 else None
        if k < n:
            before[k] = i
            put(i, key(i, piece[i:k], piece[k : after[k]]))
        else:
            put(i, _NONE)
        p = before[i]
        if p >= 0:
            put(p, key(p, piece[p:i], piece[i:k]))
    out, i = [], 0
    while i < n:
        out.append(piece[i : after[i]])
        i = after[i]
    return out


class Encoder:
    """Ids of texts by one rank file."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def piece(self, text: str) -> tuple[int, ...]:
        raw = text.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        ids = (whole,) if whole is not None else tuple(self.ranks[x] for x in merge_ranks(raw, self.ranks.get))
        if len(text) <= _SHORT:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            self.known[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        known, out = self.known, []
        for x in self.split(text or ""):
            out.extend(known.get(x) or self.piece(x))
        return out


@lru_cache(maxsize=2)
def _encoder(ranks: bytes) -> Encoder:
    return Encoder(ranks)


def _vocabulary(df: DataFrame, path: str):
    raw = Path(path).read_bytes()
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(raw)


def encode(df: DataFrame, id_col: str, text_col: str, path: str = f"{TOKENIZERS}/{VOCABULARY}", counts_only: bool = False) -> DataFrame:
    """(id_col, ids array<int>) of every row, or (id_col, n_tokens int) with ``counts_only``; no shuffle."""
    ranks = _vocabulary(df, path)
    kind = df.schema[id_col].dataType.simpleString()
    value = "n_tokens int" if counts_only else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(ranks.value)
        for batch in batches:
            ids = (own.encode(t) for t in batch.column(1).to_pylist())
            made = pa.array(map(len, ids), pa.int32()) if counts_only else pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), made], [id_col, value.split()[0]])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, {value}")
