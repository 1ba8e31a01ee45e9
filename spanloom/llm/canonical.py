"""Mapping freely typed values to the entries of a reference list (problem 4).

A BK-tree holds the entries' keys (their letters and digits in one form) under the unrestricted Damerau-Levenshtein
distance, which is a true metric; the triangle inequality prunes every subtree whose edge differs from the query's
distance by more than the threshold, so a search returns every entry within it.

A value is looked up, in this order: as it stands (key equal, also of parts turned around a comma); as a plural; word by word
with abbreviations; as the longest run of its words that is an entry (what is left is packaging such as a vendor, a version or a
legal form), unless the tree has a longer name that differs in misspelt words only; by the tree; with Roman numbers in digits.
The best distance wins; entries of different ids at the same best distance leave the value unmatched,
and so does a difference in its numbers.

A list of up to ``BROADCAST_ENTRIES`` names is built into one tree per worker and the rows are mapped where they lie,
without a shuffle (a worker remembers what it has looked up).  A longer list is cut into shards by id: the distinct
values, in parts of about ``PART_VALUES``, meet each shard once, every shard tells what it has for each rule, and the rules are
applied once to all of it, so both ways give the same.

Defined results.  Null, empty and sentinel values (``not_stated``, ``no_statement``) are not looked up.  Blank values and
values without letters or digits mean none (id 0).  Repeated rows give one row.  Null and repeated names of the list are ignored.
An empty list leaves everything unmatched; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import nlargest

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.lookalikes import same_form
from spanloom.plans.lineage import cut

SENTINELS = ("", "not_stated", "no_statement")
BROADCAST_ENTRIES, PART_VALUES = 100_000, 20_000
#: Small numbers in Roman letters, which a list may have in digits.
ROMAN = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x"]
_REMEMBERED = 200_000
WHOLE, PLURAL, SHORT, RUN, NEAR, NUMERAL, LONGER = range(7)  # rules in their order; the last is an exception to the run
_WORD = re.compile(r"[^\W_]+\.?")


def distance(a: str, b: str, most: int | None = None) -> int:
    """Unrestricted Damerau-Levenshtein distance: insert, delete, replace, swap neighbours; a metric.

    With ``most``, any greater figure may come out for a distance above it: no way to the end costs less than a row's
    least entry, not even a swap across the row, so the rows end there.
    """
    if a == b:
        return 0
    last: dict[str, int] = {}
    top = len(a) + len(b)
    rows = [[top] * (len(b) + 2), [top, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, seen, above = [top, i], 0, rows[i]
        for j, y in enumerate(b, 1):
            k = last.get(y, 0)
            cost = above[j] + (x != y)
            if above[j + 1] + 1 < cost:
                cost = above[j + 1] + 1
            if row[j] + 1 < cost:
                cost = row[j] + 1
            swap = rows[k][seen] + (i - k - 1) + 1 + (j - seen - 1)
            if swap < cost:
                cost = swap
            if x == y:
                seen = j
            row.append(cost)
        if most is not None and min(row) > most:
            return most + 1
        rows.append(row)
        last[x] = i
    return rows[-1][-1]


def letters(key: str) -> int:
    """The characters of ``key`` as bits, by class of 61: one for a first, another for a second of a class.

    An edit adds or takes away one character at most, so the bits that only one of two keys has are no more than their distance.
    """
    once = twice = 0
    for c in key:
        bit = 1 << ord(c) % 61
        twice |= once & bit
        once |= bit
    return once | twice << 61


class BKTree:
    """Keys under :func:`distance`, each below the edge of its distance from its pivot; few keys of an edge stay a list."""

    LEAF = 48

    def __init__(self, keys: Iterable[str]) -> None:
        self.root = self._grow(list(dict.fromkeys(keys)))

    def _grow(self, keys: list[str]) -> tuple | None:
        """(pivot, its letters, greatest edge of its subtrees, edge -> subtree, [(edge, key, letters)])."""
        if not keys:
            return None
        edges: dict[int, list[str]] = {}
        for key in keys[1:]:
            edges.setdefault(distance(keys[0], key), []).append(key)
        below = {e: self._grow(ks) for e, ks in edges.items() if len(ks) > self.LEAF}
        listed = [(e, k, letters(k)) for e, ks in edges.items() if len(ks) <= self.LEAF for k in ks]
        return keys[0], letters(keys[0]), max(edges, default=0), below, listed

    def within(self, query: str, limit: int) -> list[tuple[int, str]]:
        """Every (distance, key) with distance <= limit."""
        found, todo, own = [], [self.root] if self.root else [], letters(query)
        while todo:
            pivot, bits, far, below, listed = todo.pop()
            if max((own & ~bits).bit_count(), (bits & ~own).bit_count()) > limit + far:
                continue  # further from the pivot than any key below it could be
            d = distance(query, pivot, limit + far)
            if d <= limit:
                found.append((d, pivot))
            low, high = d - limit, d + limit
            for edge, key, bits in listed:
                if low <= edge <= high and (own & ~bits).bit_count() <= limit and (bits & ~own).bit_count() <= limit:
                    near = distance(query, key, limit)
                    if near <= limit:
                        found.append((near, key))
            todo += [child for edge, child in below.items() if low <= edge <= high]
        return found


def allowed(length: int) -> int:
    """The greatest distance at which a key of ``length`` characters may still be meant."""
    return 0 if length < 4 else 1 if length < 6 else 2 if length < 12 else 3


def words(value: str) -> list[str]:
    """The words of a value in one form; a trailing full stop stays, as it may mark an abbreviation."""
    text = re.sub(r"(?<=\d),(?=\d{3}(?!\d))", "", same_form(value).casefold())
    return _WORD.findall(re.sub(r"(?<=\w)\s?\+(?!\w)", " plus", text))


def _key(parts: list[str]) -> str:
    return "".join(parts).replace(".", "")


def _digits(key: str) -> str:
    return "".join(re.findall(r"\d", key))


def _abbreviates(part: str, word: str) -> bool:
    """Is ``part`` the word, or cut from it: with a full stop, or as three or more of its consonants?"""
    bare = part.rstrip(".")
    if bare == word:
        return True
    letters = iter(word)
    if not bare or len(bare) >= len(word) or bare[0] != word[0] or not all(x in letters for x in bare):
        return False
    return part[-1] == "." or len(bare) > 2 and bare[-1] == word[-1] and not set(bare) & set("aeiou")


def _misspells(part: str, word: str) -> bool:
    part = part.rstrip(".")
    return part == word or distance(part, word) <= (0 if len(word) < 2 else 1 if len(word) < 4 else 2) < len(part)


def decide(hits: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The (rank, distance, id) that the hits of a whole list mean, id 0 for none."""
    by: dict[int, list[tuple[int, int]]] = {}
    for rule, size, number in hits:
        by.setdefault(rule, []).append((size, number))
    top = {rule: {n for size, n in of if size == max(of)[0]} for rule, of in by.items()}
    for rule in (WHOLE, PLURAL, SHORT):
        if len(top.get(rule, ())) == 1:
            return rule, 0, top[rule].pop()
    if RUN in by:
        # a name that contains the run wins over it if it differs in misspelt words only
        size = max(by[RUN])[0]
        ids = {n for length, n in by.get(LONGER, ()) if length > size} or top[RUN]
        return (RUN, -size, ids.pop()) if len(ids) == 1 else Index.NONE
    if len(top.get(NEAR, ())) == 1:
        return NEAR, -max(by[NEAR])[0], top[NEAR].pop()
    if len(top.get(NUMERAL, ())) == 1:
        return NUMERAL, 0, top[NUMERAL].pop()
    return Index.NONE


class Index:
    """The names of one value set; :meth:`best` gives (rank, distance, id), id 0 for none.

    The tree is one for each length and each row of digits: an entry meant has the value's digits, and lengths differ by no
    more than the distance.  Names are found by the initials of their words (abbreviations) and by their id (misspelt words).
    """

    NONE = (9, 0, 0)

    def __init__(self, names: list[tuple[int, str]]) -> None:
        self.ids: dict[str, set[int]] = {}
        self.initials: dict[str, list[tuple[int, list[str]]]] = {}
        self.named: dict[int, list[list[str]]] = {}
        for number, name in names:
            parts = words(name)
            if parts:
                self.ids.setdefault(_key(parts), set()).add(number)
                bare = [p.rstrip(".") for p in parts]
                self.initials.setdefault("".join(p[0] for p in bare), []).append((number, bare))
                self.named.setdefault(number, []).append(bare)
        by: dict[tuple[str, int], list[str]] = {}
        for key in sorted(self.ids):
            by.setdefault((_digits(key), len(key)), []).append(key)
        self.trees = {k: BKTree(keys) for k, keys in by.items()}
        self.longest = max(map(len, self.ids), default=0)
        self.known: dict[str, tuple[int, int, int]] = {}

    def best(self, value: str) -> tuple[int, int, int]:
        out = self.known.get(value)
        if out is None:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            out = self.known[value] = self._best(value)
        return out

    def _best(self, value: str) -> tuple[int, int, int]:
        return decide(self.hits(value, alone=True))

    def near(self, key: str) -> Iterator[tuple[int, str]]:
        """Every (distance, key) that may be meant by ``key``."""
        limit, digits = allowed(len(key) + 1), _digits(key)
        for length in range(len(key) - limit, len(key) + limit + 1):
            tree = self.trees.get((digits, length))
            if tree:
                yield from ((d, hit) for d, hit in tree.within(key, limit) if d <= allowed(length))

    def hits(self, value: str, alone: bool = False) -> list[tuple[int, int, int]]:
        """(rule, size, id): for each rule the two ids of greatest size, which is enough to tell the best and a tie.

        The size is a run's or longer name's length, or the distance below 0.  ``alone``: this is the whole list, and what
        an earlier rule has settled needs no later one.  Else an id has all its names here.
        """
        parts = words(value)
        turns = [parts]
        if len(halves := value.split(",")) == 2:
            turns.append(words(halves[1]) + words(halves[0]))
        by: dict[int, dict[int, int]] = {rule: {} for rule in (WHOLE, PLURAL, SHORT, RUN, NEAR, NUMERAL, LONGER)}

        def told() -> list[tuple[int, int, int]]:
            return [(rule, size, n) for rule, of in by.items() for size, n in nlargest(2, ((size, n) for n, size in of.items()))]

        by[WHOLE] = {n: 0 for t in turns for n in self.ids.get(_key(t), ())}
        if alone and len(by[WHOLE]) == 1:
            return told()
        if (whole := _key(parts))[-2:].isalpha() and whole.endswith("s"):
            by[PLURAL] = dict.fromkeys(self.ids.get(whole[:-1], ()), 0)
            if alone and len(by[PLURAL]) == 1:
                return told()
        initials = "".join(p[0] for p in parts)
        by[SHORT] = {n: 0 for n, name in self.initials.get(initials, ()) if all(map(_abbreviates, parts, name))}
        if alone and len(by[SHORT]) == 1:
            return told()
        for i in range(len(parts)):
            key = ""
            for part in parts[i:]:
                key += part.rstrip(".")
                if len(key) > self.longest:
                    break
                for n in self.ids.get(key, ()):
                    by[RUN][n] = max(len(key), by[RUN].get(n, 0))
        sizes: dict[int, int] = {}
        for key in dict.fromkeys(map(_key, turns)):
            for d, hit in self.near(key):
                for n in self.ids[hit]:
                    by[NEAR][n] = max(-d, by[NEAR].get(n, -d))
                    sizes[n] = max(len(hit), sizes.get(n, 0))
        if sizes and (by[RUN] or not alone):
            by[LONGER] = {n: size for n, size in sizes.items() if any(len(name) == len(parts) and all(map(_misspells, parts, name)) for name in self.named[n])}
        roman = ["".join(str(ROMAN.index(p) + 1) if p in ROMAN else p) for p in parts]
        if roman != parts:
            by[NUMERAL] = dict.fromkeys(self.ids.get(_key(roman), ()), 0)
        return told()


def _names(reference: DataFrame) -> DataFrame:
    """(value_set, canonical_id, name) of every accepted name."""
    return reference.select("value_set", "canonical_id", F.explode(F.array_compact(F.array_append(F.coalesce("known_as", F.array().cast("array<string>")), F.col("canonical_form")))).alias("name")).distinct()


@lru_cache(maxsize=2)
def _indexes(rows: tuple[tuple[str, int, str], ...]) -> dict[str, Index]:
    """The trees of a list, built once per worker."""
    by: dict[str, list[tuple[int, str]]] = {}
    for value_set, number, name in sorted(rows):
        by.setdefault(value_set, []).append((number, name))
    return {k: Index(v) for k, v in by.items()}


def typed_values(records: DataFrame, value_sets: list[str]) -> DataFrame:
    """(record_id, value_set, value) of every value to be looked up."""
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("value_set"), F.col("attributes")[v].alias("value")) for v in value_sets]))
    out = records.select("record_id", pairs.alias("p")).select("record_id", "p.value_set", "p.value")
    return out.where(F.col("value").isNotNull() & ~F.col("value").isin(*SENTINELS))


def map_values(values: DataFrame, reference: DataFrame, shards: int | None = None) -> DataFrame:
    """``values`` (any columns with value_set, value) plus canonical_id (replaced if there), 0 where the value means none."""
    values = values.drop("canonical_id")
    names = _names(reference)
    if shards is None:
        n = names.count()
        shards = 0 if n <= BROADCAST_ENTRIES else -(-n // BROADCAST_ENTRIES)
    if shards:
        return _map_sharded(values, names, shards)
    rows = values.sparkSession.sparkContext.broadcast(tuple(sorted(tuple(r) for r in names.collect())))
    columns = values.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _indexes(rows.value)
        for batch in batches:
            sets, typed = (batch.column(columns.index(c)).to_pylist() for c in ("value_set", "value"))
            ids = [index[s].best(v)[2] if v is not None and s in index else 0 for s, v in zip(sets, typed)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], [*columns, "canonical_id"])

    return values.mapInArrow(run, values.withColumn("canonical_id", F.lit(0).cast("long")).schema)


def _map_sharded(values: DataFrame, names: DataFrame, shards: int) -> DataFrame:
    """Every distinct value meets every shard of the list; the rules are applied to the hits of all shards."""
    shard = F.pmod(F.xxhash64("value_set", "canonical_id"), F.lit(shards))
    asked = cut(values.where("value IS NOT NULL").select("value_set", "value").distinct())
    parts = max(1, -(-asked.count() // PART_VALUES))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = asked.withColumn("shard", upto(shards)).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    held = names.withColumn("shard", shard).withColumn("part", upto(parts))

    def meet(query: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        index = _indexes(tuple(entry[["value_set", "canonical_id", "name"]].itertuples(index=False, name=None)))
        hits = [(s, v, *h) for s, v in zip(query["value_set"], query["value"]) if s in index for h in index[s].hits(v)]
        return pd.DataFrame(hits, columns=["value_set", "value", "rule", "size", "canonical_id"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [decide([(h["rule"], h["size"], h["canonical_id"]) for h in hits])[2] for hits in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.int64())], ["value_set", "value", "canonical_id"])

    met = asked.groupBy("shard", "part").cogroup(held.groupBy("shard", "part")).applyInPandas(meet, "value_set string, value string, rule int, size int, canonical_id long")
    hits = met.groupBy("value_set", "value").agg(F.collect_list(F.struct("rule", "size", "canonical_id")).alias("hits"))
    won = hits.mapInArrow(settle, "value_set string, value string, canonical_id long")
    return values.join(won, ["value_set", "value"], "left").select(*values.columns, F.coalesce("canonical_id", F.lit(0).cast("long")).alias("canonical_id"))


def respelt(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(record_id, value_set, canonical_id): every value not spelt exactly as a canonical form of its set."""
    exact = F.broadcast(reference.select("value_set", F.col("canonical_form").alias("value")).distinct()) if reference.count() <= BROADCAST_ENTRIES else reference.select("value_set", F.col("canonical_form").alias("value")).distinct()
    return map_values(values.join(exact, ["value_set", "value"], "left_anti"), reference).select("record_id", "value_set", "canonical_id").distinct()
