"""Best representative of each duplicate group of publications (problem 1).

* **Groups.** The links told by ``merged_from`` are closed by :func:`spanloom.llm.components.components`; rows take the component of
  their work, and everything per group is an aggregate whose states are combined in each task before they are shuffled.
* **Quality of the sources.** A *source* is the kind of harvest a row came from: preprint flag x availability, at most 21, in
  the stored order of trust.  A *fact* is (group, field, value) of a field in which the group's rows differ.  A source claims
  the values its rows give and denies the group's others.  Harvests of one version (published, unknown, preprint) are not
  independent witnesses, so each version has one vote a field, divided among its rows that fill it.
  Expectation-maximisation over the facts of all groups learns each source's sensitivity (true values it gives) and
  specificity (false values it withholds): of a single-valued field exactly one value of a group is true, the values of a
  multi-valued one are true or false each for itself.  A field's figures are shrunk to the source's over all fields, and both are
  held to the order of trust (isotonic regression), so a much harvested preprint can't turn the published version wrong.
  Fields in which a group agrees count as true claims.  Facts are reduced to patterns (who claims, who denies, how often), so a
  round is one small aggregate and only the at most 21 x fields sums reach the driver.
* **Survivor.** The row of the most trusted source by the learnt quality, then the highest version, the latest snapshot and
  the smallest row.  As the quality keeps to the stored order, this is the stored order's first row.
* **Fields.** What tells the version apart (flag, availability, version, snapshot) is the survivor's, or where null that of the next row in
  order; it defines the sources and is no fact.  Other single-valued fields take the value of highest posterior (then newest),
  multi-valued ones keep every value judged true; ``merged_from`` tells links, of which none is dropped.

Values are compared by 64-bit hashes of their one spelling within their group and field, so the texts stay behind until the
records are built; titles that differ in case only are one value and come out as the last of them in order of text.

Defined results.  Null ``doc_id``: the row is a work of its own, linked only by its ``merged_from``; without a ``row_id`` too it is left out.  Null or empty
``merged_from``, ids that repeat or that no row carries, and a row naming itself link nothing.  Repeated rows count as
claims again and never change the groups.  Ties end at the smallest ``row_id`` (rows) or the greatest hash (values).  Null
and blank values claim nothing; a field that no row fills is null.  An empty table gives empty results.  Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.components import components
from spanloom.plans.lineage import cut

#: Availability from best to worst, as the stored order has it.
AVAILABILITY = ["fulltext", "abstract_only", "preprint_requester_pays_pending", "unavailable", "unresolved"]
#: Names of months as dates have them.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

#: Told by the survivor, in this order of columns.
VERSION = ["is_preprint", "oa_status", "source_version", "snapshot_date"]
SINGLE = ["doc_type", "community", "pmid", "pmcid", "doi", "title", "pub_date", "venue", "group_key", "author_overlap", "n_shared_authors", "abstract"]
MULTI = ["author_ids", "institution_ids", "shared_author_ids", "merged_from"]
FIELDS = [*SINGLE, *MULTI]
FAMILIES = ["published", "unknown", "preprint"]
N_STATUS = len(AVAILABILITY) + 2  # the known ones, another, none
N_SOURCES = len(FAMILIES) * N_STATUS

MAX_SENT_LINKS = 200_000  # linked works (two short strings each) that are broadcast
_ROUNDS = 6
#: Before any fact is seen: (sensitivity, specificity) by version, and how many votes that belief weighs.
_BELIEF = [(0.97, 0.99), (0.70, 0.80), (0.60, 0.80)]
_BELIEF_VOTES, _FIELD_VOTES = 20.0, 20.0
_LEAST, _MOST = 0.02, 0.995


def _let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``c``, which is computed once however often ``f`` names it (and keeps the generated code small)."""
    return F.get(F.transform(F.array(c), lambda x: f(x)), F.lit(0))


def plain(c: Column) -> Column:
    """Text without format characters, blank ends removed, runs of blanks as one space; null if nothing remains."""
    narrow = F.octet_length(c) == F.length(c)  # the common case: ASCII with single spaces, told without a pattern
    tidy = narrow
    for x in ("  ", "\t", "\n", "\x0b", "\f", "\r"):
        tidy = tidy & ~F.contains(c, F.lit(x))
    shown = F.when(narrow, c).otherwise(F.translate(F.regexp_replace(c, r"\p{Cf}+", ""), "０１２３４５６７８９", "0123456789"))
    odd = c.rlike(r"[\p{Cf}０-９]|[\s\p{Z}&&[^ ]]|  ")
    return F.nullif(F.trim(F.when(tidy, c).when(~odd, c).otherwise(F.regexp_replace(shown, r"[\s\p{Z}&&[^ ]][\s\p{Z}]*| [\s\p{Z}]+", " "))), F.lit(""))


def work_key(c: Column) -> Column:
    """One spelling of a work id: ``W`` and its digits for the usual form (any case, wrapping, path or missing ``W``)."""
    def key(p: Column) -> Column:
        digits = F.regexp_extract(p, r"(?i)(?:^|[^0-9a-z])w?\s?([0-9]+)[^0-9a-z]*$", 1)
        return F.when(p.rlike("^W[0-9]+$"), p).otherwise(_let(digits, lambda d: F.when(d != "", F.concat(F.lit("W"), d)).otherwise(F.lower(p))))

    return _let(plain(c), key)


def _place(c: Column) -> Column:
    """The availability's place in the order of trust: the known ones, another, none."""
    letters = F.regexp_replace(F.lower(c), "[^a-z]", "")
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(n.replace("_", "")) for n in AVAILABILITY]), letters), F.lit(0)), F.lit(N_STATUS - 1)).cast("int") - 1
    return F.when(c.isNull(), F.lit(N_STATUS - 1)).otherwise(place)


def status_name(c: Column) -> Column:
    """The availability in its stored spelling; null when it is none of them."""
    return F.get(F.array(*map(F.lit, AVAILABILITY)), _place(c))


def version_number(c: Column) -> Column:
    """The first number in a version, as a double; null without one."""
    return F.nullif(F.regexp_extract(plain(c), r"([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).cast("double")


def day_number(c: Column) -> Column:
    """A date in any of the delivered spellings as the integer yyyymmdd; null when it is none."""
    def day(p: Column) -> Column:
        month = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(p, r"([a-z]{3})", 1)), F.lit(0))
        spelt = F.right(p, F.lit(4)).cast("int") * 10_000 + month * 100 + F.regexp_extract(p, "([0-9]{1,2})", 1).cast("int")
        named = p.rlike(r"^(?:[0-9]{1,2}\.? [a-z]+\.?,?|[a-z]+\.? [0-9]{1,2},?) [0-9]{4}$")
        iso = F.regexp_extract(p, r"^[0-9]{4}[-/. ]?[0-9]{2}[-/. ]?[0-9]{2}(?![0-9])", 0)
        return F.when(named, spelt).otherwise(F.nullif(F.translate(iso, "-/. ", ""), F.lit("")).cast("int")).cast("int")

    return _let(F.lower(plain(c)), day)


def _family() -> Column:
    return F.when(~F.col("is_preprint"), 0).when(F.col("is_preprint"), 2).otherwise(1)


def _source() -> Column:
    """The row's source by its place in the stored order of trust."""
    return _family() * N_STATUS + _place(F.col("oa_status"))


def source_name(source: int) -> str:
    return f"{FAMILIES[source // N_STATUS]}/{[*AVAILABILITY, 'other', 'none'][source % N_STATUS]}"


def _spelling(field: str, c: Column) -> Column:
    """The form in which values of a field are compared and delivered."""
    if field in MULTI:
        form = work_key if field == "merged_from" else plain
        return F.array_distinct(F.array_compact(F.transform(c, lambda x: form(x))))
    if field in ("pub_date", "snapshot_date"):
        iso = lambda d: F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))
        return _let(F.lpad(day_number(c).cast("string"), 8, "0"), lambda d: F.when(d.isNotNull(), iso(d)))
    if field == "oa_status":
        return status_name(c)
    if field == "doi":
        return F.regexp_replace(F.lower(plain(c)), r"^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    if field == "source_version":
        number = _let(version_number(c), lambda n: F.when(n == F.floor(n), F.floor(n).cast("string")).otherwise(n.cast("string")))
        return F.coalesce(number, F.lower(plain(c)))
    return plain(c.cast("string"))


def _key(field: str) -> Column:
    """What a field's value is compared by, null where the row does not fill it; of a list, of all its values."""
    value = _spelling(field, F.col(field))
    if field in MULTI:
        return _let(value, lambda v: F.when(F.size(v) > 0, F.xxhash64(F.array_sort(v))))
    return _let(F.lower(value) if field == "title" else value, lambda v: F.when(v.isNotNull(), F.xxhash64(v)))


def _work() -> Column:
    return F.coalesce(work_key(F.col("doc_id")), F.concat(F.lit("row:"), F.col("row_id").cast("string")))


def prepared(pubs: DataFrame) -> DataFrame:
    """The rows without their texts, made once: work, source, version, day, named works, and the hashes of all values."""
    lists = F.array(*[F.transform(_spelling(f, F.col(f)), lambda x: F.xxhash64(x)) for f in MULTI])
    return cut(pubs.select(
        _work().alias("_work"), "row_id", _source().alias("source"), F.coalesce(version_number(F.col("source_version")), F.lit(-1.0)).alias("version"),
        F.coalesce(day_number(F.col("snapshot_date")), F.lit(0)).alias("day"), _spelling("merged_from", F.col("merged_from")).alias("named"),
        F.array(*map(_key, FIELDS)).alias("keys"), lists.alias("lists")).where("_work IS NOT NULL"))


def work_components(rows: DataFrame) -> DataFrame:
    """(work, component) of every work that is linked to another loaded work."""
    works = rows.select(F.col("_work").alias("named")).distinct()
    told = rows.select("_work", F.explode("named").alias("named"))
    told = told.where("_work <> named").distinct().join(works, "named", "left_semi")
    return components(told, "_work", "named").withColumnsRenamed({"node": "_work"})


def with_component(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """The rows with their group; a work without links is its own.

    Only linked works are looked up: up to ``MAX_SENT_LINKS`` of them are sent to the rows where they lie, more are joined by
    work, where adaptive execution splits the rows of a hot one.
    """
    side = F.broadcast(linked) if linked.count() <= MAX_SENT_LINKS else linked
    return rows.join(side, "_work", "left").withColumn("component", F.coalesce("component", "_work"))


def group_heads(rows: DataFrame) -> DataFrame:
    """Per group: smallest row, rows, and for every field whether its rows differ and how many of each version fill it."""
    key = lambda i: F.get(F.col("keys"), F.lit(i))
    family = F.floor(F.col("source") / N_STATUS)
    spread = [x for i in range(len(FIELDS)) for x in (F.min(key(i)).alias(f"lo{i}"), F.max(key(i)).alias(f"hi{i}"))]
    filled = [F.sum(F.when(key(i).isNotNull() & (family == k), 1).otherwise(0)).alias(f"n{i}_{k}") for i in range(len(FIELDS)) for k in range(len(FAMILIES))]
    per = rows.groupBy("component").agg(F.min("row_id").alias("group_row"), F.count(F.lit(1)).alias("n_rows"), *spread, *filled)
    fills = F.array(*[F.array(*[F.col(f"n{i}_{k}") for k in range(len(FAMILIES))]) for i in range(len(FIELDS))])
    return per.select("component", "group_row", "n_rows", F.array(*[F.coalesce(F.col(f"lo{i}") != F.col(f"hi{i}"), F.lit(False)) for i in range(len(FIELDS))]).alias("differs"), fills.alias("fills"))


def members(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """The rows of groups of two or more: what each claims where its group differs, and its votes where it agrees."""
    joined = rows.join(heads.where("n_rows > 1"), "component")
    family = F.floor(F.col("source") / N_STATUS).cast("int")
    key = [F.get(F.col("keys"), F.lit(i)) for i in range(len(FIELDS))]
    vote = [F.lit(1.0) / F.get(F.get(F.col("fills"), F.lit(i)), family) for i in range(len(FIELDS))]
    differs = [F.get(F.col("differs"), F.lit(i)) for i in range(len(FIELDS))]
    one = [F.when(differs[i] & key[i].isNotNull(), F.struct(F.lit(i).alias("field"), key[i].alias("key"), vote[i].alias("vote"))) for i in range(len(SINGLE))]
    many = [F.when(differs[i] & key[i].isNotNull(), F.struct(F.lit(i).alias("field"), F.get(F.col("lists"), F.lit(i - len(SINGLE))).alias("keys"), vote[i].alias("vote"))) for i in range(len(SINGLE), len(FIELDS))]
    agreed = [F.when(~differs[i] & key[i].isNotNull(), vote[i]).otherwise(0.0) for i in range(len(FIELDS))]
    return cut(joined.select("group_row", "row_id", "source", "version", "day", F.array_compact(F.array(*one)).alias("one"), F.array_compact(F.array(*many)).alias("many"), F.array(*agreed).alias("agreed")))


def _by_source() -> list[Column]:
    return [F.sum(F.when(F.col("source") == s, F.col("vote")).otherwise(0.0)).alias(f"s{s}") for s in range(N_SOURCES)]


def _votes(prefix: str = "s") -> Column:
    """The votes of the sources that have any; rounded, so that equal shares are equal patterns."""
    return F.filter(F.array(*[F.struct(F.lit(s).alias("source"), F.round(f"{prefix}{s}", 6).alias("n")) for s in range(N_SOURCES)]), lambda v: v["n"] > 0)


def single_facts(rows: DataFrame) -> DataFrame:
    """(group_row, field, key, votes, newest) of single-valued fields in which a group differs."""
    told = rows.select("group_row", "source", "day", F.explode("one").alias("c")).select("group_row", "source", "day", "c.*")
    return cut(told.groupBy("group_row", "field", "key").agg(F.max("day").alias("newest"), *_by_source()).select("group_row", "field", "key", "newest", _votes().alias("votes")))


def multi_facts(rows: DataFrame) -> DataFrame:
    """(group_row, field, key, votes) of multi-valued fields in which a group differs, with claims and denials."""
    told = rows.select("group_row", "source", F.explode("many").alias("c")).select("group_row", "source", "c.*")
    cover = told.groupBy("group_row", "field").agg(*_by_source()).select("group_row", "field", _votes().alias("cover"))
    said = told.select("group_row", "source", "field", "vote", F.explode("keys").alias("key")).groupBy("group_row", "field", "key").agg(*_by_source())
    said = said.select("group_row", "field", "key", F.array(*[F.round(f"s{s}", 6) for s in range(N_SOURCES)]).alias("said"))
    given = lambda v: F.get(F.col("said"), v["source"])
    votes = F.transform("cover", lambda v: F.struct(v["source"].alias("source"), given(v).alias("pos"), F.greatest(v["n"] - given(v), F.lit(0.0)).alias("neg")))
    return cut(said.join(cover, ["group_row", "field"]).select("group_row", "field", "key", votes.alias("votes")))


Quality = dict[int, list[tuple[float, float]]]  # by field, the (sensitivity, specificity) of each source


def ordered(value: list[float], weight: list[float]) -> list[float]:
    """The nearest figures (weighted least squares) that never rise along the order of trust."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] < blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return [v for v, _, n in blocks for _ in range(int(n))]


def _weights(quality: Quality) -> Column:
    """By source (p, n), what a claim and a denial of the row's field add to the log odds; a literal, so a round's code is the same."""
    table = [[{"p": math.log(a / (1 - b)), "n": math.log((1 - a) / b)} for a, b in quality[f]] for f in sorted(quality)]
    return F.get(F.from_json(F.lit(json.dumps(table)), "array<array<struct<p:double,n:double>>>"), F.col("field"))


def _score(weights: Column, votes: Column) -> Column:
    """The log odds of a value of a single-valued field up to what its rivals share."""
    total = F.aggregate(votes, F.lit(0.0), lambda acc, v: acc + v["n"] * (F.get(weights, v["source"])["p"] - F.get(weights, v["source"])["n"]))
    return F.greatest(F.least(total, F.lit(60.0)), F.lit(-60.0))


def _posterior(weights: Column) -> Column:
    """The posterior of a value of a multi-valued field."""
    total = F.aggregate("votes", F.lit(0.0), lambda acc, v: acc + v["pos"] * F.get(weights, v["source"])["p"] + v["neg"] * F.get(weights, v["source"])["n"])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(total, F.lit(60.0)), F.lit(-60.0))))


def estimate(sums: dict[tuple[int, int], tuple[float, float, float, float]]) -> tuple[Quality, list[tuple[float, float]]]:
    """(quality by field, quality over all fields) from (true claims, true values, false claims, false values) by (field, source)."""
    belief = [_BELIEF[s // N_STATUS] for s in range(N_SOURCES)]

    def figures(parts: list[tuple[float, float, float, float]], base: list[tuple[float, float]], votes: float) -> list[tuple[float, float]]:
        sens = ordered([(p[0] + votes * b[0]) / (p[1] + votes) for p, b in zip(parts, base)], [p[1] + votes for p in parts])
        spec = ordered([1 - (p[2] + votes * (1 - b[1])) / (p[3] + votes) for p, b in zip(parts, base)], [p[3] + votes for p in parts])
        return [(min(max(a, _LEAST), _MOST), min(max(b, _LEAST), _MOST)) for a, b in zip(sens, spec)]

    none = (0.0, 0.0, 0.0, 0.0)
    pooled = figures([tuple(map(sum, zip(none, *(sums.get((f, s), none) for f in range(len(FIELDS)))))) for s in range(N_SOURCES)], belief, _BELIEF_VOTES)
    return {f: figures([sums.get((f, s), none) for s in range(N_SOURCES)], pooled, _FIELD_VOTES) for f in range(len(FIELDS))}, pooled


def source_quality(rows: DataFrame, one: DataFrame, many: DataFrame, rounds: int = _ROUNDS) -> tuple[Quality, list[tuple[float, float]]]:
    """Expectation-maximisation over all facts, reduced to weighted patterns.

    The pattern of a single-valued field is its group's values as (votes, how many values have these votes), so a group with very
    many values has few entries.
    """
    alike = one.groupBy("group_row", "field", "votes").agg(F.count(F.lit(1)).alias("m"))
    rivals = alike.groupBy("group_row", "field").agg(F.array_sort(F.collect_list(F.struct("votes", "m"))).alias("rivals"))
    rivals = cut(rivals.groupBy("field", "rivals").agg(F.count(F.lit(1)).alias("weight")))
    patterns = cut(many.groupBy("field", "votes").agg(F.count(F.lit(1)).alias("weight")))
    agreed = rows.groupBy("source").agg(*[F.sum(F.get(F.col("agreed"), F.lit(i))).alias(f"a{i}") for i in range(len(FIELDS))]).collect()
    sure = {(i, r["source"]): r[f"a{i}"] for r in agreed for i in range(len(FIELDS)) if r[f"a{i}"]}
    quality, pooled = estimate({k: (n, n, 0.0, 0.0) for k, n in sure.items()})
    for _ in range(rounds):
        w = _weights(quality)
        scored = rivals.select("field", "weight", F.transform("rivals", lambda c: F.struct(c["votes"].alias("votes"), c["m"].alias("m"), F.exp(_score(w, c["votes"])).alias("e"))).alias("rivals"))  # noqa: B023
        total = lambda name: F.aggregate("rivals", F.lit(0.0), lambda acc, c: acc + c["m"] * (c[name] if name else 1.0))
        scored = scored.select("field", "weight", total("e").alias("z"), total(None).alias("k"), F.explode("rivals").alias("c"))
        scored = scored.select("field", (F.col("weight") * F.col("c.m")).alias("w"), (F.col("c.e") / F.col("z")).alias("p"), "k", F.explode("c.votes").alias("v"))
        own = scored.select("field", "v.source", (F.col("w") * F.col("p") * F.col("v.n")).alias("tp"), (F.col("w") * F.col("v.n")).alias("t"),
                            (F.col("w") * (1 - F.col("p")) * F.col("v.n")).alias("fp"), (F.col("w") * (F.col("k") - 1) * F.col("v.n")).alias("f"))
        each = patterns.select("field", "weight", _posterior(w).alias("p"), F.explode("votes").alias("v"))
        all_ = F.col("v.pos") + F.col("v.neg")
        each = each.select("field", "v.source", (F.col("weight") * F.col("p") * F.col("v.pos")).alias("tp"), (F.col("weight") * F.col("p") * all_).alias("t"),
                           (F.col("weight") * (1 - F.col("p")) * F.col("v.pos")).alias("fp"), (F.col("weight") * (1 - F.col("p")) * all_).alias("f"))
        sums = {k: (n, n, 0.0, 0.0) for k, n in sure.items()}
        for r in own.unionByName(each).groupBy("field", "source").agg(*[F.sum(x).alias(x) for x in ("tp", "t", "fp", "f")]).collect():
            have = sums.get((r["field"], r["source"]), (0.0,) * 4)
            sums[r["field"], r["source"]] = tuple(a + b for a, b in zip(have, (r["tp"], r["t"], r["fp"], r["f"])))
        quality, pooled = estimate(sums)
    return quality, pooled


def survivors(rows: DataFrame, pooled: list[tuple[float, float]]) -> DataFrame:
    """(group_row, survivor_row): the row of the most trusted source, then version, day and row; equal trust goes by the order."""
    trust = [a + b - 1 - 1e-9 * s for s, (a, b) in enumerate(pooled)]
    order = F.struct(F.get(F.array(*map(F.lit, trust)), F.col("source")).alias("trust"), "version", "day", (-F.col("row_id")).alias("row"))
    return rows.groupBy("group_row").agg((-F.max(order)["row"]).alias("survivor_row"))


def _spelt(pubs: DataFrame) -> DataFrame:
    """Every row's values in one spelling beside their hashes, for the records."""
    order = F.struct(_source().alias("source"), (-F.coalesce(version_number(F.col("source_version")), F.lit(-1.0))).alias("version"), (-F.coalesce(day_number(F.col("snapshot_date")), F.lit(0))).alias("day"), F.col("row_id").alias("row"))
    values = [(F.col(f) if f == "is_preprint" else _spelling(f, F.col(f))).alias(f"_{f}") for f in (*VERSION, *FIELDS)]
    return pubs.select(_work().alias("_work"), order.alias("_order"), F.array(*map(_key, FIELDS)).alias("_keys"), *values)


def represent(pubs: DataFrame) -> dict[str, DataFrame]:
    """``groups`` (group_row, survivor_row, n_rows), ``records`` (those with the best single values), ``values`` (every kept value of every
    multi-valued field with its posterior) and ``quality`` (what was learnt of each source; field ``*``: over all)."""
    spark = pubs.sparkSession
    rows = prepared(pubs)
    linked = cut(work_components(rows))
    rows = with_component(rows, linked)
    heads = cut(group_heads(rows))
    own = members(rows, heads)
    one, many = single_facts(own), multi_facts(own)
    quality, pooled = source_quality(own, one, many)
    groups = heads.select("component", "group_row", "n_rows").join(survivors(own, pooled), "group_row", "left").withColumn("survivor_row", F.coalesce("survivor_row", "group_row"))

    w = _weights(quality)
    scored = one.withColumn("score", _score(w, F.col("votes")))
    best = scored.groupBy("group_row", "field").agg(F.max(F.struct(F.round("score", 9).alias("score"), "newest", "key")).alias("b"), F.sum(F.exp("score")).alias("z"))
    chosen = best.groupBy("group_row").agg(F.map_from_entries(F.collect_list(F.struct("field", F.col("b.key")))).alias("chosen"), F.min(F.exp("b.score") / F.col("z")).alias("least"))
    kept = many.withColumn("posterior", _posterior(w)).where((F.col("posterior") >= 0.5) | (F.col("field") == FIELDS.index("merged_from")))

    texts = with_component(_spelt(pubs), linked)
    about = groups.join(chosen, "group_row", "left")
    met = texts.join(about.select("component", F.col("group_row").alias("_group"), "chosen"), "component")
    wins = lambda i: F.coalesce(F.get(F.col("_keys"), F.lit(i)) == F.col("chosen")[F.lit(i)], F.lit(True))
    version = [F.min(F.when(F.col(f"_{f}").isNotNull(), F.struct("_order", F.col(f"_{f}").alias("v"))))["v"].alias(f) for f in VERSION]
    single = [F.max(F.when(wins(i), F.col(f"_{f}"))).alias(f) for i, f in enumerate(SINGLE)]
    made = met.groupBy("_group").agg(*version, *single).withColumnRenamed("_group", "group_row")
    records = about.select("group_row", "survivor_row", "n_rows", F.coalesce("least", F.lit(1.0)).alias("least_posterior")).join(made, "group_row")

    listed = met.select(F.col("_group").alias("group_row"), F.explode(F.array(*[F.struct(F.lit(len(SINGLE) + j).alias("field"), F.col(f"_{f}").alias("values")) for j, f in enumerate(MULTI)])).alias("l"))
    listed = listed.select("group_row", "l.field", F.explode("l.values").alias("value")).distinct().withColumn("key", F.xxhash64("value"))
    name = F.get(F.array(*map(F.lit, FIELDS)), F.col("field")).alias("field")
    judged = many.select("group_row", "field", "key", F.lit(True).alias("_asked"))
    values = listed.join(judged, ["group_row", "field", "key"], "left").join(kept.select("group_row", "field", "key", "posterior"), ["group_row", "field", "key"], "left")
    values = values.where("_asked IS NULL OR posterior IS NOT NULL").select("group_row", name, "value", F.coalesce("posterior", F.lit(1.0)).alias("posterior"))
    table = [(f, source_name(s), round(a, 6), round(b, 6)) for f, q in [("*", pooled), *((FIELDS[i], q) for i, q in quality.items())] for s, (a, b) in enumerate(q)]
    learnt = spark.createDataFrame(table, "field string, source string, sensitivity double, specificity double")
    return {"groups": groups.drop("component"), "records": records, "values": values, "quality": learnt}
