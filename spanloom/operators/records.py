"""Records: the shared view, deduplication, absence, drift, population, gold tables, vocabularies, verdicts and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.functions.ids import record_id
from spanloom.functions.text import listed
from spanloom.operators.works import keep_best

#: Alignment statuses from best to worst; values that state nothing.
STATUS_ORDER = ["match_exact", "match_fuzzy", "match_lesser"]
UNSTATED = ["", "not_stated"]
SENTINELS = ["", "not_stated", "no_statement"]


def shared_view(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Records that were not rejected, with their document's type, group, date, venue and overlap; others are left out."""
    docs = documents.select("doc_id", "doc_type", "group_key", "pub_date", "venue", "author_overlap")
    return records.where("judge_verdict IS DISTINCT FROM 'rejected'").join(docs, "doc_id")


def best_aligned(records: DataFrame, order: list[Column]) -> DataFrame:
    """One record per (document, class, span): the best aligned, then the first by ``order``."""
    rank = F.array_position(F.array(*map(F.lit, STATUS_ORDER)), F.col("alignment_status"))
    key = F.struct("doc_id", "extraction_class", "char_start", "char_end")
    return keep_best(records.withColumn("_key", key), "_key", [rank, *order]).drop("_key")


def absences(documents: DataFrame, records: DataFrame, defaults: dict[str, dict[str, str]], attributes: dict[str, list[str]], run_id: str) -> DataFrame:
    """A record of silence for every (document, class of ``defaults``) without a record: empty quote, span [0, 0), section none."""
    classes = F.explode(F.array(*[F.lit(c) for c in sorted(defaults)]))
    wanted = documents.select("doc_id").distinct().withColumn("extraction_class", classes)
    silent = wanted.join(records.select("doc_id", "extraction_class").distinct(), ["doc_id", "extraction_class"], "left_anti")
    filled = F.create_map().cast("map<string,string>")
    for cls, default in sorted(defaults.items()):
        pairs = [x for a in attributes[cls] for x in (F.lit(a), F.lit(default.get(a)).cast("string"))]
        filled = F.when(F.col("extraction_class") == cls, F.create_map(*pairs)).otherwise(filled)
    zero = F.lit(0)
    return silent.select(
        record_id(F.col("doc_id"), F.col("extraction_class"), zero, zero, F.lit(run_id)).alias("record_id"), F.lit(run_id).alias("run_id"), "doc_id", "extraction_class",
        F.lit("").alias("source_quote"), zero.alias("char_start"), zero.alias("char_end"), F.lit("none").alias("source_section"), F.lit("match_exact").alias("alignment_status"), filled.alias("attributes"))


def several(value: Column) -> Column:
    """The values of a list-valued attribute: a JSON array, or values separated by ``;``."""
    return F.coalesce(F.from_json(F.when(value.startswith("["), value), "array<string>"), listed(value))


def drift(attributes: Column, vocabularies: dict[str, list[str]], lists: list[str] = ()) -> Column:
    """``name=value`` for every value outside its closed list, in the order of the attributes, each value of ``lists`` for itself;
    nulls never drift."""
    def outside(a: str, closed: list[str]) -> Column:
        values = several(attributes[a]) if a in lists else F.array(attributes[a])
        named = F.transform(F.filter(F.array_compact(values), lambda x: ~x.isin(closed)), lambda x: F.concat(F.lit(f"{a}="), x))
        return F.coalesce(named, F.array().cast("array<string>"))

    found = [outside(a, list(v)) for a, v in vocabularies.items() if v]
    return F.flatten(F.array(*found)) if found else F.array().cast("array<string>")


def population(records: DataFrame) -> DataFrame:
    """(extraction_class, attribute, share) of quoted records of a class in which an attribute is stated."""
    quoted = records.where("source_quote <> ''")
    total = quoted.groupBy("extraction_class").agg(F.count(F.lit(1)).alias("n"))
    told = quoted.select("extraction_class", F.explode("attributes").alias("attribute", "value"))
    per = told.groupBy("extraction_class", "attribute").agg(F.count_if(F.col("value").isNotNull() & ~F.col("value").isin(UNSTATED)).alias("k"))
    return per.join(total, "extraction_class").select("extraction_class", "attribute", F.round(F.col("k") / F.col("n"), 3).alias("share"))


def thin(records: DataFrame, below: float = 0.5, most: int = 12) -> DataFrame:
    """The first ``most`` attributes in order that are stated in less than ``below`` of their class's records."""
    return population(records).where(F.col("share") < below).orderBy("extraction_class", "attribute").limit(most)


def attribute_names(records: DataFrame, cls: str) -> list[str]:
    """The attributes that any record of a class has, in order; as many as the class defines."""
    keys = records.where(F.col("extraction_class") == cls).select(F.explode(F.map_keys("attributes")).alias("a")).distinct()
    return sorted(r["a"] for r in keys.collect())


def gold_table(records: DataFrame, documents: DataFrame, cls: str, attributes: list[str] | None = None) -> DataFrame:
    """The flat table of one class: documents by left join, one column per attribute and per canonical attribute.

    Without ``attributes`` the columns are those the class's records have.
    """
    attributes = attribute_names(records, cls) if attributes is None else attributes
    docs = documents.select("doc_id", "doc_type", "group_key", "pub_date", "venue", "author_overlap")
    r = records.where(F.col("extraction_class") == cls).where("judge_verdict IS DISTINCT FROM 'rejected'")
    plain = [F.coalesce(F.col("attributes")[a], F.lit("")).alias(a) for a in sorted(attributes)]
    canonical = [F.coalesce(F.col("attributes_canonical")[a], F.lit("")).alias(f"canonical_{a}") for a in sorted(attributes)]
    return r.join(docs, "doc_id", "left").select(
        "doc_id", "doc_type", "group_key", "pub_date", "venue", "author_overlap", *plain, *canonical, "source_section", "source_quote", "alignment_status",
        "judge_verdict", F.coalesce(F.array_join("enum_drift", ";"), F.lit("")).alias("enum_drift"), "evidence_scope", "run_id", "record_id")


def surface_values(records: DataFrame, sets: dict[str, list[str]], lists: list[str] = ()) -> DataFrame:
    """(value_set, surface_form): distinct stated values of the attributes that share a vocabulary, each value of ``lists`` for itself."""
    one = lambda a: several(F.col("attributes")[a]) if a in lists else F.array(F.col("attributes")[a])
    pairs = [F.struct(F.lit(s).alias("value_set"), one(a).alias("forms")) for s, attributes in sorted(sets.items()) for a in attributes]
    out = records.select(F.explode(F.array(*pairs)).alias("p")).select("p.value_set", F.explode("p.forms").alias("surface_form"))
    return out.where(F.col("surface_form").isNotNull() & ~F.col("surface_form").isin(SENTINELS)).distinct()


def latest_forms(vocabulary: DataFrame, order: str) -> DataFrame:
    """One canonical form per (value_set, surface_form): the one told last by ``order``."""
    return vocabulary.groupBy("value_set", "surface_form").agg(F.max_by("canonical_form", F.struct(order, "canonical_form")).alias("canonical_form"))


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """A vocabulary followed by a consolidation of its canonical forms: surface -> canonical -> consolidated."""
    s = second.select("value_set", F.col("surface_form").alias("canonical_form"), F.col("canonical_form").alias("_c"))
    return first.join(s, ["value_set", "canonical_form"], "left").select("value_set", "surface_form", F.coalesce("_c", "canonical_form").alias("canonical_form"))


def apply_vocabulary(records: DataFrame, vocabulary: DataFrame, sets: dict[str, str], key: str = "record_id") -> DataFrame:
    """``records`` with ``attributes_canonical``: the canonical form of each mapped attribute, else the value itself.

    ``sets`` maps attributes to value sets.  Distinct values meet the vocabulary, so a hot value is looked up once.
    """
    names = F.create_map(*[x for a, s in sets.items() for x in (F.lit(a), F.lit(s))])
    told = records.select(F.explode("attributes").alias("a", "v")).select(names[F.col("a")].alias("value_set"), F.col("v").alias("surface_form"))
    known = told.where("value_set IS NOT NULL AND surface_form IS NOT NULL").distinct().join(vocabulary, ["value_set", "surface_form"])
    rows = records.select(key, F.explode("attributes").alias("a", "v")).withColumn("value_set", names[F.col("a")])
    rows = rows.join(known.withColumnRenamed("surface_form", "v"), ["value_set", "v"], "left")
    maps = rows.groupBy(key).agg(F.map_from_entries(F.array_distinct(F.array_sort(F.collect_list(F.struct("a", F.coalesce("canonical_form", "v").alias("c")))))).alias("attributes_canonical"))
    return records.drop("attributes_canonical").join(maps, key, "left")


def merge_verdicts(records: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Records with the last verdict of each (by tag); a record without one keeps null."""
    last = verdicts.groupBy("record_id").agg(F.max_by(F.struct("verdict", "confidence", "reason"), F.struct("tag", "verdict")).alias("_v"))
    return records.drop("judge_verdict", "judge_confidence", "judge_reason").join(last, "record_id", "left").select(
        "*", F.col("_v.verdict").alias("judge_verdict"), F.col("_v.confidence").alias("judge_confidence"), F.col("_v.reason").alias("judge_reason")).drop("_v")


def request_parts(records: DataFrame, line: Column, size: int = 200) -> DataFrame:
    """(doc_id, part, n_records, body): the lines of a document's records, in parts of about ``size`` by hash of the record.

    However many records a document has, no task gathers more than a part of them.
    """
    counts = records.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias("_parts"))
    code = F.conv(F.substring(F.md5(F.col("record_id").cast("binary")), 1, 8), 16, 10).cast("long")
    items = records.withColumn("_line", line).join(counts, "doc_id").withColumn("part", F.pmod(code, F.col("_parts")))
    grouped = items.groupBy("doc_id", "part").agg(F.array_sort(F.collect_list(F.struct("record_id", "_line"))).alias("items"), F.count(F.lit(1)).alias("n_records"))
    return grouped.select("doc_id", "part", "n_records", F.array_join(F.transform("items", lambda x: x["_line"]), "\n").alias("body"))


def precision_by_class(labels: DataFrame, records: DataFrame) -> DataFrame:
    """(extraction_class, n, precision) of human labels (record_id, human_label): the share of correct among correct and incorrect ones."""
    own = records.select("record_id", "extraction_class").distinct()
    told = labels.where("human_label IN ('correct', 'incorrect')").join(own, "record_id")
    return told.groupBy("extraction_class").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("human_label") == "correct").cast("int")), 4).alias("precision"))


#: The closed domains of a record's columns.
DOMAINS = {"alignment_status": STATUS_ORDER, "judge_verdict": ["confirmed", "rejected", "uncertain"], "evidence_scope": ["full_text", "abstract_only"]}


def outside_domains(df: DataFrame, domains: dict[str, list[str]] = DOMAINS) -> DataFrame:
    """(column, value, n): stored values that are outside their column's closed domain; nulls are never outside."""
    pairs = [F.struct(F.lit(c).alias("column"), F.when(~F.col(c).isin(list(v)), F.col(c)).alias("value")) for c, v in sorted(domains.items()) if c in df.columns]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def calibration(labelled: DataFrame) -> DataFrame:
    """Confusion of a judge against labels (verdict, label): confirmed and correct are the positives; others are left out."""
    p, t = F.col("verdict") == "confirmed", F.col("label") == "correct"
    judged = labelled.where("verdict IN ('confirmed', 'rejected') AND label IN ('correct', 'incorrect')")
    c = judged.agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"))
    return c.select("*", F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 4).alias("precision"), F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 4).alias("recall"))


def import_labels(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Valid new labels beside the existing ones; per (record, labeller) the existing one stays."""
    fresh = incoming.where("human_label IN ('correct', 'incorrect', 'unsure')").join(existing, ["record_id", "labeller"], "left_anti")
    fresh = fresh.groupBy("record_id", "labeller").agg(F.min_by("human_label", F.struct("labelled_at", "human_label")).alias("human_label"), F.min("labelled_at").alias("labelled_at"))
    return existing.unionByName(fresh)


def seeded_sample(df: DataFrame, key: str, n: int, seed: str, first: Column | None = None) -> DataFrame:
    """``n`` rows in a fixed pseudo-random order of their key, those with ``first`` true before the others."""
    order = [F.desc("_first")] if first is not None else []
    return df.withColumn("_first", F.coalesce(first, F.lit(False)) if first is not None else F.lit(True)).withColumn(
        "_h", F.md5(F.concat(F.lit(seed), F.col(key)).cast("binary"))).orderBy(*order, "_h", key).limit(n).drop("_first", "_h")
