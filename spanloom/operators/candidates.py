"""Regular-expression candidates and anchors in texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Addresses that are candidates in any community, and those of a portal (its pages or its bare host).
GENERIC_PATTERNS = {
    "github_url": r"https?://(?:www\.)?github\.com/[\w.\-]+(?:/[\w.\-]+)?",
    "zenodo_url": r"https?://(?:www\.)?(?:doi\.org/10\.5281/zenodo\.\d+|zenodo\.org/records?/\d+)",
}
PORTAL_PATTERN = r"https?://{host}[\w\-./%?=&#]*|\b{host}\b"


def pattern_set(accessions: dict[str, str], portals: list[str] = ()) -> dict[str, str]:
    """The patterns of a community: its accessions, the generic ones, and for each portal its addresses or bare host."""
    hosts = {f"portal_{h.split('.')[0]}": PORTAL_PATTERN.replace("{host}", re.escape(h)) for h in portals}
    return dict(accessions) | GENERIC_PATTERNS | hosts


def identity_patterns(names: list[str]) -> dict[str, str]:
    """Literal, case-sensitive names as one kind."""
    return {"identity_string": "|".join(sorted(map(re.escape, names), key=len, reverse=True))}


def find_spans(texts: DataFrame, patterns: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, kind, value, char_start, char_end) of every non-overlapping hit of every pattern; no shuffle."""
    compiled = list(patterns.items())
    kind = texts.schema[id_col].dataType.simpleString()
    names = [id_col, "kind", "value", "char_start", "char_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [(k, re.compile(p).finditer) for k, p in compiled]
        for batch in batches:
            rows = [(d, k, m.group(), m.start(), m.end()) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for k, find in finders for m in find(t)]
            made = list(zip(*rows)) if rows else [[]] * 5
            types = (batch.schema.field(0).type, pa.string(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, types)], names)

    return texts.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, kind string, value string, char_start int, char_end int")


def released_values(records: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """(value): accessions the corpus (doc_id; without it any document) released, cut at commas, semicolons and blanks, without
    brackets and full stops at their ends."""
    told = records.where("extraction_class = 'data_availability'").where((F.col("attributes")["direction"] == "released") & (F.col("attributes")["accession"] != "not_stated"))
    told = told if corpus is None else told.join(corpus.select("doc_id").distinct(), "doc_id", "left_semi")
    parts = told.select(F.explode(F.split(F.col("attributes")["accession"], r"[,;\s]+")).alias("v")).where("length(v) > 3")
    return parts.select(F.regexp_replace("v", r"^[().]+|[().]+$", "").alias("value")).distinct()


def known_values(records: DataFrame, hits: DataFrame, corpus: DataFrame) -> DataFrame:
    """What generic hits are held against: the corpus' released accessions, or all its hits where no availability record tells any."""
    released = released_values(records, corpus)
    if not released.isEmpty():
        return released
    return hits.join(corpus.select("doc_id").distinct(), "doc_id", "left_semi").select("value").distinct()


def anchors(hits: DataFrame, released: DataFrame, community_kinds: list[str]) -> DataFrame:
    """(doc_id, start, end, kind) of identity strings, hits of community kinds, and hits whose value the corpus released."""
    own = F.col("kind").isin(*community_kinds) | F.col("kind").startswith("portal_") | (F.col("kind") == "identity_string")
    spans = lambda df: df.select("doc_id", F.col("char_start").alias("start"), F.col("char_end").alias("end"), F.when(F.col("kind") == "identity_string", "identity_string").otherwise("accession").alias("kind"))
    return spans(hits.where(own)).unionByName(spans(hits.where(~own).join(released, "value", "left_semi")))


def citation_anchors(parts: DataFrame, corpus: DataFrame) -> DataFrame:
    """(doc_id, start, end, kind) of markers whose reference is a work of ``corpus`` (doi, pmid), one a paragraph.

    ``parts`` is :func:`spanloom.sources.articles.article_parts`.  References meet the corpus by equi joins, the markers meet them by
    document and reference; a paragraph is found by its first characters, in the row that has its text.
    """
    refs = parts.select("doc_id", F.explode("refs").alias("r")).select("doc_id", "r.*")
    met = [refs.where(F.col(k).isNotNull()).join(corpus.select(F.lower(k).alias(k)).where(F.col(k).isNotNull()).distinct(), k, "left_semi").select("doc_id", "rid") for k in ("doi", "pmid")]
    wanted = met[0].unionByName(met[1]).distinct()
    places = F.transform("marks", lambda m, i: F.struct(m["rids"].alias("rids"), (F.instr(F.col("text"), m["head"]) - 1).alias("at"), m["inside"].alias("inside"), F.length(m["marker"]).alias("n"), i.alias("i")))
    marks = parts.select("doc_id", F.explode(places).alias("m")).select("doc_id", "m.*").where("at >= 0").withColumn("rid", F.explode("rids")).drop("rids")
    first = marks.join(wanted, ["doc_id", "rid"], "left_semi").groupBy("doc_id", "at").agg(F.min_by(F.struct("inside", "n"), "i").alias("m"))
    start = F.col("at") + F.when(F.col("m.inside").between(0, 179), F.col("m.inside")).otherwise(0)
    return first.select("doc_id", start.alias("start"), (start + F.greatest(F.col("m.n"), F.lit(1))).alias("end"), F.lit("citation_marker").alias("kind"))
