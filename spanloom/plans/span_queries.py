"""Registered queries of the span algebra."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators import spans as S
from spanloom.sources.tables import table


def windows_fixed(spark: SparkSession, root: str) -> DataFrame:
    """Fixed windows of every parsed text and a digest of each window's text."""
    p = table(spark, root, "parsed_documents").select("doc_id", "text", F.length("text").alias("n"))
    w = S.fixed_windows(p, F.col("n"))
    return w.select("doc_id", "window_index", "window_start", "window_end", F.md5(S.piece(F.col("text"), F.col("window_start"), F.col("window_end")).cast("binary")).alias("digest"))


def section_at(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "candidates").where("doc_id IS NOT NULL").select("doc_id", "kind", "char_start", "char_end").distinct()
    return S.section_at(c, table(spark, root, "parsed_documents"), "char_start")


def section_shares(spark: SparkSession, root: str) -> DataFrame:
    return S.section_shares(table(spark, root, "parsed_documents"))


def _candidate_spans(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "candidates").select("doc_id", "kind", "value", F.col("char_start").alias("start"), F.col("char_end").alias("end")).where("doc_id IS NOT NULL")


def interval_merge(spark: SparkSession, root: str) -> DataFrame:
    lengths = table(spark, root, "parsed_documents").where("text IS NOT NULL").select("doc_id", F.length("text").alias("n"))
    return S.anchor_windows(_candidate_spans(spark, root), lengths)


def _quoted(spark: SparkSession, root: str, *more: str) -> DataFrame:
    return table(spark, root, "records").where("source_quote <> '' AND doc_id IS NOT NULL AND char_end > char_start").select(
        "doc_id", F.col("char_start").alias("start"), F.col("char_end").alias("end"), *more)


def candidate_support(spark: SparkSession, root: str) -> DataFrame:
    """Distinct record spans and whether a candidate lies inside."""
    r = _quoted(spark, root).distinct()
    held = S.holds_any(r, _candidate_spans(spark, root), ["doc_id"]).withColumn("supported", F.lit(True))
    return r.join(held, ["doc_id", "start", "end"], "left").withColumn("supported", F.coalesce("supported", F.lit(False)))


def uncovered_candidates(spark: SparkSession, root: str) -> DataFrame:
    return S.outside_all(_candidate_spans(spark, root), _quoted(spark, root), ["doc_id"], "start", "end")


def uncovered_counts(spark: SparkSession, root: str) -> DataFrame:
    return uncovered_candidates(spark, root).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def span_overlap_recall(spark: SparkSession, root: str) -> DataFrame:
    """Per class and direction: how many of one reader's spans another reader's overlap."""
    r = _quoted(spark, root, "extraction_class", "extractor_model").distinct()
    out = None
    for own, other in (("reader-large-2", "reader-small-1"), ("reader-small-1", "reader-large-2")):
        a, b = (r.where(F.col("extractor_model") == m).drop("extractor_model") for m in (own, other))
        hit = S.overlaps_any(a, b, ["doc_id", "extraction_class"]).groupBy("extraction_class").agg(F.count(F.lit(1)).alias("covered"))
        total = a.groupBy("extraction_class").agg(F.count(F.lit(1)).alias("total")).join(hit, "extraction_class", "left")
        part = total.select("extraction_class", F.lit(own).alias("reader"), "total", F.coalesce("covered", F.lit(0)).alias("covered"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("recall", F.round(F.try_divide("covered", "total"), 3))


def context_snippets(spark: SparkSession, root: str) -> DataFrame:
    """Every quoted record with 400 characters of its text on both sides."""
    r = _quoted(spark, root, "record_id").distinct()
    t = table(spark, root, "parsed_documents").where("text IS NOT NULL").select("doc_id", "text")
    return r.join(t, "doc_id").select("record_id", S.context(F.col("text"), F.col("start"), F.col("end")).alias("snippet"))


QUERIES = {f.__name__: f for f in (windows_fixed, section_at, section_shares, interval_merge, candidate_support, uncovered_candidates, uncovered_counts, span_overlap_recall, context_snippets)}

_SECTIONS = """
    spans AS (SELECT doc_id, i, s.labels AS labels, s.start AS a, s."end" AS b
              FROM (SELECT doc_id, generate_subscripts(sections, 1) AS i, unnest(sections) AS s FROM parsed_documents))"""

SQL = {
    "windows_fixed": """
        WITH p AS (SELECT doc_id, text, length(text) AS n FROM parsed_documents WHERE length(text) > 0),
        w AS (SELECT doc_id, text, n, unnest(range(0, CASE WHEN n <= 30000 THEN 1 ELSE CAST(ceil((n - 1500) / 28500.0) AS INT) END)) AS window_index FROM p)
        SELECT doc_id, CAST(window_index AS INT) AS window_index, CAST(window_index * 28500 AS INT) AS window_start,
               CAST(least(window_index * 28500 + 30000, n) AS INT) AS window_end,
               md5(substr(text, window_index * 28500 + 1, least(window_index * 28500 + 30000, n) - window_index * 28500)) AS digest
        FROM w""",
    "section_at": f"""
        WITH {_SECTIONS},
        c AS (SELECT DISTINCT doc_id, kind, char_start, char_end FROM candidates WHERE doc_id IS NOT NULL),
        best AS (SELECT c.doc_id, c.kind, c.char_start, c.char_end, arg_min(labels[1], (b - a) * 10000 + i) AS label
                 FROM c JOIN spans s ON s.doc_id = c.doc_id AND a <= char_start AND char_start < b GROUP BY ALL)
        SELECT doc_id, kind, char_start, char_end, coalesce(label, 'unknown') AS section
        FROM c LEFT JOIN best USING (doc_id, kind, char_start, char_end)""",
    "section_shares": f"""
        WITH {_SECTIONS},
        docs AS (SELECT doc_id, length(text) AS n FROM parsed_documents WHERE length(text) > 0),
        cuts AS (SELECT doc_id, 0 AS p FROM docs UNION SELECT doc_id, n FROM docs UNION
                 SELECT doc_id, a FROM spans JOIN docs USING (doc_id) UNION SELECT doc_id, b FROM spans JOIN docs USING (doc_id)),
        parts AS (SELECT doc_id, p AS lo, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS hi FROM cuts),
        labelled AS (SELECT parts.doc_id, lo, hi, arg_min(labels[1], (b - a) * 10000 + i) AS label
                     FROM parts LEFT JOIN spans s ON s.doc_id = parts.doc_id AND a <= lo AND lo < b WHERE hi IS NOT NULL GROUP BY ALL)
        SELECT doc_id, coalesce(label, 'unknown') AS label, round(sum(hi - lo) / max(n), 6) AS share
        FROM labelled JOIN docs USING (doc_id) GROUP BY 1, 2""",
    "interval_merge": """
        WITH wide AS (SELECT DISTINCT c.doc_id, greatest(char_start - 1500, 0) AS s, least(char_end + 1500, length(text)) AS e
                      FROM candidates c JOIN parsed_documents p ON p.doc_id = c.doc_id WHERE text IS NOT NULL),
        flagged AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM wide),
        islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, e) AS island FROM flagged)
        SELECT doc_id, min(s) AS start, max(e) AS "end" FROM islands GROUP BY doc_id, island""",
    "candidate_support": """
        WITH r AS (SELECT DISTINCT doc_id, char_start AS s, char_end AS e FROM records WHERE source_quote <> '' AND doc_id IS NOT NULL AND char_end > char_start)
        SELECT doc_id, s AS start, e AS "end", EXISTS (SELECT 1 FROM candidates c WHERE c.doc_id = r.doc_id AND c.char_start >= r.s AND c.char_end <= r.e) AS supported FROM r""",
    "uncovered_candidates": """
        SELECT doc_id, kind, value, char_start AS start, char_end AS "end" FROM candidates c
        WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM records r WHERE r.doc_id = c.doc_id AND r.source_quote <> '' AND r.char_end > r.char_start
                                                 AND c.char_start >= r.char_start AND c.char_end <= r.char_end)""",
    "uncovered_counts": """
        SELECT kind, count(*) AS n FROM candidates c
        WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM records r WHERE r.doc_id = c.doc_id AND r.source_quote <> '' AND r.char_end > r.char_start
                                                 AND c.char_start >= r.char_start AND c.char_end <= r.char_end) GROUP BY kind""",
    "span_overlap_recall": """
        WITH r AS (SELECT DISTINCT doc_id, extraction_class, extractor_model, char_start AS s, char_end AS e FROM records
                   WHERE source_quote <> '' AND doc_id IS NOT NULL AND char_end > char_start),
        f AS (SELECT *, EXISTS (SELECT 1 FROM r o WHERE o.doc_id = r.doc_id AND o.extraction_class = r.extraction_class
                                AND o.extractor_model <> r.extractor_model AND o.s < r.e AND r.s < o.e) AS hit FROM r)
        SELECT extraction_class, extractor_model AS reader, count(*) AS total, count(*) FILTER (hit) AS covered,
               round(count(*) FILTER (hit) / count(*), 3) AS recall FROM f GROUP BY 1, 2""",
    "context_snippets": """
        SELECT DISTINCT record_id, substr(text, greatest(char_start - 400, 0) + 1, least(char_end + 400, length(text)) - greatest(char_start - 400, 0)) AS snippet
        FROM records r JOIN parsed_documents p USING (doc_id) WHERE source_quote <> '' AND char_end > char_start AND text IS NOT NULL""",
}
