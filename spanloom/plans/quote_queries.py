"""Registered queries over quotations, candidates and anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators import candidates as C
from spanloom.operators.align import align
from spanloom.operators.spans import anchor_windows, cover_label
from spanloom.sources.articles import article_parts
from spanloom.sources.tables import table

#: The community of the test tables: its accession patterns, names and own kinds.
ACCESSIONS = {"vault": r"VLT-[0-9]{6}", "basket": r"GBX[0-9]{5}"}
NAMES = ["NACRE"]
OWN_KINDS = ["vault"]


def align_quotes(spark: SparkSession, root: str) -> DataFrame:
    """Every quotation placed in its text, all three tiers."""
    q = table(spark, root, "records").where("source_quote <> ''").select("record_id", "doc_id", "source_quote", F.col("char_start").alias("hint")).distinct()
    return align(q, table(spark, root, "parsed_documents")).drop("hint")


def align_exact(spark: SparkSession, root: str) -> DataFrame:
    return align_quotes(spark, root).where("aligned_status = 'match_exact'").select("record_id", "doc_id", "aligned_start", "aligned_end")


def candidates_found(spark: SparkSession, root: str) -> DataFrame:
    """Hits of the community's accession patterns in every parsed text, with their section."""
    parsed = table(spark, root, "parsed_documents")
    hits = C.find_spans(parsed, ACCESSIONS)
    return hits.join(parsed.select("doc_id", "sections"), "doc_id").withColumn("section", cover_label(F.col("sections"), F.col("char_start"))).drop("sections")


def candidate_totals(spark: SparkSession, root: str) -> DataFrame:
    hits = C.find_spans(table(spark, root, "parsed_documents"), C.pattern_set(ACCESSIONS, ["nacre.example.org"]) | C.identity_patterns(NAMES))
    return hits.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


def released_accessions(spark: SparkSession, root: str) -> DataFrame:
    return C.released_values(table(spark, root, "records"))


def known_accessions(spark: SparkSession, root: str) -> DataFrame:
    """What generic hits are held against: the accessions the seed's works released."""
    return C.known_values(table(spark, root, "records"), table(spark, root, "candidates"), table(spark, root, "corpus_seed"))


def _citing_articles(spark: SparkSession, root: str) -> DataFrame:
    """Stored edges as the articles that would give them: a paragraph and a reference for each work cited."""
    seed = table(spark, root, "corpus_seed").select(F.col("doc_id").alias("cited_doc_id"), "doi", "pmid")
    e = table(spark, root, "citation_edges").where("citing_doc_id IS NOT NULL AND cited_doc_id IS NOT NULL").select("citing_doc_id", "cited_doc_id").distinct().join(seed, "cited_doc_id", "left")
    e = e.groupBy("citing_doc_id").agg(F.array_sort(F.collect_list(F.struct("cited_doc_id", "doi", "pmid"))).alias("refs"))
    esc = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    paragraphs = F.transform("refs", lambda r, i: F.concat(F.lit("<p>The work told here by "), esc(r["cited_doc_id"]), F.lit(' is cited in place <xref rid="r'), i.cast("string"), F.lit('">'), (i + 1).cast("string"), F.lit("</xref> of this text.</p>")))
    one = lambda kind, before, c: F.when(c.isNotNull(), F.concat(F.lit(f'<pub-id pub-id-type="{kind}">{before}'), esc(c), F.lit("</pub-id>"))).otherwise("")
    refs = F.transform("refs", lambda r, i: F.concat(F.lit('<ref id="r'), i.cast("string"), F.lit('">'), one("doi", "https://doi.org/", r["doi"]), one("pmid", "", r["pmid"]), F.lit("</ref>")))
    xml = F.concat(F.lit("<article><body>"), F.array_join(paragraphs, ""), F.lit("</body><back><ref-list>"), F.array_join(refs, ""), F.lit("</ref-list></back></article>"))
    return e.select(F.col("citing_doc_id").alias("doc_id"), xml.cast("binary").alias("content"))


def citation_anchors(spark: SparkSession, root: str) -> DataFrame:
    """Markers of references to the seed's works, in the articles of :func:`_citing_articles`."""
    return C.citation_anchors(article_parts(_citing_articles(spark, root)), table(spark, root, "corpus_seed")).select("doc_id", "start", "end")


def _anchors(spark: SparkSession, root: str) -> DataFrame:
    hits = table(spark, root, "candidates").where("doc_id IS NOT NULL")
    return C.anchors(hits, known_accessions(spark, root), OWN_KINDS)


def anchor_counts(spark: SparkSession, root: str) -> DataFrame:
    return _anchors(spark, root).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


def anchored_windows(spark: SparkSession, root: str) -> DataFrame:
    lengths = table(spark, root, "parsed_documents").where("text IS NOT NULL").select("doc_id", F.length("text").alias("n"))
    return anchor_windows(_anchors(spark, root), lengths)


QUERIES = {f.__name__: f for f in (align_quotes, align_exact, candidates_found, candidate_totals, released_accessions, known_accessions, citation_anchors, anchor_counts, anchored_windows)}

def _released(where: str) -> str:
    return f"""released AS (
    SELECT DISTINCT regexp_replace(v, '^[().]+|[().]+$', '', 'g') AS value FROM (
        SELECT unnest(string_split_regex(attributes['accession'], '[,;\\s]+')) AS v FROM records WHERE extraction_class = 'data_availability' AND attributes['direction'] = 'released' AND attributes['accession'] <> 'not_stated'{where})
    WHERE length(v) > 3)"""


_RELEASED = _released("")
_KNOWN = f"""{_released(" AND doc_id IN (SELECT doc_id FROM corpus_seed)")},
    known AS (SELECT value FROM released UNION SELECT value FROM candidates WHERE doc_id IN (SELECT doc_id FROM corpus_seed) AND NOT EXISTS (SELECT 1 FROM released))"""
_ANCHORS = f"""{_KNOWN},
    anchors AS (SELECT doc_id, char_start, char_end, CASE WHEN kind = 'identity_string' THEN kind ELSE 'accession' END AS kind FROM candidates
                WHERE doc_id IS NOT NULL AND (kind IN ('vault', 'identity_string') OR value IN (SELECT value FROM known)))"""


def _hits(kind: str, pattern: str) -> str:
    return f"""SELECT doc_id, '{kind}' AS kind, unnest(ms) AS value, unnest(list_transform(range(1, len(ms) + 1),
        lambda i: list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))) AS a
        FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS ps, regexp_extract_all(text, '{pattern}') AS ms FROM parsed_documents WHERE text <> '')"""


_BLANK = "[\\t\\n\\x0b\\x0c\\r \\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
_ALL_KINDS = ACCESSIONS | {
    "github_url": "https?://(?:www[.])?github[.]com/[\\w.-]+(?:/[\\w.-]+)?", "zenodo_url": "https?://(?:www[.])?(?:doi[.]org/10[.]5281/zenodo[.][0-9]+|zenodo[.]org/records?/[0-9]+)",
    "portal_nacre": "https?://nacre[.]example[.]org[\\w./%?=&#-]*|\\bnacre[.]example[.]org\\b", "identity_string": "NACRE"}


def _spots(of: str) -> str:
    """Every place of the found strings ``ms`` between the parts ``ps``."""
    return f"""SELECT record_id, doc_id, source_quote, hint, text, unnest(list_transform(range(1, len(ps)), lambda i: list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))) AS a,
        unnest(list_transform(ms, lambda x: length(x))) AS n FROM {of}"""


# the tiers one after the other, each over what the one before has not placed, from q (record_id, doc_id, source_quote, hint, q: the bare
# quotation); blanks and marks are spelt out for this engine
_TIERS = f"""j AS (SELECT q.*, text, contains(text, q) AND q <> '' AS exact,
          replace(replace(replace(replace(regexp_replace(regexp_replace(q, '{_BLANK}', chr(1), 'g'), '([!-/:-@\\[-`{{-~])', '\\\\\\1', 'g'), chr(92) || chr(39), '[' || chr(39) || '‘’]'), chr(92) || chr(34), '[' || chr(34) || '“”]'), chr(92) || '-', '[-‐‑‒–—]'), chr(1), '{_BLANK}') AS pat
          FROM q LEFT JOIN parsed_documents USING (doc_id)),
    e AS (SELECT *, string_split(text, q) AS ps, list_transform(range(1, len(string_split(text, q))), lambda x: q) AS ms FROM j WHERE exact),
    f AS (SELECT *, string_split_regex(text, pat) AS ps, regexp_extract_all(text, pat) AS ms FROM j WHERE q <> '' AND text <> '' AND NOT exact),
    l AS (SELECT * EXCLUDE (ps, ms), string_split_regex(text, '(?i)' || pat) AS ps, regexp_extract_all(text, '(?i)' || pat) AS ms FROM f WHERE len(ms) = 0),
    spots AS (SELECT *, 'match_exact' AS st FROM ({_spots('e')}) UNION ALL SELECT *, 'match_fuzzy' FROM ({_spots('(SELECT * FROM f WHERE len(ms) > 0)')}) UNION ALL SELECT *, 'match_lesser' FROM ({_spots('(SELECT * FROM l WHERE len(ms) > 0)')})),
    best AS (SELECT record_id, source_quote, hint, st, arg_min({{'a': a, 'n': n}}, abs(a - coalesce(hint, 0)) * 1000000 + a) AS b, any_value(text) AS text, doc_id FROM spots GROUP BY record_id, doc_id, source_quote, hint, st)"""
_BARE = f"regexp_replace(source_quote, '^{_BLANK}|{_BLANK}$', '', 'g')"
_ALIGN = f"""
    WITH q AS (SELECT DISTINCT record_id, doc_id, source_quote, char_start AS hint, {_BARE} AS q FROM records WHERE source_quote <> ''),
    {_TIERS}
    SELECT j.record_id, j.doc_id, j.source_quote, CAST(b.a AS INT) AS aligned_start, CAST(b.a + b.n AS INT) AS aligned_end, st AS aligned_status, substr(best.text, CAST(b.a + 1 AS BIGINT), CAST(b.n AS BIGINT)) AS aligned_quote
    FROM j LEFT JOIN best ON best.record_id = j.record_id AND best.source_quote = j.source_quote AND best.hint IS NOT DISTINCT FROM j.hint AND best.doc_id = j.doc_id"""

SQL = {
    "align_exact": r"""
        WITH q AS (SELECT DISTINCT record_id, doc_id, trim(source_quote) AS q, char_start AS hint FROM records WHERE source_quote <> ''),
        j AS (SELECT record_id, doc_id, q, hint, string_split(text, q) AS ps FROM q JOIN parsed_documents USING (doc_id) WHERE contains(text, q)),
        p AS (SELECT record_id, doc_id, q, hint, unnest(list_transform(range(1, len(ps)), lambda i: list_sum(list_transform(ps[1:i], lambda x: length(x))) + (i - 1) * length(q))) AS a FROM j)
        SELECT record_id, doc_id, CAST(arg_min(a, abs(a - coalesce(hint, 0)) * 1000000 + a) AS INT) AS aligned_start,
               CAST(arg_min(a, abs(a - coalesce(hint, 0)) * 1000000 + a) + length(q) AS INT) AS aligned_end FROM p GROUP BY record_id, doc_id, hint, q""",
    "candidates_found": f"""
        WITH hits AS ({_hits('vault', 'VLT-[0-9]{6}')} UNION ALL {_hits('basket', 'GBX[0-9]{5}')}),
        spans AS (SELECT doc_id, i, s.labels AS labels, s.start AS b, s."end" AS e FROM (SELECT doc_id, generate_subscripts(sections, 1) AS i, unnest(sections) AS s FROM parsed_documents)),
        best AS (SELECT h.doc_id, h.kind, h.value, h.a, arg_min(labels[1], (e - b) * 10000 + i) AS label FROM hits h LEFT JOIN spans s ON s.doc_id = h.doc_id AND b <= a AND a < e GROUP BY ALL)
        SELECT doc_id, kind, value, CAST(a AS INT) AS char_start, CAST(a + length(value) AS INT) AS char_end, coalesce(label, 'unknown') AS section FROM best""",
    "align_quotes": _ALIGN,
    "candidate_totals": f"""
        SELECT kind, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM ({" UNION ALL ".join(_hits(k, p) for k, p in _ALL_KINDS.items())}) GROUP BY kind""",
    "known_accessions": f"WITH {_KNOWN} SELECT value FROM known",
    "citation_anchors": """
        WITH e AS (SELECT DISTINCT citing_doc_id, cited_doc_id FROM citation_edges WHERE citing_doc_id IS NOT NULL AND cited_doc_id IS NOT NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY citing_doc_id ORDER BY cited_doc_id) AS k FROM e),
        p AS (SELECT *, 'The work told here by ' || cited_doc_id || ' is cited in place ' || k || ' of this text.' AS line FROM r),
        places AS (SELECT citing_doc_id, cited_doc_id, k, position(k || '' IN line) - 1 + coalesce(sum(length(line) + 2) OVER (PARTITION BY citing_doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM p)
        SELECT citing_doc_id AS doc_id, CAST(s AS INT) AS start, CAST(s + length(k || '') AS INT) AS "end"
        FROM places WHERE cited_doc_id IN (SELECT doc_id FROM corpus_seed WHERE doi IS NOT NULL OR pmid IS NOT NULL)""",
    "released_accessions": f"WITH {_RELEASED} SELECT value FROM released",
    "anchor_counts": f"WITH {_ANCHORS} SELECT kind, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM anchors GROUP BY kind",
    "anchored_windows": f"""
        WITH {_ANCHORS},
        wide AS (SELECT DISTINCT a.doc_id, greatest(char_start - 1500, 0) AS s, least(char_end + 1500, length(text)) AS e FROM anchors a JOIN parsed_documents p ON p.doc_id = a.doc_id WHERE text IS NOT NULL),
        flagged AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM wide),
        islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, e) AS island FROM flagged)
        SELECT doc_id, min(s) AS start, max(e) AS "end" FROM islands GROUP BY doc_id, island""",
}
