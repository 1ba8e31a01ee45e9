"""Registered queries over works, edges and seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.functions.ids import edge_id
from spanloom.functions.text import doi_prefix, heading_labels, squeeze, status_form, title_form, year_of
from spanloom.operators import works as K
from spanloom.sources.tables import table


def heading_classes(spark: SparkSession, root: str) -> DataFrame:
    """Labels of every section title."""
    s = table(spark, root, "parsed_documents").select(F.explode("sections").alias("s")).select("s.title").where("title IS NOT NULL").distinct()
    return s.select("title", F.array_join(heading_labels(F.col("title")), ";").alias("labels"))


def squeezed_abstracts(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "publications").where("abstract IS NOT NULL")
    return p.select("row_id", squeeze(F.col("abstract")).alias("abstract"), title_form(F.col("title")).alias("form"), doi_prefix(F.col("doi")).alias("prefix"), year_of(F.col("pub_date")).alias("year"))


#: What the shared view needs of a document.
VIEW_COLUMNS = ("doc_type", "group_key", "pub_date", "venue", "author_overlap")


def _latest(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """One row per doc_id with the given columns: a full-text one before others, then the smallest row.

    The columns are chosen before the aggregate, so the scan reads no others.
    """
    p = table(spark, root, "publications").select("doc_id", "row_id", status_form(F.col("oa_status")).alias("oa_status"), *columns)
    full = F.coalesce((F.col("oa_status") == "fulltext").cast("int"), F.lit(0))
    return K.keep_best(p, "doc_id", [-full, F.col("row_id")])


def keep_best_row(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, root, "title")


def _works(spark: SparkSession, root: str) -> DataFrame:
    p = _latest(spark, root, "title", "doi", "author_ids", "is_preprint")
    return p.select("doc_id", "row_id", "title", "doi", F.get(F.col("author_ids"), F.lit(0)).alias("first_author_surname"), F.coalesce("author_ids", F.array().cast("array<string>")).alias("author_ids"), F.coalesce("is_preprint", F.lit(False)).alias("preprint"))


def preprint_collapse(spark: SparkSession, root: str) -> DataFrame:
    """Works after taking preprints into published versions (the first author's id stands in for a surname)."""
    c = K.collapse_preprints(_works(spark, root), "row_id")
    return c.select("doc_id", F.array_join("merged", ";").alias("merged"), F.array_join(F.array_sort("author_ids"), ";").alias("authors"))


def author_overlap(spark: SparkSession, root: str) -> DataFrame:
    p = _latest(spark, root, "doc_type", "author_ids")
    ends = F.array_distinct(F.array_compact(F.array(F.get(F.col("author_ids"), F.lit(0)), F.get(F.col("author_ids"), F.size("author_ids") - 1))))
    citing = p.where("doc_type = 'citing'").select("doc_id", "author_ids", F.when(F.size("author_ids") > 0, ends).alias("first_last_author_ids"))
    out = K.author_overlap(citing, p.where("doc_type = 'corpus'").select("doc_id", "author_ids"))
    return out.withColumn("shared_author_ids", F.array_join("shared_author_ids", ";"))


def citation_edges(spark: SparkSession, root: str) -> DataFrame:
    """Edges to seed works, once each, with a freshly made id."""
    e = table(spark, root, "citation_edges").where("cited_doc_id IS NOT NULL AND citing_doc_id IS NOT NULL")
    w = e.groupBy("citing_doc_id").agg(F.collect_set("cited_doc_id").alias("referenced")).withColumnRenamed("citing_doc_id", "doc_id")
    return K.edges_to(w, table(spark, root, "corpus_seed"))


def edge_ids(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "citation_edges").where("cited_doc_id IS NOT NULL")
    return e.select("citing_doc_id", "cited_doc_id", edge_id(F.col("citing_doc_id"), F.col("cited_doc_id")).alias("made_id")).distinct()


def kind_counts(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "candidates").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def seed_centres(spark: SparkSession, root: str) -> DataFrame:
    """Documents and grants by centre; both columns may hold several values."""
    s = table(spark, root, "corpus_seed")
    c = s.select("doc_id", F.explode(F.split("centre", ";")).alias("centre"), "grant_numbers").select("doc_id", F.trim("centre").alias("centre"), F.explode_outer(F.split("grant_numbers", ";")).alias("g"))
    return c.groupBy("centre").agg(F.countDistinct("doc_id").alias("n_docs"), F.countDistinct(F.trim("g")).alias("n_grants"))


def reach(spark: SparkSession, root: str) -> DataFrame:
    """Documents by type and status, with totals per type (rollup)."""
    p = _latest(spark, root, "doc_type")
    r = p.rollup("doc_type", "oa_status").agg(F.count(F.lit(1)).alias("n"), F.grouping("oa_status").alias("is_total"))
    return r.where("doc_type IS NOT NULL").select("doc_type", "oa_status", "n", F.col("is_total").cast("int").alias("is_total"))


def id_map_join(spark: SparkSession, root: str) -> DataFrame:
    """Batched look-ups as joins: seeds met by PMID first, by DOI where that fails."""
    s = table(spark, root, "corpus_seed").select("doc_id", "pmid", F.lower("doi").alias("doi"))
    p = table(spark, root, "publications")
    by_pmid = p.where("pmid IS NOT NULL").groupBy("pmid").agg(F.min("row_id").alias("a"))
    by_doi = p.where("doi IS NOT NULL").groupBy(F.lower("doi").alias("doi")).agg(F.min("row_id").alias("b"))
    return s.join(by_pmid, "pmid", "left").join(by_doi, "doi", "left").select("doc_id", F.coalesce("a", "b").alias("row_id"))


QUERIES = {f.__name__: f for f in (heading_classes, squeezed_abstracts, keep_best_row, preprint_collapse, author_overlap, citation_edges, edge_ids, kind_counts, seed_centres, reach, id_map_join)}

_STATUS = """CASE regexp_replace(lower(oa_status), '[^a-z]', '', 'g') WHEN 'fulltext' THEN 'fulltext' WHEN 'abstractonly' THEN 'abstract_only' WHEN 'unavailable' THEN 'unavailable'
    WHEN 'preprintrequesterpayspending' THEN 'preprint_requester_pays_pending' WHEN 'unresolved' THEN 'unresolved' ELSE oa_status END"""
_LATEST = f"""latest AS (SELECT * REPLACE ({_STATUS} AS oa_status) FROM publications
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN {_STATUS} = 'fulltext' THEN 0 ELSE 1 END, row_id) = 1)"""
_YEAR = """coalesce(TRY_CAST(substr(pub_date, 1, 4) AS INT), TRY_CAST(right(pub_date, 4) AS INT))"""
_B = "[\\t\\n\\x0b\\x0c\\r \\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"

SQL = {
    "heading_classes": r"""
        WITH t AS (SELECT DISTINCT s.title AS title FROM (SELECT unnest(sections) AS s FROM parsed_documents) WHERE s.title IS NOT NULL),
        f AS (SELECT title,
              regexp_matches(title, '(?i)(\bdata\b[^.]{0,40}\bavailab|\bavailab[^.]{0,40}\bdata\b|\bdata\s+(access|sharing|deposition)|\baccession\s+(number|code)s?\b)') AS d,
              regexp_matches(title, '(?i)(\b(code|software)\b[^.]{0,40}\bavailab|\bavailab[^.]{0,40}\b(code|software)\b)') AS c FROM t)
        SELECT title, CASE WHEN d AND c THEN 'data_availability;code_availability' WHEN d THEN 'data_availability' WHEN c THEN 'code_availability'
            WHEN regexp_matches(title, '(?i)(\bmethods?\b|\bexperimental\s+procedures\b|\bmaterials\b|\bstar\W*methods\b)') THEN 'methods'
            WHEN regexp_matches(title, '(?i)(\bresults?\b|\bfindings\b)') THEN 'results' WHEN regexp_matches(title, '(?i)(\bdiscussion\b|\bconclusions?\b)') THEN 'discussion'
            WHEN regexp_matches(title, '(?i)(\bintroduction\b|\bbackground\b)') THEN 'introduction' WHEN regexp_matches(title, '(?i)\babstract\b') THEN 'abstract' ELSE '' END AS labels FROM f""",
    "squeezed_abstracts": f"""
        SELECT row_id, trim(regexp_replace(abstract, '{_B}', ' ', 'g')) AS abstract, coalesce(substr(regexp_replace(lower(title), '[^a-z0-9]', '', 'g'), 1, 90), '') AS form,
               CASE WHEN coalesce(doi, '') <> '' THEN split_part(doi, '/', 1) END AS prefix, {_YEAR} AS year
        FROM publications WHERE abstract IS NOT NULL""",
    "keep_best_row": f"WITH {_LATEST} SELECT doc_id, row_id, oa_status, title FROM latest",
    "preprint_collapse": f"""
        WITH {_LATEST},
        w AS (SELECT doc_id, row_id, coalesce(substr(regexp_replace(lower(title), '[^a-z0-9]', '', 'g'), 1, 90), '') AS form,
                     CASE WHEN coalesce(doi, '') <> '' THEN split_part(doi, '/', 1) END AS prefix, author_ids[1] AS sur, coalesce(author_ids, []) AS author_ids, coalesce(is_preprint, false) AS pre FROM latest),
        m AS (SELECT p.doc_id, arg_min(q.doc_id, q.row_id) AS into_ FROM w p JOIN w q ON p.form = q.form AND p.form <> '' AND p.pre AND NOT q.pre
                     AND (p.prefix IS NOT DISTINCT FROM q.prefix OR (p.sur = q.sur AND p.sur <> '')) GROUP BY p.doc_id),
        t AS (SELECT into_, string_agg(m.doc_id, ';' ORDER BY m.doc_id) AS merged, flatten(list(w.author_ids)) AS more FROM m JOIN w USING (doc_id) GROUP BY into_)
        SELECT w.doc_id, coalesce(t.merged, '') AS merged,
               array_to_string(list_sort(CASE WHEN t.into_ IS NULL THEN w.author_ids ELSE list_distinct(list_concat(w.author_ids, t.more)) END), ';') AS authors
        FROM w LEFT JOIN t ON t.into_ = w.doc_id WHERE w.doc_id NOT IN (SELECT doc_id FROM m)""",
    "author_overlap": f"""
        WITH {_LATEST},
        corpus AS (SELECT * FROM latest WHERE doc_type = 'corpus'), ids AS (SELECT DISTINCT unnest(author_ids) AS a FROM corpus),
        base AS (SELECT doc_id, author_ids[1] AS f, author_ids[len(author_ids)] AS l, author_ids FROM latest WHERE doc_type = 'citing'),
        met AS (SELECT doc_id, list(DISTINCT x) AS shared FROM (SELECT doc_id, unnest(author_ids) AS x FROM base) m JOIN ids ON ids.a = m.x GROUP BY doc_id),
        citing AS (SELECT doc_id, f, l, coalesce(list_sort(shared), []) AS shared FROM base LEFT JOIN met USING (doc_id))
        SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM corpus) THEN 'is_corpus_document' WHEN len(shared) = 0 THEN 'external'
                            WHEN list_contains(shared, f) OR list_contains(shared, l) THEN 'shared_senior_author' ELSE 'shared_author' END AS author_overlap,
               CAST(len(shared) AS INT) AS n_shared_authors, array_to_string(shared, ';') AS shared_author_ids FROM citing""",
    "citation_edges": """
        SELECT DISTINCT substr(sha1(citing_doc_id || cited_doc_id), 1, 16) AS edge_id, citing_doc_id, cited_doc_id FROM citation_edges
        WHERE citing_doc_id IS NOT NULL AND cited_doc_id IN (SELECT doc_id FROM corpus_seed)""",
    "edge_ids": "SELECT DISTINCT citing_doc_id, cited_doc_id, substr(sha1(citing_doc_id || cited_doc_id), 1, 16) AS made_id FROM citation_edges WHERE cited_doc_id IS NOT NULL",
    "kind_counts": "SELECT kind, count(*) AS n FROM candidates GROUP BY kind",
    "seed_centres": """
        WITH c AS (SELECT doc_id, trim(unnest(string_split(centre, ';'))) AS centre, grant_numbers FROM corpus_seed),
        g AS (SELECT centre, trim(unnest(string_split(grant_numbers, ';'))) AS g FROM c)
        SELECT centre, count(DISTINCT doc_id) AS n_docs, (SELECT count(DISTINCT g) FROM g WHERE g.centre = c.centre) AS n_grants FROM c GROUP BY centre""",
    "reach": f"""
        WITH {_LATEST}
        SELECT doc_type, oa_status, count(*) AS n, 0 AS is_total FROM latest WHERE doc_type IS NOT NULL GROUP BY 1, 2
        UNION ALL SELECT doc_type, NULL, count(*), 1 FROM latest WHERE doc_type IS NOT NULL GROUP BY 1""",
    "id_map_join": """
        SELECT s.doc_id, coalesce((SELECT min(row_id) FROM publications p WHERE p.pmid = s.pmid), (SELECT min(row_id) FROM publications p WHERE lower(p.doi) = lower(s.doi))) AS row_id FROM corpus_seed s""",
}
