"""Registered queries of problem 6 (a few keys holding most records)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators.skew import heavy_keys, key_profile
from spanloom.sources.tables import table


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """Keys in at least 1 % of the stored rows of their table."""
    cited = heavy_keys(table(spark, root, "citation_edges"), "cited_doc_id")
    found = heavy_keys(table(spark, root, "candidates"), "doc_id")
    return cited.select(F.lit("citation_edges").alias("table_name"), "heavy_key").unionByName(
        found.select(F.lit("candidates").alias("table_name"), "heavy_key")
    )


def p6_cited_profile(spark: SparkSession, root: str) -> DataFrame:
    """Per cited document: stored edges, distinct citing documents, first and last day."""
    edges = table(spark, root, "citation_edges")
    day = F.col("snapshot_date")
    return key_profile(edges, "cited_doc_id", "citing_doc_id", {"first_day": ("min", day), "last_day": ("max", day)})


def p6_candidate_profile(spark: SparkSession, root: str) -> DataFrame:
    """Per document: stored candidates, distinct values, extent of positions and characters covered by hits."""
    c = table(spark, root, "candidates")
    return key_profile(
        c, "doc_id", "value",
        {"first_start": ("min", F.col("char_start")), "last_end": ("max", F.col("char_end")),
         "hit_chars": ("sum", (F.col("char_end") - F.col("char_start")).cast("long"))},
    )


QUERIES = {"p6_found": p6_found, "p6_cited_profile": p6_cited_profile, "p6_candidate_profile": p6_candidate_profile}

SQL = {
    "p6_found": """
        SELECT 'citation_edges' AS table_name, cited_doc_id AS heavy_key FROM citation_edges
        WHERE cited_doc_id IS NOT NULL GROUP BY cited_doc_id
        HAVING count(*) * 100 >= (SELECT count(*) FROM citation_edges)
        UNION ALL
        SELECT 'candidates', doc_id FROM candidates WHERE doc_id IS NOT NULL GROUP BY doc_id
        HAVING count(*) * 100 >= (SELECT count(*) FROM candidates)""",
    "p6_cited_profile": """
        SELECT cited_doc_id, count(*) AS n_rows, count(DISTINCT citing_doc_id) AS n_distinct,
               min(snapshot_date) AS first_day, max(snapshot_date) AS last_day
        FROM citation_edges GROUP BY cited_doc_id""",
    "p6_candidate_profile": """
        SELECT doc_id, count(*) AS n_rows, count(DISTINCT value) AS n_distinct, min(char_start) AS first_start,
               max(char_end) AS last_end, CAST(sum(char_end - char_start) AS BIGINT) AS hit_chars
        FROM candidates GROUP BY doc_id""",
}
