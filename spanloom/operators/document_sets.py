"""What a pass reads: full texts, abstracts, or windows around anchors; and the one table of corpus and citing documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window as W

from spanloom.functions.text import first_filled, status_form
from spanloom.operators.passes import Pass
from spanloom.operators.spans import anchor_windows


def corpus_and_citing(corpus: DataFrame, citing: DataFrame) -> DataFrame:
    """All documents; columns that only one side has are null on the other."""
    return corpus.unionByName(citing, allowMissingColumns=True)


def full_texts(documents: DataFrame, parsed: DataFrame, doc_type: str) -> DataFrame:
    """Parsed texts of the type's documents whose full text is at hand; null and empty texts are left out."""
    held = documents.where((F.col("doc_type") == doc_type) & (status_form(F.col("oa_status")) == "fulltext")).select("doc_id").distinct()
    return parsed.where("text <> ''").select("doc_id", "doc_title", "text", "sections").join(held, "doc_id", "left_semi")


def abstracts(documents: DataFrame, doc_type: str) -> DataFrame:
    """Abstracts of the type's documents as texts of one section; of several rows of a document its first text in order."""
    own = documents.where(F.col("doc_type") == doc_type).withColumn("text", first_filled(F.col("abstract"))).where("text IS NOT NULL AND doc_id IS NOT NULL")
    one = own.groupBy("doc_id").agg(F.min(F.struct("text", F.col("title").alias("doc_title"))).alias("d")).select("doc_id", "d.doc_title", "d.text")
    section = F.struct(F.array(F.lit("abstract")).alias("labels"), F.lit("Abstract").alias("title"), F.lit(0).alias("start"), F.length("text").alias("end"))
    return one.withColumn("sections", F.array(section))


def texts_of(p: Pass, doc_type: str, documents: DataFrame, parsed: DataFrame, anchors: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(texts, windows) that a pass reads of documents of a type; no windows: the texts are cut into fixed ones.

    Raises where the pass does not apply to the type.  With anchors, documents without any are left out.
    """
    if doc_type not in p.applies_to:
        raise ValueError(f"pass {p.name} applies to {p.applies_to}, not to {doc_type}")
    if p.text_source == "abstract":
        return abstracts(documents, doc_type), None
    texts = full_texts(documents, parsed, doc_type)
    if p.text_source != "anchors":
        return texts, None
    if anchors is None:
        raise ValueError(f"pass {p.name} reads around anchors")
    w = anchor_windows(anchors, texts.select("doc_id", F.length("text").alias("n")), p.anchor_radius)
    number = F.row_number().over(W.partitionBy("doc_id").orderBy("start")) - 1
    windows = w.select("doc_id", number.alias("window_index"), F.col("start").alias("window_start"), F.col("end").alias("window_end"))
    return texts.join(windows.select("doc_id").distinct(), "doc_id", "left_semi"), windows
