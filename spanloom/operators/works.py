"""Works, preprints, author overlap and citation edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from spanloom.functions.ids import edge_id
from spanloom.functions.text import doi_prefix, first_filled, last_segment, short_doi, short_pmcid, surname, title_form

#: DOI prefixes of preprint servers.
PREPRINT_PREFIXES = ["10.1101", "10.21203", "10.2139"]


def flat_works(works: DataFrame) -> DataFrame:
    """Nested works (id, doi, title, type, publication_date, ids, authorships, ...) as flat rows of documents."""
    authors = F.transform("authorships", lambda a: last_segment(a["author"]["id"]))
    ends = F.transform(F.filter("authorships", lambda a: a["author_position"].isin("first", "last")), lambda a: last_segment(a["author"]["id"]))
    places = F.flatten(F.transform("authorships", lambda a: F.transform(a["institutions"], lambda i: last_segment(i["id"]))))
    return works.select(
        last_segment(F.col("id")).alias("doc_id"), last_segment(F.col("ids.pmid")).alias("pmid"), short_pmcid(F.col("ids.pmcid")).alias("pmcid"),
        short_doi(F.col("doi")).alias("doi"), "title", F.col("publication_date").alias("pub_date"), F.col("type").alias("work_type"),
        F.col("primary_location.source.display_name").alias("venue"), F.array_compact(authors).alias("author_ids"), F.array_compact(ends).alias("first_last_author_ids"),
        F.array_sort(F.array_distinct(F.array_compact(places))).alias("institution_ids"),
        surname(F.get(F.col("authorships"), F.lit(0))["author"]["display_name"]).alias("first_author_surname"),
        F.transform("referenced_works", last_segment).alias("referenced"),
    )


def availability(pmcid: Column, has_text: Column, abstract: Column, doi: Column) -> Column:
    """The status of a work's text; a preprint of the fee-bound server without an archive id is pending, whatever its abstract."""
    status = F.when(has_text, "fulltext").when(first_filled(abstract).isNotNull(), "abstract_only").otherwise("unavailable")
    return F.when(~has_text & pmcid.isNull() & F.coalesce(doi.startswith("10.1101/"), F.lit(False)), "preprint_requester_pays_pending").otherwise(status)


def is_preprint(work_type: Column, doi: Column, prefixes: list[str] = PREPRINT_PREFIXES) -> Column:
    return F.coalesce(work_type == "preprint", F.lit(False)) | F.coalesce(doi_prefix(doi).isin(prefixes), F.lit(False))


def keep_best(df: DataFrame, key: str, better: list[Column]) -> DataFrame:
    """One row per key: the first by ``better``, found by a combining aggregate over a struct (no sort of a key's rows)."""
    names = [F.col(c) for c in df.columns]
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(better)])
    return df.groupBy(key).agg(F.min_by(F.struct(*names), order).alias("_row")).select("_row.*")


def collapse_preprints(works: DataFrame, order: str) -> DataFrame:
    """Published works with the preprints they take in (``merged``) and the union of authors; preprints without a match stay.

    A preprint joins the first published work (by ``order``) of the same title form whose DOI prefix is the same (null
    equals null) or whose first author's surname is the same; empty titles never match.  ``works`` has doc_id, title, doi,
    first_author_surname, author_ids, preprint.
    """
    w = works.withColumns({"_form": title_form(F.col("title")), "_prefix": doi_prefix(F.col("doi"))})
    pub = w.where(~F.col("preprint"))
    pre = w.where(F.col("preprint") & (F.col("_form") != ""))
    # per title form and prefix / surname only the first published work matters: compact sides, no product within a form
    firsts = lambda key: pub.where("_form <> ''").groupBy("_form", key).agg(F.min_by("doc_id", F.struct(order, "doc_id")).alias("_d"), F.min(order).alias("_o"))
    a, b = firsts("_prefix"), firsts("first_author_surname").where("first_author_surname IS NOT NULL AND first_author_surname <> ''")
    m = pre.alias("p").join(a.alias("a"), (F.col("p._form") == F.col("a._form")) & F.col("p._prefix").eqNullSafe(F.col("a._prefix")), "left")
    m = m.join(b.alias("b"), (F.col("p._form") == F.col("b._form")) & (F.col("p.first_author_surname") == F.col("b.first_author_surname")), "left")
    nearest = F.array_min(F.array_compact(F.array(*[F.when(F.col(f"{x}._d").isNotNull(), F.struct(F.col(f"{x}._o").alias("o"), F.col(f"{x}._d").alias("d"))) for x in "ab"])))
    matched = m.select(F.col("p.doc_id").alias("doc_id"), F.col("p.author_ids").alias("author_ids"), nearest["d"].alias("into")).where("into IS NOT NULL")
    taken = matched.groupBy("into").agg(F.array_sort(F.collect_set("doc_id")).alias("merged"), F.array_distinct(F.flatten(F.collect_list("author_ids"))).alias("_more"))
    kept = w.join(matched.select("doc_id").distinct(), "doc_id", "left_anti").join(taken, F.col("doc_id") == F.col("into"), "left")
    empty = F.array().cast("array<string>")
    return kept.withColumns({
        "merged": F.coalesce("merged", empty),
        "author_ids": F.when(F.col("_more").isNull(), F.col("author_ids")).otherwise(F.array_sort(F.array_union(F.coalesce("author_ids", empty), "_more"))),
    }).drop("_form", "_prefix", "_more", "into")


def author_overlap(citing: DataFrame, corpus: DataFrame) -> DataFrame:
    """(doc_id, author_overlap, n_shared_authors, shared_author_ids) of citing works against the corpus' works.

    The corpus' author ids are a shuffled semi-join, not a broadcast set, so the corpus may be of any size.
    """
    ids = corpus.select(F.explode("author_ids").alias("author")).distinct()
    pairs = citing.select("doc_id", F.explode(F.array_distinct("author_ids")).alias("author"), F.coalesce("first_last_author_ids", F.array().cast("array<string>")).alias("ends"))
    shared = pairs.join(ids, "author", "left_semi").groupBy("doc_id").agg(
        F.array_sort(F.collect_set("author")).alias("shared_author_ids"), F.bool_or(F.array_contains("ends", F.col("author"))).alias("senior"))
    own = corpus.select("doc_id").distinct().withColumn("_own", F.lit(True))
    out = citing.select("doc_id").distinct().join(shared, "doc_id", "left").join(own, "doc_id", "left")
    ids_ = F.coalesce("shared_author_ids", F.array().cast("array<string>"))
    kind = F.when(F.col("_own"), "is_corpus_document").when(F.size(ids_) == 0, "external").when(F.col("senior"), "shared_senior_author").otherwise("shared_author")
    return out.select("doc_id", kind.alias("author_overlap"), F.size(ids_).alias("n_shared_authors"), ids_.alias("shared_author_ids"))


def edges_to(works: DataFrame, corpus: DataFrame) -> DataFrame:
    """(edge_id, citing_doc_id, cited_doc_id): references of ``works`` (doc_id, referenced) to works of the corpus, once each."""
    told = works.select(F.col("doc_id").alias("citing_doc_id"), F.explode("referenced").alias("cited_doc_id")).distinct()
    kept = told.join(corpus.select(F.col("doc_id").alias("cited_doc_id")).distinct(), "cited_doc_id", "left_semi")
    return kept.select(edge_id(F.col("citing_doc_id"), F.col("cited_doc_id")).alias("edge_id"), "citing_doc_id", "cited_doc_id")


def first_seen(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order``; bounded groups only (Spark cuts each task to its first rows before the shuffle)."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")
