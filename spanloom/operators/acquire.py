"""From seeds and nested works to documents: look-ups as joins, status, back-fill, corpus and citing sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.functions.text import article_id, first_filled, month_prefix, short_pmcid, status_form
from spanloom.operators.works import author_overlap, availability, collapse_preprints, edges_to, flat_works, is_preprint, keep_best


def met_by_ids(seed: DataFrame, works: DataFrame) -> DataFrame:
    """Works (flat) that a seed row names by PMID or, failing that, by DOI; with the seed's group and grants as arrays."""
    listed = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    s = seed.select(F.col("pmid").alias("_pmid"), F.lower("doi").alias("_doi"), listed("centre").alias("group_key"), listed("grant_numbers").alias("grants"), F.monotonically_increasing_id().alias("_n"))
    a = s.where("_pmid IS NOT NULL").join(works, F.col("_pmid") == F.col("pmid"))
    rest = s.join(a.select("_n").distinct(), "_n", "left_anti").where("_doi IS NOT NULL")
    b = rest.join(works, F.col("_doi") == F.col("doi"))
    return a.unionByName(b.select(*a.columns)).drop("_pmid", "_doi", "_n")


def with_pmcids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Missing archive ids from a table of (pmid, pmcid); of several for one PMID the first in order."""
    own = ids.where("pmid IS NOT NULL AND pmcid IS NOT NULL").groupBy("pmid").agg(F.min(short_pmcid(F.col("pmcid"))).alias("_pmcid"))
    return documents.join(own, "pmid", "left").withColumn("pmcid", first_filled(F.col("pmcid"), F.col("_pmcid"))).drop("_pmcid")


def pending_by_month(documents: DataFrame, held: DataFrame) -> DataFrame:
    """(month, article_id, doc_id) of preprints still to be fetched: pending ones with a DOI and a date whose text is not held."""
    waiting = documents.where((status_form(F.col("oa_status")) == "preprint_requester_pays_pending") & F.col("doi").isNotNull())
    day = F.coalesce(F.col("pub_date").try_cast("date"), F.try_to_timestamp("pub_date", F.lit("yyyyMMdd")).cast("date"), F.try_to_timestamp("pub_date", F.lit("yyyy/MM/dd")).cast("date"))
    rows = waiting.select("doc_id", month_prefix(day).alias("month"), article_id(F.col("doi")).alias("article_id")).where("month IS NOT NULL").distinct()
    return rows.join(held.select("doc_id").distinct(), "doc_id", "left_anti")


def sweep(months: DataFrame, fetch, store: str) -> dict[str, str]:
    """Fetch month after month and append each to the table ``store`` (doc_id, month, content): an interrupted sweep goes on where
    it stopped, and a month that fails is told and does not stop the others.

    ``fetch`` takes the month's rows (article_id, doc_id) and gives (doc_id, content).  Only the names of months reach the driver.
    """
    told = {}
    for month in [r["month"] for r in months.select("month").distinct().orderBy("month").collect()]:
        try:
            fetch(months.where(F.col("month") == month).drop("month")).select("doc_id", F.lit(month).alias("month"), "content").write.mode("append").parquet(store)
            told[month] = "done"
        except Exception as e:  # noqa: BLE001
            told[month] = f"failed: {type(e).__name__}"
    return told


def fill_abstracts(documents: DataFrame, *sources: DataFrame) -> DataFrame:
    """Missing abstracts from the sources (doc_id, abstract) in their order, tags removed."""
    out = documents
    for i, s in enumerate(sources):
        own = s.groupBy("doc_id").agg(F.min(F.regexp_replace("abstract", "<[^>]+>", " ")).alias(f"_a{i}"))
        out = out.join(own, "doc_id", "left").withColumn("abstract", first_filled(F.col("abstract"), F.trim(f"_a{i}"))).drop(f"_a{i}")
    return out


def with_status(documents: DataFrame, full_texts: DataFrame) -> DataFrame:
    """``documents`` (pmcid, doi, abstract) with oa_status; ``full_texts`` has the doc_id of every text at hand."""
    held = full_texts.select("doc_id").distinct().withColumn("_text", F.lit(True))
    d = documents.join(held, "doc_id", "left")
    return d.withColumn("oa_status", availability(F.col("pmcid"), F.coalesce("_text", F.lit(False)), F.col("abstract"), F.col("doi"))).drop("_text")


def corpus_documents(seed: DataFrame, works: DataFrame, full_texts: DataFrame, *abstracts: DataFrame) -> DataFrame:
    """The corpus: seeds met in the works, one row each (a full-text row before others)."""
    flat = met_by_ids(seed, flat_works(works)).withColumn("abstract", F.lit(None).cast("string"))
    d = with_status(fill_abstracts(flat, *abstracts), full_texts).withColumn("doc_type", F.lit("corpus"))
    return keep_best(d, "doc_id", [-(F.col("oa_status") == "fulltext").cast("int"), F.col("title")])


def citing_documents(works: DataFrame, corpus: DataFrame, full_texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Citing works with status and author overlap (works of the corpus left out), and the edges to the corpus."""
    flat = flat_works(works).dropDuplicates(["doc_id"])
    edges = edges_to(flat, corpus)
    outside = flat.join(corpus.select("doc_id"), "doc_id", "left_anti").join(edges.select(F.col("citing_doc_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    d = with_status(outside.withColumn("abstract", F.lit(None).cast("string")), full_texts).withColumn("doc_type", F.lit("citing"))
    return d.join(author_overlap(d, corpus), "doc_id", "left"), edges


def acquire(works: DataFrame, corpus: DataFrame, full_texts: DataFrame, ids: DataFrame | None = None, *more_abstracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, edges): the corpus' rows and those of all works that cite it, in one table.

    Works of the corpus are left out of the citing ones, preprints go into their published versions (``merged_from``), archive ids and
    abstracts are filled from the given tables, status and overlap follow.  ``tier`` tells where a citing text can be had: archive,
    requester_pays, abstract or none.
    """
    flat = flat_works(works).dropDuplicates(["doc_id"])
    edges = edges_to(flat, corpus)
    outside = flat.join(corpus.select("doc_id"), "doc_id", "left_anti").join(edges.select(F.col("citing_doc_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    kept = collapse_preprints(outside.withColumn("preprint", is_preprint(F.col("work_type"), F.col("doi"))), "doc_id").withColumnRenamed("merged", "merged_from")
    kept = kept if ids is None else with_pmcids(kept, ids)
    kept = fill_abstracts(kept.withColumn("abstract", F.lit(None).cast("string")), *more_abstracts)
    d = with_status(kept, full_texts).withColumn("doc_type", F.lit("citing"))
    status = F.col("oa_status")
    tier = F.when(status == "fulltext", "archive").when(status == "preprint_requester_pays_pending", "requester_pays").when(status == "abstract_only", "abstract").otherwise("none")
    citing = d.withColumn("tier", tier).join(author_overlap(d, corpus), "doc_id", "left")
    return corpus.unionByName(citing.drop("preprint", "first_last_author_ids", "referenced"), allowMissingColumns=True), edges


def citing_of(edges: DataFrame, cited: str) -> DataFrame:
    """The works that cite one work."""
    return edges.where(F.col("cited_doc_id") == cited).select("citing_doc_id").distinct()


def attempted(key_index: DataFrame, runs: DataFrame, pass_name: str) -> DataFrame:
    """Documents that any run of a pass asked about, cancelled runs and sample runs left out."""
    done = runs.where((F.col("pass_name") == pass_name) & ~F.coalesce(F.col("status").startswith("cancelled"), F.lit(False)) & ~F.coalesce("is_sample", F.lit(False)))
    return key_index.join(done.select("run_id"), "run_id", "left_semi").select("doc_id").distinct()


def value_chunks(values: DataFrame, size: int = 80) -> DataFrame:
    """(value_set, chunk, surface_forms): distinct values in chunks of about ``size`` by hash, for a vocabulary service."""
    n = values.groupBy("value_set").agg(F.ceil(F.count(F.lit(1)) / size).alias("_chunks"))
    v = values.join(n, "value_set").withColumn("chunk", F.pmod(F.xxhash64("surface_form"), F.col("_chunks")))
    return v.groupBy("value_set", "chunk").agg(F.array_sort(F.collect_list("surface_form")).alias("surface_forms"))


def answered(values: DataFrame, answers: DataFrame) -> DataFrame:
    """A vocabulary from a service's answers (value_set, surface_form, canonical_form); what it left out maps to itself."""
    a = answers.groupBy("value_set", "surface_form").agg(F.min("canonical_form").alias("_c"))
    return values.join(a, ["value_set", "surface_form"], "left").select("value_set", "surface_form", F.coalesce(F.nullif("_c", F.lit("")), "surface_form").alias("canonical_form"))


def cost(usage: DataFrame, rates: DataFrame) -> DataFrame:
    """(model, tokens_in, tokens_out, cost) of runs; rates (model, rate_in, rate_out) are for a million tokens."""
    u = usage.groupBy("model").agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))
    return u.join(rates, "model", "left").select("model", "tokens_in", "tokens_out", F.round((F.col("tokens_in") * F.col("rate_in") + F.col("tokens_out") * F.col("rate_out")) / 1e6, 6).alias("cost"))
