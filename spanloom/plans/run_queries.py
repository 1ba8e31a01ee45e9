"""Registered queries of runs: document sets, planned requests, judging, silver, gold with the columns of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators import acquire as A, document_sets as D, judge as J, records as R, runs as U
from spanloom.plans.pipeline_queries import PASS, _W, _responses
from spanloom.plans.record_queries import SETS, _vocabulary
from spanloom.plans.work_queries import _LATEST, _STATUS
from spanloom.operators.harvest import finish_counts
from spanloom.sources.tables import table


def texts_full(spark: SparkSession, root: str) -> DataFrame:
    t = D.full_texts(table(spark, root, "publications"), table(spark, root, "parsed_documents"), "citing")
    return t.select("doc_id", F.length("text").alias("chars"), F.size("sections").alias("n_sections"))


def texts_abstract(spark: SparkSession, root: str) -> DataFrame:
    t = D.abstracts(table(spark, root, "publications"), "corpus")
    return t.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.col("sections")[0]["labels"][0].alias("label"), F.col("sections")[0]["end"].alias("end"))


def _plan(spark: SparkSession, root: str) -> U.Plan:
    """Full texts of citing documents that no stored record of the pass covers."""
    texts = D.full_texts(table(spark, root, "publications"), table(spark, root, "parsed_documents"), "citing")
    covered = table(spark, root, "records").where("pass_name = 'availability' AND extraction_class = 'object_format' AND doc_id IS NOT NULL").select("doc_id")
    return U.plan(PASS, texts, covered=covered)


def planned_requests(spark: SparkSession, root: str) -> DataFrame:
    return _plan(spark, root).requests.select("key", "doc_id", "window_index", "window_start", "window_end")


def planned_estimate(spark: SparkSession, root: str) -> DataFrame:
    return _plan(spark, root).estimate


def judge_contexts(spark: SparkSession, root: str) -> DataFrame:
    """Judge requests: records and candidates of each part, and a digest of its contexts in the order of the records."""
    r = J.judge_requests(table(spark, root, "records").where("doc_id IS NOT NULL"), table(spark, root, "parsed_documents"), table(spark, root, "candidates"), "judge", "extractor")
    text = F.col("request.contents")[0]["parts"][0]["text"]
    lines = F.split(F.element_at(F.split(text, "\nRecords:\n"), 2), "\n")
    contexts = F.transform(lines, lambda x: F.get_json_object(x, "$.context"))
    found = F.from_json(F.element_at(F.split(F.element_at(F.split(text, "\nRecords:\n"), 1), "\n"), -1), "array<struct<value:string>>")
    return r.select("key", "n_records", F.coalesce(F.size(found), F.lit(0)).alias("n_candidates"), F.md5(F.array_join(contexts, "|").cast("binary")).alias("contexts"),
                    F.col("request.generationConfig.maxOutputTokens").cast("int").alias("most"))


def _verdict_responses(spark: SparkSession, root: str) -> DataFrame:
    """Stored verdicts as a judge's answers, one a record; those of records without support did not end."""
    r = table(spark, root, "records").select("record_id", F.coalesce("judge_verdict", F.lit("maybe")).alias("verdict"), F.col("judge_confidence").alias("confidence"), F.col("judge_reason").alias("reason"), "candidate_support").distinct()
    body = F.to_json(F.struct(F.array(F.struct("record_id", "verdict", "confidence", "reason")).alias("verdicts")))
    return r.select(F.when(F.coalesce("candidate_support", F.lit(True)), "STOP").otherwise("MAX_TOKENS").alias("finish"), body.alias("body"))


def verdict_counts(spark: SparkSession, root: str) -> DataFrame:
    return J.verdict_summary(_verdict_responses(spark, root))


def verdicts_kept(spark: SparkSession, root: str) -> DataFrame:
    return J.verdicts(_verdict_responses(spark, root), "judge", "t1").groupBy("verdict", "judge_model", "tag").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("n_records"))


def silver_rebuilt(spark: SparkSession, root: str) -> DataFrame:
    """Silver from the records' raw values, the vocabulary and the verdict log."""
    r = table(spark, root, "records")
    bronze = r.select("record_id", "attributes").dropDuplicates(["record_id"]).withColumns({c: F.lit(None).cast("string") for c in ("judge_verdict", "judge_confidence", "judge_reason")})
    log = r.where("judge_verdict IS NOT NULL").select("record_id", F.col("judge_verdict").alias("verdict"), F.col("judge_confidence").alias("confidence"), F.col("judge_reason").alias("reason"), F.date_format("loaded_at", "yyyyMMddHHmmss").alias("tag"))
    s = J.rebuild_silver(bronze, _vocabulary(spark, root), log, SETS)
    return s.select("record_id", F.col("attributes_canonical")["platform"].alias("platform"), F.col("attributes_canonical")["repository"].alias("repository"), "judge_verdict")


def gold_formats(spark: SparkSession, root: str) -> DataFrame:
    """The gold table of object formats, its columns taken from the records."""
    from spanloom.plans.work_queries import VIEW_COLUMNS, _latest

    return R.gold_table(table(spark, root, "records"), _latest(spark, root, *VIEW_COLUMNS), "object_format").drop("source_quote", "alignment_status", "judge_verdict", "evidence_scope", "pub_date", "venue", "group_key", "author_overlap")


def response_ends(spark: SparkSession, root: str) -> DataFrame:
    return finish_counts(_responses(spark, root))


def labelled_precision(spark: SparkSession, root: str) -> DataFrame:
    """Precision by class of a stand-in for human labels: whether a candidate supports the record."""
    labels = table(spark, root, "records").where("source_quote <> ''").select("record_id", F.when(F.col("candidate_support"), "correct").when(~F.col("candidate_support"), "incorrect").otherwise("unsure").alias("human_label")).distinct()
    return R.precision_by_class(labels, table(spark, root, "records"))


def outside_domains(spark: SparkSession, root: str) -> DataFrame:
    return R.outside_domains(table(spark, root, "records"), R.DOMAINS | {"source_section": ["abstract", "introduction", "methods", "results", "discussion", "data_availability", "code_availability", "other"]})


def pending_months(spark: SparkSession, root: str) -> DataFrame:
    """Preprints still to be fetched, by month."""
    p = A.pending_by_month(table(spark, root, "publications"), table(spark, root, "parsed_documents"))
    return p.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("article_id").alias("n_articles"))


def pmcids_filled(spark: SparkSession, root: str) -> DataFrame:
    """Archive ids of seeds that lack one, from the publications' ids."""
    ids = table(spark, root, "publications").select("pmid", "pmcid")
    return A.with_pmcids(table(spark, root, "corpus_seed"), ids).select("doc_id", "pmid", "pmcid")


def all_documents(spark: SparkSession, root: str) -> DataFrame:
    """Corpus and citing rows in one table."""
    p = table(spark, root, "publications")
    both = D.corpus_and_citing(p.where("doc_type = 'corpus'").select("row_id", "doc_id", "doc_type", "group_key"), p.where("doc_type = 'citing'").select("row_id", "doc_id", "doc_type", "author_overlap"))
    return both.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"), F.count("group_key").alias("n_groups"), F.count("author_overlap").alias("n_overlap"))


QUERIES = {f.__name__: f for f in (
    texts_full, texts_abstract, planned_requests, planned_estimate, judge_contexts, verdict_counts, verdicts_kept, silver_rebuilt, gold_formats, response_ends, labelled_precision, outside_domains,
    pending_months, pmcids_filled, all_documents)}

_FULL = f"full_ AS (SELECT DISTINCT doc_id FROM publications WHERE doc_type = 'citing' AND {_STATUS} = 'fulltext')"
_PLANNED = f"""{_FULL}, {_W},
    k AS (SELECT doc_id, i, i * 28500 AS a, CAST(least(i * 28500 + 30000, n) AS INT) AS b FROM w WHERE doc_id IN (SELECT doc_id FROM full_)
          AND doc_id NOT IN (SELECT doc_id FROM records WHERE pass_name = 'availability' AND extraction_class = 'object_format' AND doc_id IS NOT NULL))"""
_VOC = "voc AS (SELECT value_set, unnest(known_as) AS surface_form, canonical_form FROM canonical_values)"
_ANSWER = "answer AS (SELECT DISTINCT record_id, coalesce(judge_verdict, 'maybe') AS verdict, judge_confidence, judge_reason, candidate_support, coalesce(candidate_support, true) AS ended FROM records)"

SQL = {
    "texts_full": f"WITH {_FULL} SELECT doc_id, length(text) AS chars, len(sections) AS n_sections FROM parsed_documents WHERE text <> '' AND doc_id IN (SELECT doc_id FROM full_)",
    "texts_abstract": "SELECT doc_id, md5(min(abstract)) AS digest, 'abstract' AS label, length(min(abstract)) AS \"end\" FROM publications WHERE doc_type = 'corpus' AND abstract <> '' AND doc_id IS NOT NULL GROUP BY doc_id",
    "planned_requests": f"WITH {_PLANNED} SELECT doc_id || '|' || i || '|' || a AS key, doc_id, i AS window_index, a AS window_start, b AS window_end FROM k",
    "planned_estimate": f"""
        WITH {_PLANNED}, c AS (SELECT count(*) AS n, CAST(floor(sum(b - a + {sum(map(len, PASS.prompt()))}) / 4.15) AS BIGINT) AS t FROM k)
        SELECT n AS n_requests, t AS tokens_in, CAST(n * 400 * 9 AS BIGINT) AS tokens_out, round((t * 1.0 + n * 400 * 9 * 6.0) / 1e6, 6) AS cost FROM c""",
    "judge_contexts": """
        WITH r AS (SELECT DISTINCT ON (doc_id, record_id) doc_id, record_id, char_start, char_end FROM records WHERE source_quote <> '' AND doc_id IS NOT NULL ORDER BY doc_id, record_id, extraction_class, char_start, char_end, source_quote),
        p AS (SELECT r.*, CAST('0x' || substr(md5(record_id), 1, 8) AS BIGINT) % CAST(ceil(count(*) OVER (PARTITION BY doc_id) / 200.0) AS BIGINT) AS part FROM r),
        c AS (SELECT p.doc_id, part, record_id, coalesce(substr(text, greatest(char_start - 400, 0) + 1, least(char_end + 400, length(text)) - greatest(char_start - 400, 0)), '') AS ctx FROM p LEFT JOIN parsed_documents USING (doc_id)),
        n AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, kind, value, section FROM candidates) GROUP BY doc_id)
        SELECT c.doc_id || '|' || part AS key, count(*) AS n_records, CAST(coalesce(any_value(n), 0) AS INT) AS n_candidates, md5(string_agg(ctx, '|' ORDER BY record_id)) AS contexts, 32768 AS most
        FROM c LEFT JOIN n ON n.doc_id = c.doc_id GROUP BY c.doc_id, part""",
    "verdict_counts": f"""
        WITH {_ANSWER} SELECT count(*) FILTER (ended AND verdict = 'confirmed') AS confirmed, count(*) FILTER (ended AND verdict = 'rejected') AS rejected, count(*) FILTER (ended AND verdict = 'uncertain') AS uncertain,
               count(*) FILTER (ended AND verdict = 'maybe') AS unknown_verdicts, count(*) FILTER (NOT ended) AS bad_responses FROM answer""",
    "verdicts_kept": f"WITH {_ANSWER} SELECT verdict, 'judge' AS judge_model, 't1' AS tag, count(*) AS n, count(DISTINCT record_id) AS n_records FROM answer WHERE ended AND verdict <> 'maybe' GROUP BY verdict",
    "silver_rebuilt": f"""
        WITH {_VOC}, r AS (SELECT DISTINCT ON (record_id) record_id, attributes FROM records ORDER BY record_id),
        v AS (SELECT record_id, arg_max(judge_verdict, (strftime(loaded_at, '%Y%m%d%H%M%S'), judge_verdict)) AS judge_verdict FROM records WHERE judge_verdict IS NOT NULL GROUP BY record_id)
        SELECT r.record_id, coalesce((SELECT min(canonical_form) FROM voc WHERE value_set = 'platform' AND surface_form = attributes['platform']), attributes['platform']) AS platform,
               coalesce((SELECT min(canonical_form) FROM voc WHERE value_set = 'repository' AND surface_form = attributes['repository']), attributes['repository']) AS repository, judge_verdict
        FROM r LEFT JOIN v USING (record_id)""",
    "gold_formats": f"""
        WITH {_LATEST}
        SELECT r.doc_id, doc_type, coalesce(attributes['format'], '') AS format, coalesce(attributes['level'], '') AS level, coalesce(attributes['object_description'], '') AS object_description,
               coalesce(attributes_canonical['format'], '') AS canonical_format, coalesce(attributes_canonical['level'], '') AS canonical_level, coalesce(attributes_canonical['object_description'], '') AS canonical_object_description,
               source_section, coalesce(array_to_string(enum_drift, ';'), '') AS enum_drift, run_id, record_id
        FROM records r LEFT JOIN latest l ON l.doc_id = r.doc_id WHERE extraction_class = 'object_format' AND judge_verdict IS DISTINCT FROM 'rejected'""",
    "response_ends": """
        WITH a AS (SELECT DISTINCT doc_id, greatest(0, floor((char_start - 1500) / 28500.0)) AS i, CAST('0x' || substr(md5(record_id), 1, 8) AS BIGINT) % 200 AS salt FROM records
                   WHERE extraction_class IN ('data_availability', 'object_format') AND evidence_scope = 'full_text' AND source_quote <> '')
        SELECT 'STOP' AS finish, count(*) AS n, count(*) AS tokens_in, count(*) AS tokens_out FROM a""",
    "labelled_precision": """
        WITH l AS (SELECT DISTINCT record_id, candidate_support AS ok FROM records WHERE source_quote <> '' AND candidate_support IS NOT NULL), c AS (SELECT DISTINCT record_id, extraction_class FROM records)
        SELECT extraction_class, count(*) AS n, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 4) AS precision FROM l JOIN c USING (record_id) GROUP BY 1""",
    "outside_domains": """
        WITH p AS (SELECT 'alignment_status' AS "column", alignment_status AS value FROM records WHERE alignment_status NOT IN ('match_exact', 'match_fuzzy', 'match_lesser')
            UNION ALL SELECT 'judge_verdict', judge_verdict FROM records WHERE judge_verdict NOT IN ('confirmed', 'rejected', 'uncertain') UNION ALL SELECT 'evidence_scope', evidence_scope FROM records WHERE evidence_scope NOT IN ('full_text', 'abstract_only')
            UNION ALL SELECT 'source_section', source_section FROM records WHERE source_section NOT IN ('abstract', 'introduction', 'methods', 'results', 'discussion', 'data_availability', 'code_availability', 'other'))
        SELECT "column", value, count(*) AS n FROM p GROUP BY 1, 2""",
    "pending_months": f"""
        WITH d AS (SELECT DISTINCT doc_id, coalesce(TRY_CAST(pub_date AS DATE), CAST(try_strptime(pub_date, '%Y%m%d') AS DATE), CAST(try_strptime(pub_date, '%Y/%m/%d') AS DATE), CAST(try_strptime(pub_date, '%Y-%m-%dT%H:%M:%SZ') AS DATE)) AS day, doi
                   FROM publications WHERE {_STATUS} = 'preprint_requester_pays_pending' AND doi IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM parsed_documents)),
        m AS (SELECT DISTINCT doc_id, strftime(day, '%B_%Y') AS month, regexp_extract(regexp_extract(rtrim(doi, '/'), '[^/]*$'), '[^.]*$') AS article FROM d WHERE day IS NOT NULL)
        SELECT month, count(*) AS n, count(DISTINCT article) AS n_articles FROM m GROUP BY month""",
    "pmcids_filled": """
        SELECT doc_id, pmid, coalesce(nullif(pmcid, ''), (SELECT min(CASE WHEN p.pmcid LIKE 'PMC%' THEN p.pmcid ELSE 'PMC' || p.pmcid END) FROM publications p WHERE p.pmid = s.pmid AND p.pmcid IS NOT NULL)) AS pmcid FROM corpus_seed s""",
    "all_documents": "SELECT doc_type, count(*) AS n, CASE doc_type WHEN 'corpus' THEN count(group_key) ELSE 0 END AS n_groups, CASE doc_type WHEN 'citing' THEN count(author_overlap) ELSE 0 END AS n_overlap FROM publications WHERE doc_type IN ('corpus', 'citing') GROUP BY doc_type",
}
