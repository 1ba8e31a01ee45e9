"""Registered queries over records: view, dedupe, absence, drift, gold, vocabularies, verdicts, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.functions.ids import record_id
from spanloom.operators import records as R
from spanloom.plans.work_queries import _LATEST, VIEW_COLUMNS, _latest
from spanloom.sources.tables import table

TIERS = {"access_tier": ["open", "controlled", "registered"], "direction": ["released", "acquired"]}
SETS = {"platform": "platform", "vendor": "vendor", "repository": "repository", "format": "format"}
ABSENT = {"data_availability": {"statement_kind": "no_statement"}, "object_format": {"format": "no_statement"}}
NAMES = {"data_availability": ["accession", "repository", "access_tier", "direction", "statement_kind"], "object_format": ["format", "level", "object_description"]}


def _records(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "records")


def v_records(spark: SparkSession, root: str) -> DataFrame:
    return R.shared_view(_records(spark, root), _latest(spark, root, *VIEW_COLUMNS)).select("record_id", "doc_id", "doc_type", "group_key", "pub_date", "venue", "extraction_class", "judge_verdict")


def best_aligned(spark: SparkSession, root: str) -> DataFrame:
    r = _records(spark, root).select("record_id", "doc_id", "extraction_class", "char_start", "char_end", "alignment_status").distinct()
    return R.best_aligned(r, [F.col("record_id")])


def record_ids(spark: SparkSession, root: str) -> DataFrame:
    r = _records(spark, root)
    made = record_id(*(F.col(c) for c in ("doc_id", "extraction_class", "char_start", "char_end", "run_id")))
    return r.select("record_id", made.alias("made_id")).distinct()


def absence_records(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "parsed_documents").where("text <> ''")
    out = R.absences(docs, _records(spark, root), ABSENT, NAMES, "run_1")
    return out.select("record_id", "doc_id", "extraction_class", "source_quote", "char_start", "char_end", "source_section", "alignment_status",
                      F.coalesce(F.col("attributes")["statement_kind"], F.col("attributes")["format"]).alias("statement"), F.size("attributes").alias("n_attributes"))


def enum_drift(spark: SparkSession, root: str) -> DataFrame:
    """Drift made afresh, beside the stored one."""
    r = _records(spark, root).where("extraction_class = 'data_availability'")
    made = R.drift(F.col("attributes"), TIERS)
    return r.groupBy(F.array_join(made, ";").alias("drift"), F.array_join("enum_drift", ";").alias("stored")).agg(F.count(F.lit(1)).alias("n"))


def attribute_population(spark: SparkSession, root: str) -> DataFrame:
    return R.population(_records(spark, root))


def thin_attributes(spark: SparkSession, root: str) -> DataFrame:
    """Attributes stated in less than three quarters of their class's records, first twelve in order."""
    return R.thin(_records(spark, root), 0.75)


def gold_availability(spark: SparkSession, root: str) -> DataFrame:
    g = R.gold_table(_records(spark, root), _latest(spark, root, *VIEW_COLUMNS), "data_availability", NAMES["data_availability"])
    return g.select("record_id", "doc_id", "doc_type", "accession", "repository", "access_tier", "direction", "statement_kind", "canonical_repository", "source_section", "enum_drift", "run_id")


def vocab_distinct(spark: SparkSession, root: str) -> DataFrame:
    return R.surface_values(_records(spark, root), {s: [a] for a, s in SETS.items()})


def _vocabulary(spark: SparkSession, root: str) -> DataFrame:
    """Accepted names of the list as a vocabulary: known_as -> canonical form."""
    c = table(spark, root, "canonical_values")
    return c.select("value_set", F.explode("known_as").alias("surface_form"), "canonical_form").where("surface_form IS NOT NULL")


def vocab_compose(spark: SparkSession, root: str) -> DataFrame:
    """Accepted names, consolidated: the forms of a platform family under its first word."""
    first = _vocabulary(spark, root)
    forms = table(spark, root, "canonical_values").where("value_set = 'platform'")
    second = forms.select("value_set", F.col("canonical_form").alias("surface_form"), F.split_part("canonical_form", F.lit(" "), F.lit(1)).alias("canonical_form"))
    return R.compose(first, second)


def vocab_apply(spark: SparkSession, root: str) -> DataFrame:
    """Silver: canonical attributes beside the raw ones, one row per record."""
    r = _records(spark, root).select("record_id", "attributes").dropDuplicates(["record_id"])
    out = R.apply_vocabulary(r, _vocabulary(spark, root), SETS)
    keys = list(SETS)
    return out.select("record_id", *[F.col("attributes_canonical")[k].alias(f"canonical_{k}") for k in keys])


def verdict_merge(spark: SparkSession, root: str) -> DataFrame:
    """Stored verdicts as a verdict log: the latest load of a record wins."""
    r = _records(spark, root)
    log = r.where("judge_verdict IS NOT NULL").select("record_id", F.col("judge_verdict").alias("verdict"), F.col("judge_confidence").alias("confidence"), F.col("judge_reason").alias("reason"), F.date_format("loaded_at", "yyyyMMddHHmmss").alias("tag"))
    ids = r.select("record_id").distinct().withColumns({c: F.lit(None).cast("string") for c in ("judge_verdict", "judge_confidence", "judge_reason")})
    return R.merge_verdicts(ids, log).select("record_id", "judge_verdict", "judge_confidence", "judge_reason")


def judge_calibration(spark: SparkSession, root: str) -> DataFrame:
    """The judge against a stand-in label: whether a candidate supports the record."""
    r = _records(spark, root).where("source_quote <> ''").select("record_id", F.col("judge_verdict").alias("verdict"), F.when(F.col("candidate_support"), "correct").when(~F.col("candidate_support"), "incorrect").alias("label")).distinct()
    return R.calibration(r)


def trust_by_class(spark: SparkSession, root: str) -> DataFrame:
    """Per class: records, judged, kept, supported; all and non-rejected, both named."""
    r = _records(spark, root)
    return r.groupBy("extraction_class").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.expr("judge_verdict IS DISTINCT FROM 'rejected'")).alias("n_kept"), F.count("judge_verdict").alias("n_judged"),
        F.count_if("candidate_support").alias("n_supported"), F.round(F.try_divide(F.count_if(F.col("judge_verdict") == "confirmed"), F.count("judge_verdict")), 3).alias("confirmed_share"))


def judge_requests(spark: SparkSession, root: str) -> DataFrame:
    """Judge requests per document in parts of about 200 records, with the document's distinct candidates counted."""
    r = _records(spark, root).where("source_quote <> '' AND doc_id IS NOT NULL").select("doc_id", "record_id", "extraction_class", "source_quote").distinct()
    body = R.request_parts(r, F.concat_ws(" | ", "record_id", "extraction_class", "source_quote"))
    c = table(spark, root, "candidates").where("doc_id IS NOT NULL").select("doc_id", "value").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_values"))
    out = body.join(c, "doc_id", "left")
    return out.select("doc_id", "part", "n_records", F.coalesce("n_values", F.lit(0)).alias("n_values"), F.md5(F.col("body").cast("binary")).alias("prompt_digest"))


def label_sample(spark: SparkSession, root: str) -> DataFrame:
    """200 records for labelling, those with a candidate first."""
    r = _records(spark, root).where("source_quote <> ''").select("record_id", "doc_id", "extraction_class", "candidate_support").distinct()
    return R.seeded_sample(r, "record_id", 200, "labels_1", F.col("candidate_support"))


def document_sample(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "parsed_documents").select("doc_id").distinct()
    return R.seeded_sample(d, "doc_id", 50, "nacre_availability_sample_50")


def run_summary(spark: SparkSession, root: str) -> DataFrame:
    """Per run: records, absences, alignment counts."""
    r = _records(spark, root)
    quoted = F.col("source_quote") != ""
    count = lambda s: F.count_if(quoted & (F.col("alignment_status") == s)).alias(s)
    return r.groupBy("run_id").agg(F.count(F.lit(1)).alias("records"), F.count_if(~quoted).alias("absences"), *map(count, R.STATUS_ORDER), F.countDistinct("doc_id").alias("n_docs"))


def only_missing(spark: SparkSession, root: str) -> DataFrame:
    """Texts that no availability run covers yet."""
    covered = _records(spark, root).where("pass_name = 'availability'").select("doc_id").distinct()
    return table(spark, root, "parsed_documents").where("text <> ''").select("doc_id").join(covered, "doc_id", "left_anti")


def next_run_number(spark: SparkSession, root: str) -> DataFrame:
    n = F.regexp_extract("run_id", r"_(\d+)$", 1).try_cast("int")
    return _records(spark, root).groupBy("pass_name", F.regexp_extract("run_id", r"_(\d{8})_\d+$", 1).alias("day")).agg((F.max(n) + 1).alias("next_number"))


QUERIES = {f.__name__: f for f in (
    v_records, best_aligned, record_ids, absence_records, enum_drift, attribute_population, thin_attributes, gold_availability, vocab_distinct, vocab_compose, vocab_apply,
    verdict_merge, judge_calibration, trust_by_class, judge_requests, label_sample, document_sample, run_summary, only_missing, next_run_number)}

_POP = """pop AS (
    SELECT t.extraction_class, t.k AS attribute, round(count(*) FILTER (v IS NOT NULL AND v NOT IN ('', 'not_stated')) / max(n), 3) AS share
    FROM (SELECT extraction_class, unnest(map_keys(attributes)) AS k, unnest(map_values(attributes)) AS v FROM records WHERE source_quote <> '') t
    JOIN (SELECT extraction_class, count(*) AS n FROM records WHERE source_quote <> '' GROUP BY 1) c ON c.extraction_class = t.extraction_class GROUP BY 1, 2)"""
_VOC = "voc AS (SELECT value_set, unnest(known_as) AS surface_form, canonical_form FROM canonical_values)"

SQL = {
    "v_records": f"WITH {_LATEST} SELECT record_id, doc_id, doc_type, group_key, pub_date, l.venue, extraction_class, judge_verdict FROM records r JOIN latest l USING (doc_id) WHERE judge_verdict IS DISTINCT FROM 'rejected'",
    "best_aligned": """
        SELECT DISTINCT ON (doc_id, extraction_class, char_start, char_end) record_id, doc_id, extraction_class, char_start, char_end, alignment_status FROM records
        ORDER BY doc_id, extraction_class, char_start, char_end, CASE alignment_status WHEN 'match_exact' THEN 1 WHEN 'match_fuzzy' THEN 2 ELSE 3 END, record_id""",
    "record_ids": "SELECT DISTINCT record_id, substr(sha1(doc_id || extraction_class || char_start || char_end || run_id), 1, 16) AS made_id FROM records",
    "absence_records": """
        WITH w AS (SELECT DISTINCT doc_id, c.cls AS extraction_class FROM parsed_documents, (VALUES ('data_availability'), ('object_format')) AS c(cls) WHERE text <> '')
        SELECT substr(sha1(doc_id || extraction_class || '00run_1'), 1, 16) AS record_id, doc_id, extraction_class, '' AS source_quote, 0 AS char_start, 0 AS char_end,
               'none' AS source_section, 'match_exact' AS alignment_status, 'no_statement' AS statement, CASE extraction_class WHEN 'object_format' THEN 3 ELSE 5 END AS n_attributes
        FROM w WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.doc_id = w.doc_id AND r.extraction_class = w.extraction_class)""",
    "enum_drift": """
        SELECT concat_ws(';', CASE WHEN attributes['access_tier'] NOT IN ('open', 'controlled', 'registered') THEN 'access_tier=' || attributes['access_tier'] END,
                              CASE WHEN attributes['direction'] NOT IN ('released', 'acquired') THEN 'direction=' || attributes['direction'] END) AS drift,
               array_to_string(enum_drift, ';') AS stored, count(*) AS n FROM records WHERE extraction_class = 'data_availability' GROUP BY 1, 2""",
    "attribute_population": f"WITH {_POP} SELECT * FROM pop",
    "thin_attributes": f"WITH {_POP} SELECT * FROM pop WHERE share < 0.75 ORDER BY extraction_class, attribute LIMIT 12",
    "gold_availability": f"""
        WITH {_LATEST}
        SELECT record_id, r.doc_id, doc_type, coalesce(attributes['accession'], '') AS accession, coalesce(attributes['repository'], '') AS repository, coalesce(attributes['access_tier'], '') AS access_tier,
               coalesce(attributes['direction'], '') AS direction, coalesce(attributes['statement_kind'], '') AS statement_kind, coalesce(attributes_canonical['repository'], '') AS canonical_repository,
               source_section, coalesce(array_to_string(enum_drift, ';'), '') AS enum_drift, run_id
        FROM records r LEFT JOIN latest l ON l.doc_id = r.doc_id WHERE extraction_class = 'data_availability' AND judge_verdict IS DISTINCT FROM 'rejected'""",
    "vocab_distinct": " UNION ".join(f"SELECT '{s}' AS value_set, attributes['{a}'] AS surface_form FROM records WHERE attributes['{a}'] NOT IN ('', 'not_stated', 'no_statement')" for a, s in SETS.items()),
    "vocab_compose": f"""
        WITH {_VOC} SELECT v.value_set, v.surface_form, coalesce(split_part(c.canonical_form, ' ', 1), v.canonical_form) AS canonical_form
        FROM voc v LEFT JOIN canonical_values c ON c.value_set = 'platform' AND v.value_set = 'platform' AND c.canonical_form = v.canonical_form""",
    "vocab_apply": f"WITH {_VOC}, r AS (SELECT DISTINCT ON (record_id) record_id, attributes FROM records ORDER BY record_id) SELECT record_id, " + ", ".join(
        f"coalesce((SELECT min(canonical_form) FROM voc WHERE value_set = '{s}' AND surface_form = attributes['{a}']), attributes['{a}']) AS canonical_{a}" for a, s in SETS.items()) + " FROM r",
    "verdict_merge": """
        WITH v AS (SELECT DISTINCT ON (record_id) record_id, judge_verdict, judge_confidence, judge_reason FROM records WHERE judge_verdict IS NOT NULL ORDER BY record_id, strftime(loaded_at, '%Y%m%d%H%M%S') DESC, judge_verdict DESC)
        SELECT record_id, judge_verdict, judge_confidence, judge_reason FROM (SELECT DISTINCT record_id FROM records) LEFT JOIN v USING (record_id)""",
    "judge_calibration": """
        WITH r AS (SELECT DISTINCT record_id, judge_verdict AS v, candidate_support AS t FROM records WHERE source_quote <> '' AND judge_verdict IN ('confirmed', 'rejected') AND candidate_support IS NOT NULL),
        c AS (SELECT count(*) FILTER (v = 'confirmed' AND t) AS tp, count(*) FILTER (v = 'confirmed' AND NOT t) AS fp, count(*) FILTER (v = 'rejected' AND t) AS fn, count(*) FILTER (v = 'rejected' AND NOT t) AS tn FROM r)
        SELECT *, round(tp / nullif(tp + fp, 0), 4) AS precision, round(tp / nullif(tp + fn, 0), 4) AS recall FROM c""",
    "trust_by_class": """
        SELECT extraction_class, count(*) AS n_all, count(*) FILTER (judge_verdict IS DISTINCT FROM 'rejected') AS n_kept, count(judge_verdict) AS n_judged,
               count(*) FILTER (candidate_support) AS n_supported, round(count(*) FILTER (judge_verdict = 'confirmed') / nullif(count(judge_verdict), 0), 3) AS confirmed_share FROM records GROUP BY 1""",
    "judge_requests": """
        WITH r AS (SELECT DISTINCT doc_id, record_id, extraction_class, source_quote FROM records WHERE source_quote <> '' AND doc_id IS NOT NULL),
        p AS (SELECT *, CAST('0x' || substr(md5(record_id), 1, 8) AS BIGINT) % CAST(ceil(count(*) OVER (PARTITION BY doc_id) / 200.0) AS BIGINT) AS part FROM r),
        b AS (SELECT doc_id, part, count(*) AS n_records, md5(string_agg(record_id || ' | ' || extraction_class || ' | ' || source_quote, chr(10) ORDER BY record_id, record_id || ' | ' || extraction_class || ' | ' || source_quote)) AS prompt_digest FROM p GROUP BY ALL)
        SELECT doc_id, part, n_records, (SELECT count(DISTINCT value) FROM candidates c WHERE c.doc_id = b.doc_id) AS n_values, prompt_digest FROM b""",
    "label_sample": """
        SELECT DISTINCT record_id, doc_id, extraction_class, candidate_support FROM records WHERE source_quote <> ''
        ORDER BY coalesce(candidate_support, false) DESC, md5('labels_1' || record_id), record_id LIMIT 200""",
    "document_sample": "SELECT doc_id FROM (SELECT DISTINCT doc_id FROM parsed_documents) ORDER BY md5('nacre_availability_sample_50' || doc_id), doc_id LIMIT 50",
    "run_summary": """
        SELECT run_id, count(*) AS records, count(*) FILTER (source_quote = '') AS absences, count(*) FILTER (source_quote <> '' AND alignment_status = 'match_exact') AS match_exact,
               count(*) FILTER (source_quote <> '' AND alignment_status = 'match_fuzzy') AS match_fuzzy, count(*) FILTER (source_quote <> '' AND alignment_status = 'match_lesser') AS match_lesser,
               count(DISTINCT doc_id) AS n_docs FROM records GROUP BY run_id""",
    "only_missing": "SELECT doc_id FROM parsed_documents WHERE text <> '' AND doc_id NOT IN (SELECT doc_id FROM records WHERE pass_name = 'availability' AND doc_id IS NOT NULL)",
    "next_run_number": r"SELECT pass_name, regexp_extract(run_id, '_(\d{8})_\d+$', 1) AS day, max(TRY_CAST(regexp_extract(run_id, '_(\d+)$', 1) AS INT)) + 1 AS next_number FROM records GROUP BY 1, 2",
}
