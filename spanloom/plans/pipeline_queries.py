"""Registered queries of the pipeline: articles, requests, responses replayed from stored records, harvest, streams' batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.functions.text import abstract_from_index
from spanloom.operators import passes as P
from spanloom.operators.harvest import canary_picks, harvest
from spanloom.operators.runs import trial_priority
from spanloom.plans.quote_queries import _BARE, _TIERS
from spanloom.operators.spans import fixed_windows
from spanloom.sources.articles import parse_articles
from spanloom.sources.tables import table
from spanloom.streaming.ingest import windowed_counts

#: A pass over the classes of the test tables.
DEFINITION = {
    "pass": "availability", "version": "1.0",
    "classes": {
        "data_availability": {
            "description": "Where data named in the text can be had.",
            "attributes": {"accession": {}, "repository": {}, "access_tier": {"vocabulary": "tier"}, "direction": {"vocabulary": "direction"}, "statement_kind": {}},
            "absence_attributes": {"statement_kind": "no_statement"},
        },
        "object_format": {"description": "Formats of data objects.", "attributes": {"format": {}, "level": {"vocabulary": "level"}, "object_description": {}}},
    },
}
LISTS = {"tier": ["open", "controlled", "registered"], "direction": ["released", "acquired"], "level": ["raw", "processed", "derived"]}
PASS = P.Pass.of(DEFINITION, LISTS.__getitem__)


def _index(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "parsed_documents").select("doc_id", F.length("text").alias("n"))
    w = fixed_windows(p, F.col("n"))
    return w.select(F.concat_ws("|", "doc_id", "window_index", "window_start").alias("key"), "doc_id", "window_index", "window_start", "window_end")


def _responses(spark: SparkSession, root: str) -> DataFrame:
    """Stored records as the responses that would give them: each in the first window of its document that holds its
    start; a window's records come in up to 200 responses, so none gathers all of a much-cited document."""
    lines = []
    for name, c in PASS.classes.items():
        r = table(spark, root, "records").where((F.col("extraction_class") == name) & (F.col("evidence_scope") == "full_text")).where("source_quote <> ''")
        w = F.greatest(F.lit(0), F.floor((F.col("char_start") - 1500) / 28_500)).cast("int")
        item = F.to_json(F.struct("source_quote", *[F.col("attributes")[a].alias(a) for a in c.attributes]), {"ignoreNullFields": "false"})
        lines.append(r.select("doc_id", w.alias("w"), F.lit(name).alias("cls"), item.alias("item"), (F.conv(F.substring(F.md5(F.col("record_id").cast("binary")), 1, 8), 16, 10).cast("long") % 200).alias("salt")).distinct())
    rows = lines[0].unionByName(lines[1])
    lists = rows.groupBy("doc_id", "w", "salt").agg(*[
        F.concat(F.lit(f'"{n}": ['), F.array_join(F.array_sort(F.collect_list(F.when(F.col("cls") == n, F.col("item")))), ","), F.lit("]")).alias(n) for n in PASS.classes])
    body = F.concat(F.lit("{"), F.concat_ws(", ", *PASS.classes), F.lit("}"))
    return lists.select(
        F.concat_ws("|", "doc_id", "w", (F.col("w") * 28_500)).alias("key"), F.lit("STOP").alias("finish"), body.alias("body"), F.lit(1).alias("tokens_in"), F.lit(1).alias("tokens_out"))


def harvest_records(spark: SparkSession, root: str) -> DataFrame:
    out = harvest(_responses(spark, root), _index(spark, root), table(spark, root, "parsed_documents"), PASS, "run_1", table(spark, root, "candidates"))
    return out["records"].select("record_id", "doc_id", "extraction_class", "char_start", "char_end", "source_section", "alignment_status", "candidate_support", F.array_join("enum_drift", ";").alias("drift"))


def harvest_summary(spark: SparkSession, root: str) -> DataFrame:
    return harvest(_responses(spark, root), _index(spark, root), table(spark, root, "parsed_documents"), PASS, "run_1", table(spark, root, "candidates"))["summary"]


def requests_made(spark: SparkSession, root: str) -> DataFrame:
    """One request per window: key, prompt length beyond the fixed frame, and settings."""
    r = P.requests(table(spark, root, "parsed_documents"), PASS)
    frame = sum(map(len, PASS.prompt()))
    config = "request.generationConfig."
    return r.select("key", (F.length(F.col("request.contents")[0]["parts"][0]["text"]) - frame).alias("text_chars"), F.col(config + "temperature").cast("int").alias("temperature"),
                    F.col(config + "maxOutputTokens").cast("int").alias("most"), F.col(config + "responseMimeType").alias("mime"),
                    F.array_join(F.col(config + "responseSchema.properties.data_availability.items.required"), ";").alias("required"))


def request_estimate(spark: SparkSession, root: str) -> DataFrame:
    r = P.requests(table(spark, root, "parsed_documents"), PASS)
    return P.estimate(r, 1.0, 6.0, 8.0)


def canary(spark: SparkSession, root: str) -> DataFrame:
    """Two windows for a trial: those that name the community, then those that meet an availability section, then others."""
    parsed = table(spark, root, "parsed_documents")
    return canary_picks(trial_priority(P.requests(parsed, PASS), parsed, ["NACRE"]), "priority").select("doc_id", "window_index", "priority")


def articles_parsed(spark: SparkSession, root: str) -> DataFrame:
    """Parsed texts written as article XML, parsed again: the sections' labels and the number of characters."""
    p = table(spark, root, "parsed_documents").where("text <> ''")
    esc = lambda c: F.replace(F.replace(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", " "), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.array_join(F.transform("sections", lambda s: F.concat(
        F.lit("<sec><title>"), esc(F.coalesce(s["title"], F.lit(""))), F.lit("</title><p>"),
        esc(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])), F.lit("</p><fig><p>gone</p></fig></sec>"))), "")
    xml = F.concat(F.lit("<article><front><article-meta><article-title>"), esc(F.coalesce("doc_title", F.lit(""))), F.lit("</article-title></article-meta></front><body>"), F.coalesce(body, F.lit("")), F.lit("</body></article>"))
    out = parse_articles(p.select("doc_id", xml.cast("binary").alias("content")))
    return out.select("doc_id", F.array_join(F.transform("sections", lambda s: s["labels"][0]), ";").alias("labels"), F.col("error").isNull().alias("ok"))


def abstracts_rebuilt(spark: SparkSession, root: str) -> DataFrame:
    """Titles as inverted indexes (word -> positions) and back."""
    p = table(spark, root, "publications").where("title IS NOT NULL")
    words = p.select("row_id", "title", F.posexplode(F.split("title", " ")).alias("pos", "word"))
    index = words.groupBy("row_id", "word").agg(F.sort_array(F.collect_list("pos")).alias("at")).groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "at"))).alias("index"))
    return index.select("row_id", abstract_from_index(F.col("index")).alias("title"))


def events_by_hour(spark: SparkSession, root: str) -> DataFrame:
    return windowed_counts(table(spark, root, "events"), "ts", "event_type")


def json_attributes(spark: SparkSession, root: str) -> DataFrame:
    """Parsed and broken JSON properties."""
    e = table(spark, root, "events").select("event_type", F.get_json_object("props", "$.k").try_cast("double").alias("k"), F.try_parse_json("props").isNull().alias("broken"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("broken").alias("n_broken"), F.round(F.sum("k"), 4).alias("sum_k"))


QUERIES = {f.__name__: f for f in (harvest_records, harvest_summary, requests_made, request_estimate, canary, articles_parsed, abstracts_rebuilt, events_by_hour, json_attributes)}

_W = """w AS (SELECT doc_id, n, CAST(unnest(range(0, CASE WHEN n <= 30000 THEN 1 ELSE CAST(ceil((n - 1500) / 28500.0) AS INT) END)) AS INT) AS i FROM (SELECT doc_id, length(text) AS n FROM parsed_documents WHERE length(text) > 0))"""

_ATTRIBUTES = {"data_availability": ["accession", "repository", "access_tier", "direction", "statement_kind"], "object_format": ["format", "level", "object_description"]}


def _duck_json(names: list[str]) -> str:
    return "'{' || " + " || ',' || ".join(f"""'"{a}":' || coalesce('"' || replace(replace(attributes['{a}'], chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)) || '"', 'null')""" for a in names) + " || '}'"


# the stored records as answers, their quotations placed, the best of each span, and silence where every window of a document was answered
_HARVEST = f"""{_W},
    keys AS (SELECT doc_id, i FROM w),
    items AS (SELECT DISTINCT r.doc_id, CAST(greatest(0, floor((char_start - 1500) / 28500.0)) AS INT) AS i, extraction_class, source_quote, CAST('0x' || substr(md5(record_id), 1, 8) AS BIGINT) % 200 AS salt,
                     CASE extraction_class {" ".join(f"WHEN '{c}' THEN {_duck_json(names)}" for c, names in _ATTRIBUTES.items())} END AS att
              FROM records r WHERE extraction_class IN ('data_availability', 'object_format') AND evidence_scope = 'full_text' AND source_quote <> ''),
    answers AS (SELECT DISTINCT doc_id, i, salt, EXISTS (SELECT 1 FROM keys k WHERE k.doc_id = items.doc_id AND k.i = items.i) AS known FROM items),
    asked AS (SELECT doc_id || '|' || extraction_class || '|' || i || '|' || att AS record_id, doc_id, extraction_class, source_quote, i * 28500 AS hint, att, salt FROM items JOIN keys USING (doc_id, i)),
    q AS (SELECT DISTINCT record_id, doc_id, source_quote, hint, {_BARE} AS q FROM asked),
    {_TIERS},
    placed AS (SELECT DISTINCT a.doc_id, a.extraction_class, CAST(b.b.a AS INT) AS char_start, CAST(b.b.a + b.b.n AS INT) AS char_end, b.st AS alignment_status, a.att FROM asked a JOIN best b ON b.record_id = a.record_id AND b.source_quote = a.source_quote),
    one AS (SELECT DISTINCT ON (doc_id, extraction_class, char_start, char_end) * FROM placed ORDER BY doc_id, extraction_class, char_start, char_end, CASE alignment_status WHEN 'match_exact' THEN 1 WHEN 'match_fuzzy' THEN 2 ELSE 3 END, att),
    spans AS (SELECT doc_id, generate_subscripts(sections, 1) AS k, unnest(sections) AS s FROM parsed_documents),
    labelled AS (SELECT o.doc_id, o.extraction_class, o.char_start, o.char_end, arg_min(s.labels[1], (s."end" - s.start) * 10000 + k) AS label FROM one o JOIN spans ON spans.doc_id = o.doc_id AND s.start <= o.char_start AND o.char_start < s."end" GROUP BY ALL),
    made AS (SELECT o.* EXCLUDE (att), coalesce(label, 'unknown') AS source_section, EXISTS (SELECT 1 FROM candidates c WHERE c.doc_id = o.doc_id AND c.char_start >= o.char_start AND c.char_end <= o.char_end) AS candidate_support,
                    concat_ws(';', CASE WHEN att->>'access_tier' NOT IN ('open', 'controlled', 'registered') THEN 'access_tier=' || (att->>'access_tier') END,
                                   CASE WHEN att->>'direction' NOT IN ('released', 'acquired') THEN 'direction=' || (att->>'direction') END,
                                   CASE WHEN att->>'level' NOT IN ('raw', 'processed', 'derived') THEN 'level=' || (att->>'level') END) AS drift
             FROM (SELECT * REPLACE (regexp_replace(att, '[\\x00-\\x1f]', ' ', 'g') AS att) FROM one) o LEFT JOIN labelled l USING (doc_id, extraction_class, char_start, char_end)),
    silent AS (SELECT doc_id FROM keys GROUP BY doc_id HAVING count(*) = count(*) FILTER (EXISTS (SELECT 1 FROM answers a WHERE a.doc_id = keys.doc_id AND a.i = keys.i)) AND doc_id NOT IN (SELECT doc_id FROM made WHERE extraction_class = 'data_availability'))"""

SQL = {
    "requests_made": f"""WITH {_W} SELECT doc_id || '|' || i || '|' || (i * 28500) AS key, CAST(least(i * 28500 + 30000, n) - i * 28500 AS INT) AS text_chars, 0 AS temperature, 16384 AS most,
        'application/json' AS mime, 'source_quote;accession;repository;access_tier;direction;statement_kind' AS required FROM w""",
    "request_estimate": f"""WITH {_W}, c AS (SELECT count(*) AS n, CAST(floor(sum(least(i * 28500 + 30000, n) - i * 28500 + {sum(map(len, PASS.prompt()))}) / 4.15) AS BIGINT) AS t FROM w)
        SELECT n AS n_requests, t AS tokens_in, CAST(n * 400 * 9 AS BIGINT) AS tokens_out, round((t * 1.0 + n * 400 * 9 * 6.0) / 1e6, 6) AS cost FROM c""",
    "canary": f"""
        WITH {_W}, s AS (SELECT w.doc_id, w.i, i * 28500 AS a, least(i * 28500 + 30000, w.n) AS b, p.sections, contains(substr(p.text, i * 28500 + 1, 30000), 'NACRE') AS named FROM w JOIN parsed_documents p USING (doc_id)),
        r AS (SELECT doc_id, i, CASE WHEN named THEN 0 WHEN len(list_filter(sections, lambda x: (list_contains(x.labels, 'data_availability') OR list_contains(x.labels, 'code_availability')) AND x.start < b AND x."end" > a)) > 0 THEN 1 ELSE 2 END AS priority FROM s),
        f AS (SELECT DISTINCT ON (doc_id) doc_id, i AS window_index, priority FROM r ORDER BY doc_id, priority, i)
        SELECT * FROM f ORDER BY priority, doc_id LIMIT 2""",
    "harvest_records": f"""
        WITH {_HARVEST}
        SELECT substr(sha1(doc_id || extraction_class || char_start || char_end || 'run_1'), 1, 16) AS record_id, doc_id, extraction_class, char_start, char_end, source_section, alignment_status, candidate_support, drift FROM made
        UNION ALL SELECT substr(sha1(doc_id || 'data_availability00run_1'), 1, 16), doc_id, 'data_availability', 0, 0, 'none', 'match_exact', false, '' FROM silent""",
    "harvest_summary": f"""
        WITH {_HARVEST}
        SELECT 'run_1' AS run_id, (SELECT count(*) FROM answers) AS n_responses, (SELECT count(*) FROM answers) AS n_stop, CAST(1 AS DOUBLE) AS stop_share, 0 AS n_max_tokens,
               (SELECT count(*) FROM answers WHERE NOT known) AS n_unknown_keys, 0 AS n_invalid, (SELECT count(*) FROM answers) AS tokens_in, (SELECT count(*) FROM answers) AS tokens_out,
               (SELECT count(*) FROM made) AS extracted, (SELECT count(*) FROM silent) AS absences,
               (SELECT count(*) FROM asked a LEFT JOIN best b ON b.record_id = a.record_id AND b.source_quote = a.source_quote WHERE b.b IS NULL) AS rejected""",
    "articles_parsed": """
        SELECT doc_id, array_to_string(list_transform(sections, lambda s: CASE
            WHEN regexp_matches(s.title, '(?i)(\\bdata\\b[^.]{0,40}\\bavailab|\\bavailab[^.]{0,40}\\bdata\\b|\\bdata\\s+(access|sharing|deposition)|\\baccession\\s+(number|code)s?\\b)') THEN 'data_availability'
            WHEN regexp_matches(s.title, '(?i)(\\b(code|software)\\b[^.]{0,40}\\bavailab|\\bavailab[^.]{0,40}\\b(code|software)\\b)') THEN 'code_availability'
            WHEN regexp_matches(s.title, '(?i)(\\bmethods?\\b|\\bexperimental\\s+procedures\\b|\\bmaterials\\b|\\bstar\\W*methods\\b)') THEN 'methods'
            WHEN regexp_matches(s.title, '(?i)(\\bresults?\\b|\\bfindings\\b)') THEN 'results' WHEN regexp_matches(s.title, '(?i)(\\bdiscussion\\b|\\bconclusions?\\b)') THEN 'discussion'
            WHEN regexp_matches(s.title, '(?i)(\\bintroduction\\b|\\bbackground\\b)') THEN 'introduction' WHEN regexp_matches(s.title, '(?i)\\babstract\\b') THEN 'abstract' ELSE 'other' END), ';') AS labels, true AS ok
        FROM parsed_documents WHERE text <> ''""",
    "abstracts_rebuilt": "SELECT row_id, title FROM publications WHERE title IS NOT NULL",
    "events_by_hour": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "json_attributes": """
        SELECT event_type, count(*) AS n, count(*) FILTER (props IS NULL OR NOT json_valid(props)) AS n_broken, round(sum(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)), 4) AS sum_k FROM events GROUP BY 1""",
}
