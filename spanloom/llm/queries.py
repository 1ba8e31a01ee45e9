"""Registered queries of the training-data operators, over their whole tables and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.llm.canonical import map_values, respelt, typed_values
from spanloom.llm.lookalikes import CYRILLIC, CYRILLIC_AS, GREEK, GREEK_AS, OTHER, in_one_form, quoted_stretches
from spanloom.llm.markup import clean_texts
from spanloom.llm.packing import CAPACITY, pack
from spanloom.llm.representatives import represent
from spanloom.llm.subjects import fit
from spanloom.llm.tokenizer import encode
from spanloom.llm.windows import review_windows, split_texts
from spanloom.sources.tables import table


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return represent(table(spark, root, "publications"))["groups"].where("n_rows > 1").select("group_row", "survivor_row")


def p1_records(spark: SparkSession, root: str) -> DataFrame:
    return represent(table(spark, root, "publications"))["records"]


def p1_groups(spark: SparkSession, root: str) -> DataFrame:
    """Every group, single rows included: its survivor, its rows, and the flag and availability of its record."""
    return p1_records(spark, root).select("group_row", "survivor_row", "n_rows", "is_preprint", "oa_status")


def p1_values(spark: SparkSession, root: str) -> DataFrame:
    return represent(table(spark, root, "publications"))["values"]


def p1_quality(spark: SparkSession, root: str) -> DataFrame:
    return represent(table(spark, root, "publications"))["quality"]


def marked_texts(spark: SparkSession, root: str) -> DataFrame:
    """The texts of problem 2: (field, row_key, host, text); a publication's host is its venue."""
    parsed = table(spark, root, "parsed_documents").select(F.lit("text").alias("field"), F.col("doc_id").alias("row_key"), F.lit(None).cast("string").alias("host"), "text")
    pubs = table(spark, root, "publications")
    return parsed.unionByName(pubs.select(F.lit("abstract").alias("field"), F.col("row_id").cast("string").alias("row_key"), F.col("venue").alias("host"), F.col("abstract").alias("text")))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return clean_texts(marked_texts(spark, root)).select("field", "row_key")


def p2_clean(spark: SparkSession, root: str) -> DataFrame:
    """The clean text and the structure of every text that carries residue."""
    return clean_texts(marked_texts(spark, root))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    pairs = quoted_stretches(table(spark, root, "records"), table(spark, root, "parsed_documents"))
    formed = in_one_form(pairs.where("source_quote <> stretch"), ["source_quote", "stretch"])
    return formed.where("source_quote_form = stretch_form").select("record_id").distinct()


def p3_quotes(spark: SparkSession, root: str) -> DataFrame:
    """Every quotation and its stretch in one form."""
    pairs = quoted_stretches(table(spark, root, "records"), table(spark, root, "parsed_documents"))
    return in_one_form(pairs, ["source_quote", "stretch"]).select("record_id", "source_quote_form", "stretch_form").distinct()


def p3_texts(spark: SparkSession, root: str) -> DataFrame:
    """Every parsed text in one form."""
    return in_one_form(table(spark, root, "parsed_documents").select("doc_id", "text"), ["text"]).select("doc_id", "text_form")


VALUE_SETS = ["platform", "vendor", "repository", "format"]


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return respelt(typed_values(table(spark, root, "records"), VALUE_SETS), table(spark, root, "canonical_values"))


def p4_unmatched(spark: SparkSession, root: str) -> DataFrame:
    """Values that mean no entry, with their number of stored rows."""
    mapped = map_values(typed_values(table(spark, root, "records"), VALUE_SETS), table(spark, root, "canonical_values"))
    return mapped.where("canonical_id = 0").groupBy("value_set", "value").agg(F.count(F.lit(1)).alias("n"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return review_windows(table(spark, root, "read_windows"), table(spark, root, "parsed_documents")).select("doc_id", "window_index").distinct()


def p5_windows(spark: SparkSession, root: str) -> DataFrame:
    return split_texts(table(spark, root, "parsed_documents"))


def p7_ids(spark: SparkSession, root: str) -> DataFrame:
    return encode(table(spark, root, "documents"), "doc_id", "text")


def p8_assigned(spark: SparkSession, root: str) -> DataFrame:
    return pack(encode(table(spark, root, "documents"), "doc_id", "text", counts_only=True), "doc_id", "n_tokens")


def p8_sound(spark: SparkSession, root: str) -> DataFrame:
    """One row: documents placed, containers over their capacity, documents cut although they fit in one."""
    placed = p8_assigned(spark, root)
    per = placed.groupBy("container").agg(F.sum("piece_tokens").alias("used"))
    whole = placed.groupBy("doc_id", "copy").agg(F.sum("piece_tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    docs = whole.agg(F.count(F.lit(1)).alias("documents"), F.count_if((F.col("tokens") <= CAPACITY) & (F.col("pieces") > 1)).alias("cut"))
    return docs.withColumn("overfull", per.agg(F.count_if(F.col("used") > CAPACITY)).scalar())


def p8_fill(spark: SparkSession, root: str) -> DataFrame:
    """One row: containers, tokens, share of room used."""
    per = p8_assigned(spark, root).groupBy("container").agg(F.sum("piece_tokens").alias("used"), F.count(F.lit(1)).alias("items"))
    return per.agg(F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("tokens"),
                   F.max("used").alias("fullest"), F.round(F.avg("used") / CAPACITY, 6).alias("fill"))


def _subjects(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return fit(*(table(spark, root, t) for t in ("documents", "subject_areas", "subject_labels")))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return _subjects(spark, root)["assigned"].select("doc_id", "subject").distinct()


def p9_makeup(spark: SparkSession, root: str) -> DataFrame:
    """The corpus by subject: documents and sentences."""
    return _subjects(spark, root)["assigned"].distinct().groupBy("subject").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_subject").alias("sentences"))


def p9_quality(spark: SparkSession, root: str) -> DataFrame:
    """What the latent model learnt of each labelling function."""
    return _subjects(spark, root)["quality"]


QUERIES = {"p9_found": p9_found, "p9_makeup": p9_makeup, "p9_quality": p9_quality,
           "p5_found": p5_found, "p5_windows": p5_windows,
           "p2_found": p2_found, "p2_clean": p2_clean,
           "p3_found": p3_found, "p3_quotes": p3_quotes, "p3_texts": p3_texts, "p4_found": p4_found, "p4_unmatched": p4_unmatched,
           "p1_found": p1_found, "p1_records": p1_records, "p1_groups": p1_groups, "p1_values": p1_values, "p1_quality": p1_quality,
           "p7_ids": p7_ids, "p8_assigned": p8_assigned, "p8_fill": p8_fill, "p8_sound": p8_sound}

_P1_SQL = """
    WITH RECURSIVE rows_ AS (
        SELECT row_id, doc_id, coalesce(doc_id, 'row:' || row_id) AS work, merged_from, is_preprint, source_version, snapshot_date,
               CASE WHEN oa_status IS NULL THEN 'zz' ELSE regexp_replace(lower(oa_status), '[^a-z]', '', 'g') END AS st
        FROM publications),
    told AS (
        SELECT DISTINCT r.work AS a, 'W' || regexp_extract(m.x, '([0-9]+)', 1) AS b
        FROM rows_ r, unnest(r.merged_from) AS m(x) WHERE m.x IS NOT NULL),
    links AS (SELECT a, b FROM told WHERE a <> b AND b IN (SELECT work FROM rows_)
              UNION SELECT b, a FROM told WHERE a <> b AND b IN (SELECT work FROM rows_)),
    reach(a, b) AS (SELECT work, work FROM rows_ UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a AS work, min(b) AS comp FROM reach GROUP BY a),
    ranked AS (
        SELECT comp, row_id,
               CASE WHEN NOT is_preprint THEN 0 WHEN is_preprint THEN 2 ELSE 1 END AS r1,
               CASE st WHEN 'fulltext' THEN 0 WHEN 'abstractonly' THEN 1 WHEN 'preprintrequesterpayspending' THEN 2
                       WHEN 'unavailable' THEN 3 WHEN 'unresolved' THEN 4 WHEN 'zz' THEN 6 ELSE 5 END AS r2,
               coalesce(TRY_CAST(regexp_extract(source_version, '([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE), -1) AS r3,
               coalesce(strftime(coalesce(
                   TRY_CAST(substr(snapshot_date, 1, 10) AS DATE), try_strptime(snapshot_date, '%Y/%m/%d'), try_strptime(snapshot_date, '%Y%m%d'),
                   try_strptime(snapshot_date, '%d %B %Y'), try_strptime(snapshot_date, '%b %d, %Y')), '%Y%m%d'), '0') AS r4
        FROM rows_ JOIN least USING (work))
    SELECT min(row_id) AS group_row,
           first(row_id ORDER BY r1, r2, r3 DESC, r4 DESC, row_id) AS survivor_row
    FROM ranked GROUP BY comp HAVING count(*) > 1"""
_STATUS = ["fulltext", "abstract_only", "preprint_requester_pays_pending", "unavailable", "unresolved"]
_P1_GROUPS = _P1_SQL.replace("AS survivor_row\n    FROM ranked GROUP BY comp HAVING count(*) > 1", f"""AS survivor_row, count(*) AS n_rows,
           first(r1 = 2 ORDER BY r1, r2, r3 DESC, r4 DESC, row_id) FILTER (r1 <> 1) AS is_preprint,
           [{", ".join(f"'{x}'" for x in _STATUS)}][1 + first(r2 ORDER BY r1, r2, r3 DESC, r4 DESC, row_id) FILTER (r2 < 5)] AS oa_status
    FROM ranked GROUP BY comp""")

# The form of problem 3 spelt with DuckDB's own functions, from the same fixed values.
_WIDE = ("".join(chr(c) for c in range(0xFF01, 0xFF5F)), "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)))
_BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\u2028\u2029\t\n\v\f\r\u0085"
_FROM = _WIDE[0] + CYRILLIC + GREEK + _BLANKS + "\u2010\u2011\u00b5"
_TO = _WIDE[1] + CYRILLIC_AS + GREEK_AS + " " * len(_BLANKS) + "--\u03bc"


def _form_sql(x: str) -> str:
    out = f"regexp_replace({x}, '[\\u00ad\\u200b-\\u200f\\u202a-\\u202e\\u2060-\\u2064\\ufeff\\ufe00-\\ufe0f]', '', 'g')".encode().decode("unicode_escape")
    out = "translate({}, '{}', '{}')".format(out, _FROM.replace("'", "''"), _TO.replace("'", "''"))
    for a, b in OTHER.items():
        if len(b) > 1:
            out = f"replace({out}, '{a}', '{b}')"
    return f"nfc_normalize({out})"


_P3_SQL = f"""
    SELECT DISTINCT r.record_id FROM records r JOIN parsed_documents p USING (doc_id),
         LATERAL (SELECT substr(p.text, r.char_start + 1, r.char_end - r.char_start) AS stretch) s
    WHERE r.char_start >= 0 AND r.char_end >= r.char_start AND s.stretch <> r.source_quote
      AND {_form_sql('s.stretch')} = {_form_sql('r.source_quote')}"""

_P5_SQL = """
    WITH w AS (
        SELECT doc_id, window_index, window_start, window_end, text,
               lag(window_end) OVER (PARTITION BY doc_id ORDER BY window_index, window_start, window_end) AS last_end
        FROM read_windows LEFT JOIN parsed_documents USING (doc_id))
    SELECT DISTINCT doc_id, window_index FROM w
    WHERE window_end - window_start > 30000 OR window_end > length(text) OR window_start <> last_end - 1500
       OR (window_end < length(text) AND regexp_matches(substr(text, window_end, 2), '^[\\p{L}\\p{N}]{2}$'))"""

SQL: dict[str, str] = {"p1_groups": _P1_GROUPS, "p8_sound": "SELECT count(*) AS documents, 0 AS cut, 0 AS overfull FROM documents", "p5_found": _P5_SQL, "p1_found": _P1_SQL, "p3_found": _P3_SQL}
