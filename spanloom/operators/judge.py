"""Judging records: requests with contexts and candidates, verdicts with what was bad, and silver rebuilt from both."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spanloom.operators.acquire import answered
from spanloom.operators.passes import estimate, request_config
from spanloom.operators.records import apply_vocabulary, merge_verdicts, surface_values
from spanloom.operators.runs import Plan
from spanloom.operators.spans import context

#: What a judge may say, how much of the text around a quotation it sees, and the cap of its answer.
VERDICTS = ["confirmed", "rejected", "uncertain"]
AROUND, MOST_OUTPUT = 400, 32_768
SCHEMA = {"type": "OBJECT", "properties": {"verdicts": {"type": "ARRAY", "items": {"type": "OBJECT", "properties": {
    "record_id": {"type": "STRING"}, "verdict": {"type": "STRING", "enum": VERDICTS}, "confidence": {"type": "NUMBER"}, "reason": {"type": "STRING"}},
    "required": ["record_id", "verdict", "confidence", "reason"]}}}, "required": ["verdicts"]}
FRAME = "\n".join([
    "Check facts that another model took from one publication.", "Does the quotation, read in its context, support the fact's class and attributes?",
    "confirmed: it does; rejected: it does not, or the attributes misread it; uncertain: the text is open.",
    "Give one verdict for every record_id as it stands, a confidence from 0 to 1 and a reason of one sentence.",
    "Strings found in the document by patterns (they tell where, not what):"])


def judge_requests(records: DataFrame, parsed: DataFrame, candidates: DataFrame, judge_model: str, extractor_model: str, size: int = 200) -> DataFrame:
    """(key, doc_id, part, n_records, request): a document's quoted records with contexts and its distinct candidates, in parts of
    about ``size`` records by hash of their id.

    The judge must be another model than the extractor.  A text meets its records' positions once; contexts, not texts, are
    gathered.  A document's distinct candidates are strings of its text, which bounds them.
    """
    if judge_model == extractor_model:
        raise ValueError(f"the judge must not be the extractor's model ({extractor_model})")
    r = records.where("source_quote <> ''").select("doc_id", "record_id", "extraction_class", "source_quote", "source_section", "attributes", "char_start", "char_end")
    r = r.groupBy("doc_id", "record_id").agg(F.min_by(F.struct("extraction_class", "source_quote", "source_section", F.to_json("attributes").alias("attributes"), "char_start", "char_end"),
                                                      F.struct("extraction_class", "char_start", "char_end", "source_quote")).alias("r")).select("doc_id", "record_id", "r.*")
    counts = r.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias("_parts"))
    r = r.join(counts, "doc_id").withColumn("part", F.pmod(F.conv(F.substring(F.md5(F.col("record_id").cast("binary")), 1, 8), 16, 10).cast("long"), "_parts")).drop("_parts")
    seen = context(F.col("text"), F.col("char_start"), F.col("char_end"), AROUND)
    r = r.join(parsed.select("doc_id", "text"), "doc_id", "left").withColumn("context", F.coalesce(F.when(F.col("char_start").isNotNull(), seen), F.lit(""))).drop("text")
    line = F.to_json(F.struct("record_id", "extraction_class", "source_quote", "source_section", "attributes", "context"))
    parts = r.groupBy("doc_id", "part").agg(F.array_sort(F.collect_list(F.struct("record_id", line.alias("line")))).alias("items"), F.count(F.lit(1)).alias("n_records"))
    found = candidates.select("doc_id", "kind", "value", "section").distinct().groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("kind", "value", "section")))).alias("found"))
    body = F.concat_ws("\n", F.lit(FRAME), F.coalesce("found", F.lit("(none)")), F.lit("Records:"), F.array_join(F.transform("items", lambda x: x["line"]), "\n"))
    contents = F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(body.alias("text"))).alias("parts")))
    request = F.struct(contents.alias("contents"), request_config(SCHEMA, MOST_OUTPUT).alias("generationConfig"))
    return parts.join(found, "doc_id", "left").select(F.concat_ws("|", "doc_id", "part").alias("key"), "doc_id", "part", "n_records", request.alias("request"))


def judge_trial(reqs: DataFrame, n: int = 2) -> DataFrame:
    """The requests of a trial: the fullest parts of ``n`` different documents."""
    first = reqs.groupBy("doc_id").agg(F.min_by(F.struct(*[F.col(c) for c in reqs.columns]), F.struct(-F.col("n_records"), "part")).alias("r")).select("r.*")
    return first.orderBy(F.desc("n_records"), "doc_id").limit(n)


def judge_plan(reqs: DataFrame, rates: tuple[float, float, float] = (1.0, 6.0, 8.0)) -> Plan:
    """Judge requests as a plan that is tried and submitted like any run; a part stands for a window without positions."""
    zero = F.lit(None).cast("int")
    made = reqs.select("key", "doc_id", F.col("part").cast("int").alias("window_index"), zero.alias("window_start"), zero.alias("window_end"), "request")
    return Plan(made, estimate(made, *rates), False)


def judge_passes(responses: DataFrame) -> DataFrame:
    """One row, ``ok``: every response of a judge's trial ended, and there is at least one known verdict."""
    s = verdict_summary(responses)
    return s.select(((F.col("bad_responses") == 0) & (F.col("confirmed") + F.col("rejected") + F.col("uncertain") > 0)).alias("ok"))


def _told(responses: DataFrame) -> DataFrame:
    kind = "struct<verdicts:array<struct<record_id:string,verdict:string,confidence:double,reason:string>>>"
    return responses.withColumn("v", F.from_json("body", kind)["verdicts"]).withColumn("good", (F.col("finish") == "STOP") & F.col("v").isNotNull())


def verdicts(responses: DataFrame, model: str, tag: str) -> DataFrame:
    """(record_id, verdict, confidence, reason, judge_model, tag) of responses that ended and name a known verdict."""
    told = _told(responses).where("good").select(F.explode("v").alias("v")).select("v.*")
    return told.where(F.col("verdict").isin(VERDICTS)).withColumns({"judge_model": F.lit(model), "tag": F.lit(tag)})


def verdict_summary(responses: DataFrame) -> DataFrame:
    """One row: verdicts of each kind, unknown verdicts, and responses that did not end or hold none."""
    of = lambda name: F.coalesce(F.sum(F.size(F.filter("v", lambda x: x["verdict"] == name))), F.lit(0)).alias(name)
    known = lambda x: F.coalesce(x["verdict"].isin(VERDICTS), F.lit(False))
    t = _told(responses)
    t = t.withColumn("v", F.when(F.col("good"), F.col("v")).otherwise(F.array().cast("array<struct<record_id:string,verdict:string,confidence:double,reason:string>>")))
    return t.agg(*map(of, VERDICTS), F.coalesce(F.sum(F.size(F.filter("v", lambda x: ~known(x)))), F.lit(0)).alias("unknown_verdicts"), F.count_if(~F.coalesce("good", F.lit(False))).alias("bad_responses"))


def normalise(bronze: DataFrame, answers: DataFrame, verdict_log: DataFrame, sets: dict[str, str], lists: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, silver): the surface values of all records with a service's answers, unanswered ones standing for themselves,
    and silver rebuilt from them."""
    by_set: dict[str, list[str]] = {}
    for attribute, value_set in sets.items():
        by_set.setdefault(value_set, []).append(attribute)
    vocabulary = answered(surface_values(bronze, by_set, lists), answers)
    return vocabulary, rebuild_silver(bronze, vocabulary, verdict_log, sets)


def rebuild_silver(bronze: DataFrame, vocabulary: DataFrame, verdict_log: DataFrame, sets: dict[str, str]) -> DataFrame:
    """Silver from bronze, vocabulary and verdicts alone: canonical values beside the raw ones, the last verdict of each record."""
    return merge_verdicts(apply_vocabulary(bronze, vocabulary, sets), verdict_log)
