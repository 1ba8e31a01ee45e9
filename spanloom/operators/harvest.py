"""Model responses to records: parse, align, label, check, deduplicate, and record silence."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.functions.ids import record_id, short_hash
from spanloom.operators.align import align
from spanloom.operators.passes import Pass
from spanloom.operators.records import absences, best_aligned
from spanloom.operators.spans import holds_any, section_at
from spanloom.plans.lineage import cut


def harvest(responses: DataFrame, key_index: DataFrame, parsed: DataFrame, p: Pass, run_id: str, candidates: DataFrame | None = None) -> dict[str, DataFrame]:
    """``records``, ``rejected`` and ``summary`` of one run.

    ``responses`` has key, finish, body, tokens_in, tokens_out; ``key_index`` key, doc_id, window_start.  A body that is no JSON
    rejects the response, an empty quotation or one that is not in the source rejects the item.  A record's quotation is the
    source's own stretch.  Silence is recorded for a class only where every window of the document gave a parsed response.
    Keys that are not in the index are counted and left out.
    """
    r = responses.join(key_index.select("key", "doc_id", "window_start"), "key", "left").withColumn("good", F.try_parse_json("body").isNotNull())
    r = with_issues(r, p)
    known = r.where("doc_id IS NOT NULL")
    lists = []
    for name, c in p.classes.items():
        attributes = lambda x, c=c: F.create_map(*[y for a in c.attributes for y in (F.lit(a), x[a])]) if c.attributes else F.create_map().cast("map<string,string>")
        items = F.transform(F.col("payload")[name], lambda x: F.struct(F.lit(name).alias("extraction_class"), F.trim(F.coalesce(x["source_quote"], F.lit(""))).alias("source_quote"), attributes(x).alias("attributes")))  # noqa: B023
        lists.append(F.coalesce(items, F.array().cast("array<struct<extraction_class:string,source_quote:string,attributes:map<string,string>>>")))
    items = known.where("good").withColumn("payload", F.from_json("body", p.payload_type())).select("doc_id", F.col("window_start").alias("hint"), F.explode(F.concat(*lists)).alias("i"))
    items = items.select("doc_id", "hint", "i.*")
    placed = cut(align(items.where("source_quote <> ''"), parsed))

    broken = known.where("NOT good").select(
        "doc_id", F.lit("*").alias("extraction_class"), F.substring("body", 1, 200).alias("source_quote"), F.create_map().cast("map<string,string>").alias("attributes"),
        F.when(F.col("finish") == "MAX_TOKENS", "truncated_max_tokens").otherwise("unparsable_response").alias("reject_reason"))
    empty = items.where("source_quote = ''").select("doc_id", "extraction_class", "source_quote", "attributes", F.lit("empty_quote").alias("reject_reason"))
    absent = placed.where("aligned_start IS NULL").select("doc_id", "extraction_class", "source_quote", "attributes", F.lit("quote_not_in_source").alias("reject_reason"))
    rejected = broken.unionByName(empty).unionByName(absent).withColumn("run_id", F.lit(run_id))
    rejected = rejected.withColumn("record_id", short_hash(F.col("doc_id"), F.col("extraction_class"), F.lit(-1), F.lit(-1), F.lit(run_id), F.col("source_quote")))

    found = placed.where("aligned_start IS NOT NULL").select(
        "doc_id", "extraction_class", F.col("aligned_quote").alias("source_quote"), F.col("aligned_start").alias("char_start"), F.col("aligned_end").alias("char_end"),
        F.col("aligned_status").alias("alignment_status"), "attributes")
    made = record_id(F.col("doc_id"), F.col("extraction_class"), F.col("char_start"), F.col("char_end"), F.lit(run_id))
    found = found.withColumns({"record_id": made, "run_id": F.lit(run_id)})
    best = section_at(best_aligned(found, [F.to_json("attributes")]), parsed, "char_start", "source_section")
    drifted = F.array().cast("array<string>")
    for name in p.classes:
        drifted = F.when(F.col("extraction_class") == name, p.drift(name, F.col("attributes"))).otherwise(drifted)
    best = best.withColumn("enum_drift", drifted)
    if candidates is not None:
        span = best.select("doc_id", F.col("char_start").alias("start"), F.col("char_end").alias("end"))
        held = holds_any(span, candidates.select("doc_id", F.col("char_start").alias("start"), F.col("char_end").alias("end")), ["doc_id"])
        held = held.select("doc_id", F.col("start").alias("char_start"), F.col("end").alias("char_end"), F.lit(True).alias("candidate_support"))
        best = best.join(held, ["doc_id", "char_start", "char_end"], "left").withColumn("candidate_support", F.coalesce("candidate_support", F.lit(False)))
    best = cut(best)
    defaults = {n: c.absence for n, c in p.classes.items() if c.absence}
    records = best
    if defaults:
        asked = key_index.join(known.where("good").select("key").distinct().withColumn("_ok", F.lit(1)), "key", "left").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count("_ok").alias("ok"))
        silent = absences(asked.where("n = ok"), best, defaults, {n: list(c.attributes) for n, c in p.classes.items()}, run_id)
        records = best.unionByName(silent.withColumn("enum_drift", F.array().cast("array<string>")), allowMissingColumns=True)
        if candidates is not None:
            records = records.withColumn("candidate_support", F.coalesce("candidate_support", F.lit(False)))
    share = lambda c: F.round(F.try_divide(c, F.count(F.lit(1))), 4)
    summary = r.agg(
        F.lit(run_id).alias("run_id"), F.count(F.lit(1)).alias("n_responses"), F.count_if(F.col("finish") == "STOP").alias("n_stop"), share(F.count_if(F.col("finish") == "STOP")).alias("stop_share"),
        F.count_if(F.col("finish") == "MAX_TOKENS").alias("n_max_tokens"), F.count_if(F.col("doc_id").isNull()).alias("n_unknown_keys"), F.count_if(F.size("issues") > 0).alias("n_invalid"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))
    counts = records.agg(F.count_if(F.col("source_quote") != "").alias("extracted"), F.count_if(F.col("source_quote") == "").alias("absences"))
    lost = rejected.agg(F.count(F.lit(1)).alias("rejected"))
    one = lambda df: df.withColumn("_k", F.lit(1))
    summary = one(summary).join(one(counts), "_k").join(one(lost), "_k").drop("_k")
    return {"records": records, "rejected": rejected, "summary": summary}


def finish_counts(responses: DataFrame) -> DataFrame:
    """(finish, n, tokens_in, tokens_out) of responses by how they ended."""
    return responses.groupBy("finish").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))


def with_issues(responses: DataFrame, p: Pass) -> DataFrame:
    """``responses`` with what is structurally wrong with each body (``issues``; a body that is no JSON is one issue); no shuffle."""
    columns = [c for c in responses.columns if c != "issues"]

    def wrong(body: str | None) -> list[str]:
        try:
            return p.issues(json.loads(body or ""))
        except ValueError:
            return ["no JSON"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([wrong(b) for b in batch.column("body").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), found], [*columns, "issues"])

    rows = responses.select(*columns)
    return rows.mapInArrow(run, rows.withColumn("issues", F.array().cast("array<string>")).schema)


def canary_picks(windows: DataFrame, priority: str, n: int = 2) -> DataFrame:
    """``n`` windows of different documents for a trial: per document its best by (priority, index), then the best documents."""
    first = windows.groupBy("doc_id").agg(F.min_by(F.struct(*[F.col(c) for c in windows.columns]), F.struct(priority, "window_index")).alias("w")).select("w.*")
    return first.orderBy(priority, "doc_id").limit(n)


def canary_passes(summary: DataFrame) -> DataFrame:
    """One row, ``ok``: every response ended and is as the pass wants it, and at least one quotation was found in its source."""
    return summary.select(((F.col("n_stop") == F.col("n_responses")) & (F.col("n_responses") > 0) & (F.col("n_invalid") == 0) & (F.col("extracted") > 0)).alias("ok"))
