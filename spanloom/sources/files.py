"""Scans and sinks: JSON lines, CSV, article files, per-run layers; atomic writes by Spark's commit protocol."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.functions.text import file_version

# Explicit schemas (DDL); nothing is inferred.
RECORD = (
    "record_id string, run_id string, doc_id string, community string, pass_name string, extraction_class string, source_quote string, char_start int, char_end int, "
    "source_section string, alignment_status string, attributes map<string,string>, attributes_canonical map<string,string>, enum_drift array<string>, candidate_support boolean, "
    "judge_verdict string, judge_confidence double, judge_reason string, extractor_model string, prompt_version string, schema_version string, evidence_scope string")
REJECTED = RECORD + ", reject_reason string"
SEED = "pmid string, doi string, pmcid string, title string, centre string, grant_numbers string"
RESPONSE = (
    "key string, custom_id string, response struct<candidates:array<struct<finishReason:string,content:struct<parts:array<struct<text:string>>>>>,"
    "usageMetadata:struct<promptTokenCount:int,candidatesTokenCount:int,thoughtsTokenCount:int>>")


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines under an explicit schema: fields missing from a file are null, blank lines are skipped."""
    return spark.read.schema(schema).json(paths)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV with header; without a schema every column is a string (no inference)."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, version, content) of article files; of several versions of one id the highest number is kept."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select(F.regexp_extract(name, r"^([^.]+)", 1).alias("doc_id"), file_version(name).alias("version"), "content")
    return rows.groupBy("doc_id").agg(F.max_by(F.struct("version", "content"), F.coalesce(F.col("version").try_cast("int"), F.lit(0))).alias("r")).select("doc_id", "r.*")


def first_held(*sources: DataFrame) -> DataFrame:
    """(doc_id, version, content, source) of article files: the first of the sources (local, cache, remote) that holds a document,
    and of its versions there the highest number."""
    ranked = [s.select("doc_id", "version", "content", F.lit(i).alias("source")) for i, s in enumerate(sources)]
    every = ranked[0]
    for more in ranked[1:]:
        every = every.unionByName(more)
    best = F.max_by(F.struct("version", "content", "source"), F.struct((-F.col("source")).alias("s"), F.coalesce(F.col("version").try_cast("int"), F.lit(0)).alias("v")))
    return every.groupBy("doc_id").agg(best.alias("r")).select("doc_id", "r.*")


def read_many(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON lines of several places as one table by name: a column that one place lacks is null there, one that only it has is left out."""
    return spark.read.schema(schema).json(paths)


def read_responses(responses: DataFrame) -> DataFrame:
    """(key, finish, body, tokens_in, tokens_out) of model responses; thinking counts as output."""
    first = F.get(F.col("response.candidates"), F.lit(0))
    use = F.col("response.usageMetadata")
    zero = F.lit(0)
    return responses.select(
        F.coalesce("key", "custom_id", F.lit("")).alias("key"), F.coalesce(first["finishReason"], F.lit("NONE")).alias("finish"),
        F.array_join(F.transform(first["content"]["parts"], lambda p: F.coalesce(p["text"], F.lit(""))), "").alias("body"),
        F.coalesce(use["promptTokenCount"], zero).alias("tokens_in"), (F.coalesce(use["candidatesTokenCount"], zero) + F.coalesce(use["thoughtsTokenCount"], zero)).alias("tokens_out"))


def records_of_runs(silver: DataFrame, bronze: DataFrame, runs: list[str]) -> DataFrame:
    """Records of the named runs, from silver where a run is there, else from bronze; a run in neither raises."""
    s = silver.where(F.col("run_id").isin(runs))
    done = {r[0] for r in s.select("run_id").distinct().collect()}
    b = bronze.where(F.col("run_id").isin([r for r in runs if r not in done]))
    left = set(runs) - done - {r[0] for r in b.select("run_id").distinct().collect()}
    if left:
        raise FileNotFoundError(f"no records of runs {sorted(left)}")
    return s.unionByName(b, allowMissingColumns=True)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, nulls kept; Spark's commit makes the result appear whole or not at all."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_gold_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def gold_views(spark: SparkSession, folder: str, classes: list[str]) -> list[str]:
    """A temporary view for every class whose gold table is in ``folder`` (``gold_CLASS``), all columns strings, empty cells empty texts."""
    made = []
    for name in classes:
        df = read_csv(spark, f"{folder}/gold_{name}")
        df.na.fill("").createOrReplaceTempView(name)
        made.append(name)
    return made


def append_new(df: DataFrame, existing: DataFrame | None, key: str, path: str) -> None:
    """Append only rows whose key is not there yet, so that a repeated run adds nothing."""
    (df if existing is None else df.join(existing.select(key), key, "left_anti")).write.mode("append").parquet(path)


def merge_manifest(path: str, entries: dict[str, dict]) -> dict:
    """Update a small JSON manifest of figures, by figure."""
    file = Path(path)
    merged = (json.loads(file.read_text()) if file.exists() else {}) | entries
    file.write_text(json.dumps(merged, indent=2, sort_keys=True))
    return merged
