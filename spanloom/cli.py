"""Command line over the library: ``python -m spanloom.cli COMMAND ...``; tables are Parquet under one root."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators import align, candidates, document_sets, judge, passes, records, runs, spans
from spanloom.operators.harvest import canary_passes, harvest
from spanloom.plans import registry
from spanloom.plans.ship import ship
from spanloom.plans.work_queries import VIEW_COLUMNS, _latest
from spanloom.sources import articles, files
from spanloom.sources.tables import table


def _save(df: DataFrame, out: str) -> None:
    df.write.mode("overwrite").parquet(out)


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="spanloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *names: str, **optional: object) -> None:
        c = sub.add_parser(name, help=about)
        for n in names:
            c.add_argument(n)
        for n, default in optional.items():
            c.add_argument(f"--{n.replace('_', '-')}", default=default, type=type(default) if default is not None else str)

    command("parse", "article files to parsed_documents", "folder", "out")
    command("candidates", "pattern hits in parsed texts", "root", "patterns", "out")
    command("windows", "fixed windows of parsed texts", "root", "out", size=30_000, overlap=1_500)
    command("extract", "requests of a pass, tried by stored responses and submitted", "root", "pass_file", "vocabularies", "out", sample=0, doc_type="corpus", run="", community="nacre", model="strong", dry_run=0, only_missing=0, skip_trial=0, trial_responses="")
    command("status", "a run's last row", "out", "run")
    command("estimate", "tokens and cost of requests", "requests", rate_in=1.0, rate_out=6.0, thinking=8.0)
    command("collect", "responses to records", "root", "pass_file", "vocabularies", "requests", "responses", "run", "out")
    command("align", "place quotations in their texts", "root", "out")
    command("normalise", "apply a vocabulary beside the raw values", "root", "vocabulary", "sets", "out")
    command("judge", "requests for the judge", "root", "out", judge_model="judge", extractor_model="strong")
    command("judge-collect", "verdicts of responses, and silver rebuilt from them", "root", "responses", "vocabulary", "sets", "model", "tag", "out")
    command("label-sample", "records for labelling", "root", "out", n=200, seed="labels_1")
    command("gold", "the flat table of a class, with the columns its records have or those named", "root", "cls", "out", attributes="")
    command("report", "every figure table and a manifest", "root", "out")
    command("query", "one registered query", "root", "name", "out")
    command("list", "the registered queries")
    a = top.parse_args(argv)
    if a.command == "list":
        print(*registry.queries(), sep="\n")
        return 0
    spark = SparkSession.builder.appName("spanloom").getOrCreate()
    ship(spark)
    t = lambda name: table(spark, a.root, name)
    if a.command == "parse":
        _save(articles.parse_articles(files.read_articles(spark, a.folder)), a.out)
    elif a.command == "candidates":
        _save(candidates.find_spans(t("parsed_documents"), json.loads(a.patterns)), a.out)
    elif a.command == "windows":
        _save(spans.fixed_windows(t("parsed_documents").select("doc_id", F.length("text").alias("n")), F.col("n"), a.size, a.overlap), a.out)
    elif a.command == "extract":
        p = passes.Pass.load(a.pass_file, a.vocabularies)
        anchors = candidates.anchors(t("candidates"), candidates.known_values(t("records"), t("candidates"), t("corpus_seed")), []) if p.text_source == "anchors" else None
        texts, windows = document_sets.texts_of(p, a.doc_type, t("publications"), t("parsed_documents"), anchors)
        covered = runs.covered_by(spark.read.parquet(f"{a.out}/key_index"), spark.read.parquet(f"{a.out}/runs"), p.name) if a.only_missing else None

        def trial(made: runs.Plan) -> DataFrame:
            told = files.read_responses(files.read_jsonl(spark, a.trial_responses, files.RESPONSE))
            return canary_passes(harvest(told, made.requests, texts, p, "trial")["summary"])

        runs.extract(p, texts, windows, run_id=a.run, community=a.community, model=a.model, folder=a.out, trial=trial, dry_run=bool(a.dry_run), skip_trial=bool(a.skip_trial),
                     covered=covered, sample=a.sample or None).show(truncate=False)
    elif a.command == "status":
        print(json.dumps(runs.run_row(spark.read.parquet(f"{a.out}/runs"), a.run), default=str))
    elif a.command == "estimate":
        passes.estimate(spark.read.parquet(a.requests), a.rate_in, a.rate_out, a.thinking).show(truncate=False)
    elif a.command == "collect":
        done = harvest(files.read_responses(files.read_jsonl(spark, a.responses, files.RESPONSE)), spark.read.parquet(a.requests), t("parsed_documents"),
                       passes.Pass.load(a.pass_file, a.vocabularies), a.run, t("candidates"))
        for name, df in done.items():
            _save(df, f"{a.out}/{name}_{a.run}.parquet")
    elif a.command == "align":
        _save(align.align(t("records").select("record_id", "doc_id", "source_quote", F.col("char_start").alias("hint")), t("parsed_documents")), a.out)
    elif a.command == "normalise":
        _save(records.apply_vocabulary(t("records"), spark.read.parquet(a.vocabulary), json.loads(a.sets)), a.out)
    elif a.command == "judge":
        _save(judge.judge_requests(t("records").where("doc_id IS NOT NULL"), t("parsed_documents"), t("candidates"), a.judge_model, a.extractor_model), a.out)
    elif a.command == "judge-collect":
        told = files.read_responses(files.read_jsonl(spark, a.responses, files.RESPONSE))
        _save(log := judge.verdicts(told, a.model, a.tag), f"{a.out}/verdicts_{a.tag}")
        judge.verdict_summary(told).show(truncate=False)
        _save(judge.rebuild_silver(t("records"), spark.read.parquet(a.vocabulary), log, json.loads(a.sets)), f"{a.out}/silver")
    elif a.command == "label-sample":
        files.write_gold_csv(records.seeded_sample(t("records").where("source_quote <> ''").select("record_id", "doc_id", "extraction_class", "source_quote", "candidate_support").distinct(),
                                                   "record_id", a.n, a.seed, F.col("candidate_support")), a.out)
    elif a.command == "gold":
        files.write_gold_csv(records.gold_table(t("records"), _latest(spark, a.root, *VIEW_COLUMNS), a.cls, a.attributes.split(",") if a.attributes else None), a.out)
    elif a.command == "report":
        from spanloom.plans import figure_queries

        entries = {}
        for name, f in figure_queries.QUERIES.items():
            files.write_gold_csv(df := f(spark, a.root), f"{a.out}/{name}.csv")
            entries[name] = {"columns": df.columns}
        files.merge_manifest(f"{a.out}/manifest.json", entries)
    elif a.command == "query":
        _save(registry.queries()[a.name](spark, a.root), a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
