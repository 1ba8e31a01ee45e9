"""Runs of a pass: planning, trial gate, submission with its run and key index, stored responses, and what runs have covered."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.operators.acquire import attempted
from spanloom.operators.passes import Pass, estimate, requests
from spanloom.operators.records import seeded_sample

RUN = (
    "run_id string, community string, pass_name string, model string, prompt_version string, schema_version string, submitted_at string, n_requests long, tokens_in long, "
    "tokens_out long, cost double, canary_passed boolean, job string, status string, is_sample boolean, sections_read array<string>")


@dataclass
class Plan:
    """What would be sent: the requests and their estimate (one row)."""

    requests: DataFrame
    estimate: DataFrame
    is_sample: bool


def plan(p: Pass, texts: DataFrame, windows: DataFrame | None = None, *, covered: DataFrame | None = None, sample: int | None = None, seed: str = "",
         preamble: str | None = None, rates: tuple[float, float, float] = (1.0, 6.0, 8.0)) -> Plan:
    """The requests of a pass over ``texts``, without documents in ``covered`` (doc_id), or over a seeded sample of documents."""
    if covered is not None:
        texts = texts.join(covered.select("doc_id").distinct(), "doc_id", "left_anti")
    if sample is not None:
        chosen = seeded_sample(texts.select("doc_id").distinct(), "doc_id", sample, seed or f"{p.name}_sample_{sample}")
        texts = texts.join(chosen, "doc_id", "left_semi")
    made = requests(texts, p, windows, preamble)
    return Plan(made, estimate(made, *rates), sample is not None)


def covered_by(key_index: DataFrame, runs: DataFrame, pass_name: str) -> DataFrame:
    """Documents that need not be asked again: those of runs that were neither cancelled nor samples."""
    return attempted(key_index, runs, pass_name)


def trial_priority(reqs: DataFrame, parsed: DataFrame, names: list[str] = ()) -> DataFrame:
    """(key, doc_id, window_index, priority): 0 where the window names the community, 1 where it meets an availability section, else 2."""
    w = reqs.select("key", "doc_id", "window_index", "window_start", "window_end").join(parsed.select("doc_id", "sections", "text"), "doc_id", "left")
    told = F.substring("text", F.col("window_start") + 1, F.col("window_end") - F.col("window_start"))
    named = F.lit(False)
    for n in names:
        named = named | F.contains(told, F.lit(n))
    meets = F.exists("sections", lambda s: F.arrays_overlap(s["labels"], F.array(F.lit("data_availability"), F.lit("code_availability"))) & (s["start"] < F.col("window_end")) & (s["end"] > F.col("window_start")))
    rank = F.when(F.coalesce(named, F.lit(False)), 0).when(F.coalesce(meets, F.lit(False)), 1).otherwise(2)
    return w.select("key", "doc_id", "window_index", rank.alias("priority"))


def gate(ok: DataFrame | None, skip: bool = False) -> bool:
    """Did the trial pass?  A skipped one counts as not passed but lets the run go on; a failed one raises."""
    if skip:
        return False
    if ok is None or not ok.first()["ok"]:
        raise RuntimeError("the trial failed: nothing is submitted")
    return True


def submit(made: Plan, p: Pass, run_id: str, community: str, model: str, folder: str, canary_passed: bool, job: str = "") -> DataFrame:
    """Write the requests as JSON lines, then append the run and its key index; the run's row comes back.

    A run id is written once: existing requests raise before anything is appended.
    """
    spark: SparkSession = made.requests.sparkSession
    made.requests.select("key", "request").write.mode("errorifexists").option("ignoreNullFields", False).json(f"{folder}/requests/{run_id}")
    made.requests.select(F.lit(run_id).alias("run_id"), "key", "doc_id", "window_index", "window_start", "window_end").write.mode("append").parquet(f"{folder}/key_index")
    e = made.estimate.first()
    row = (run_id, community, p.name, model, p.version, p.version, datetime.now(timezone.utc).isoformat(), e["n_requests"], e["tokens_in"], e["tokens_out"], e["cost"], canary_passed, job,
           "submitted", made.is_sample, p.sections)
    df = spark.createDataFrame([row], RUN)
    df.write.mode("append").parquet(f"{folder}/runs")
    return df


def run_row(runs: DataFrame, run_id: str) -> dict:
    """A run's last row; raises where there is none."""
    found = runs.where(F.col("run_id") == run_id).orderBy(F.desc("submitted_at")).limit(1).collect()
    if not found:
        raise FileNotFoundError(f"no run {run_id}")
    return found[0].asDict()


def store_responses(responses: DataFrame, folder: str, run_id: str, state: str) -> str:
    """Keep a finished job's responses, once: what is there stays; a job that has not succeeded raises."""
    path = f"{folder}/responses/{run_id}"
    jvm = responses.sparkSession._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if at.getFileSystem(responses.sparkSession._jsc.hadoopConfiguration()).exists(at):
        return path
    if "SUCCEEDED" not in state:
        raise RuntimeError(f"the job's state is {state}: nothing is collected")
    responses.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return path


def summaries_of_runs(summaries: DataFrame, runs: DataFrame) -> DataFrame:
    """Summaries beside their runs' model, versions, estimate and gate; runs without a summary are left out."""
    own = runs.select("run_id", "pass_name", "model", "prompt_version", "n_requests", F.col("cost").alias("cost_estimate"), "canary_passed")
    return summaries.join(own, "run_id")


def extract(p: Pass, texts: DataFrame, windows: DataFrame | None, *, run_id: str, community: str, model: str, folder: str, trial, dry_run: bool = False, skip_trial: bool = False, **planned) -> DataFrame:
    """Plan, try, submit.  ``trial`` takes the plan and gives one row ``ok``.  A dry run gives the estimate and writes nothing."""
    made = plan(p, texts, windows, **planned)
    if made.requests.isEmpty():
        raise ValueError("no documents to read")
    if dry_run:
        return made.estimate
    return submit(made, p, run_id, community, model, folder, gate(None if skip_trial else trial(made), skip_trial))

