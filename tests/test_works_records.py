import json

import pytest
from pyspark.sql import functions as F

from spanloom.operators import passes as P, records as R, works as K
from spanloom.operators.harvest import canary_passes, harvest
from spanloom.operators.judge import verdicts
from spanloom.operators.skew import distinct_per_key, heavy_keys, key_profile
from spanloom.sources import connectors, files
from spanloom.streaming.ingest import ingest_jsonl

WORK = "doc_id string, ord int, title string, doi string, first_author_surname string, author_ids array<string>, preprint boolean"


def test_preprints_collapse(spark):
    rows = [("P1", 1, "A Title!", "10.1101/x", "hof", ["a"], True), ("J1", 2, "a title", "10.9/x", "hof", ["b"], False), ("J2", 0, "a title", "10.9/y", "zed", None, False),
            ("P2", 3, "A title", "10.1101/z", "nobody", ["c"], True), ("P3", 4, "", None, "hof", ["d"], True), ("P4", 5, "b", None, None, ["e"], True), ("J4", 6, "B", None, None, ["f"], False)]
    got = {r.doc_id: (r.merged, r.author_ids) for r in K.collapse_preprints(spark.createDataFrame(rows, WORK), "ord").collect()}
    assert got == {"J1": (["P1"], ["a", "b"]), "J2": ([], None), "P2": ([], ["c"]), "P3": ([], ["d"]), "J4": (["P4"], ["e", "f"])}


def test_author_overlap_classes(spark):
    corpus = spark.createDataFrame([("C", ["a", "b"])], "doc_id string, author_ids array<string>")
    citing = spark.createDataFrame([("C", ["a"], ["a"]), ("W1", ["x"], ["x"]), ("W2", ["x", "a", "y"], ["x", "y"]), ("W3", ["b", "x"], ["b", "x"]), ("W4", None, None)],
                                   "doc_id string, author_ids array<string>, first_last_author_ids array<string>")
    got = {r.doc_id: (r.author_overlap, r.n_shared_authors) for r in K.author_overlap(citing, corpus).collect()}
    assert got == {"C": ("is_corpus_document", 1), "W1": ("external", 0), "W2": ("shared_author", 1), "W3": ("shared_senior_author", 1), "W4": ("external", 0)}


def test_flat_works_and_status(spark):
    w = {"id": "https://x/W1", "doi": "https://doi.org/10.1/AB", "title": "T", "publication_date": "2020-01-01", "type": "article", "ids": {"pmid": "https://y/12", "pmcid": "https://z/99"},
         "primary_location": {"source": {"display_name": "V"}}, "referenced_works": ["https://x/W2"],
         "authorships": [{"author_position": "first", "author": {"id": "https://x/A1", "display_name": "Ann Hof"}, "institutions": [{"id": "https://x/I2"}, {"id": "https://x/I1"}]}]}
    r = K.flat_works(spark.read.json(spark.sparkContext.parallelize([json.dumps(w)]))).first()
    assert (r.doc_id, r.pmid, r.pmcid, r.doi, r.author_ids, r.institution_ids, r.first_author_surname, r.referenced) == ("W1", "12", "PMC99", "10.1/ab", ["A1"], ["I1", "I2"], "hof", ["W2"])
    s = spark.createDataFrame([(None, False, "a", "10.1101/x"), ("P", False, "a", "10.1101/x"), (None, True, None, None), (None, False, "", None)], "p string, t boolean, a string, d string")
    assert [x.s for x in s.select(K.availability(*(F.col(c) for c in "ptad")).alias("s")).collect()] == ["preprint_requester_pays_pending", "abstract_only", "fulltext", "unavailable"]


def test_skew_operators(spark):
    rows = [("hot", "a", 1)] * 60 + [("hot", "b", 5)] * 38 + [(None, "c", 2), ("cold", None, 3)]
    df = spark.createDataFrame(rows, "k string, v string, x int")
    assert [(r.heavy_key, r.n, r.n_total) for r in heavy_keys(df, "k").orderBy("heavy_key").collect()] == [("cold", 1, 100), ("hot", 98, 100)]
    assert heavy_keys(df.limit(0), "k").count() == 0
    assert {r.k: r.d for r in distinct_per_key(df, "k", "v", "d").collect()} == {"hot": 2, None: 1, "cold": 0}
    got = {r.k: (r.n_rows, r.n_distinct, r.lo, r.total) for r in key_profile(df, "k", "v", {"lo": ("min", F.col("x")), "total": ("sum", F.col("x"))}).collect()}
    assert got == {"hot": (98, 2, 1, 250), None: (1, 1, 2, 2), "cold": (1, 0, 3, 3)}


DEFINITION = {"pass": "p", "version": 1, "classes": {
    "data": {"description": "d", "attributes": {"tier": {"vocabulary": "tiers"}, "where": {}}, "absence_attributes": {"where": "no_statement"}, "examples": [{"text": "t", "extractions": [{"span": "t", "tier": "open"}]}]},
    "code": {"description": "c", "attributes": {"host": {}}, "absence_attributes": {"host": "no_statement"}}}}
PASS = P.Pass.of(DEFINITION, {"tiers": ["open", "closed"]}.__getitem__)


def test_pass_compiles():
    before, after = PASS.prompt("Hello.")
    assert "Class data" in before and '"open", "closed"' in before and before.endswith("<<<\n") and after == "\n>>>"
    assert PASS.response_schema()["required"] == ["data", "code"]
    assert PASS.issues({"data": [{"source_quote": "q", "tier": None, "where": None}], "code": []}) == []
    assert PASS.issues({"data": [{"source_quote": ""}, 3]}) == ["data[0]: no source_quote", "data[0]: no tier", "data[0]: no where", "data[1]: not an object", "code: missing"]
    assert PASS.issues([]) == ["not an object"]


@pytest.fixture(scope="module")
def harvested(spark):
    text = "Data are open in the vault. Nothing else."
    parsed = spark.createDataFrame([("D1", text, [(["results"], "", 0, len(text))]), ("D2", "Other.", None), ("D3", "Third.", None)],
                                   "doc_id string, text string, sections array<struct<labels:array<string>,title:string,start:int,end:int>>")
    index = spark.createDataFrame([("D1|0|0", "D1", 0), ("D2|0|0", "D2", 0), ("D3|0|0", "D3", 0)], "key string, doc_id string, window_start int")
    good = json.dumps({"data": [{"source_quote": "Data are  open", "tier": "odd", "where": "vault"}, {"source_quote": "Data are open", "tier": "open", "where": None},
                                {"source_quote": "invented words", "tier": None, "where": None}, {"source_quote": " ", "tier": None, "where": None}], "code": []})
    responses = spark.createDataFrame([("D1|0|0", "STOP", good, 10, 2), ("D2|0|0", "MAX_TOKENS", '{"data": [', 10, 2), ("D3|0|0", "STOP", '{"data": [], "code": []}', 10, 2), ("?", "STOP", "{}", 1, 1)],
                                      "key string, finish string, body string, tokens_in int, tokens_out int")
    candidates = spark.createDataFrame([("D1", 5, 8)], "doc_id string, char_start int, char_end int")
    return {k: v.collect() for k, v in harvest(responses, index, parsed, PASS, "run", candidates).items()}, text


def test_harvest(harvested):
    out, text = harvested
    real = [r for r in out["records"] if r.source_quote]
    assert len(real) == 1 and text[real[0].char_start:real[0].char_end] == real[0].source_quote == "Data are open"
    assert real[0].source_section == "results" and real[0].candidate_support and real[0].alignment_status == "match_exact"
    assert sorted((r.doc_id, r.extraction_class) for r in out["records"] if not r.source_quote) == [("D1", "code"), ("D3", "code"), ("D3", "data")]
    assert sorted((r.doc_id, r.reject_reason) for r in out["rejected"]) == [("D1", "empty_quote"), ("D1", "quote_not_in_source"), ("D2", "truncated_max_tokens")]
    s = out["summary"][0]
    assert (s.n_responses, s.n_stop, s.n_max_tokens, s.n_unknown_keys, s.extracted, s.absences, s.rejected, s.tokens_in) == (4, 3, 1, 1, 1, 3, 3, 31)


def test_harvest_canary_and_verdicts(spark, harvested):
    s = spark.createDataFrame([(2, 2, 0, 1), (2, 1, 0, 1), (0, 0, 0, 0)], "n_responses int, n_stop int, n_invalid int, extracted int")
    assert [r.ok for r in canary_passes(s).collect()] == [True, False, False]
    r = spark.createDataFrame([("STOP", '{"verdicts": [{"record_id": "r", "verdict": "confirmed", "confidence": 0.5}, {"record_id": "q", "verdict": "maybe"}]}'), ("MAX_TOKENS", "{}")], "finish string, body string")
    assert [(x.record_id, x.verdict, x.tag) for x in verdicts(r, "m", "t").collect()] == [("r", "confirmed", "t")]


def test_drift_absence_population(spark):
    r = spark.createDataFrame([("d", "data", "q", {"tier": "odd", "where": "x"}), ("d", "data", "q", {"tier": None, "where": "not_stated"})], "doc_id string, extraction_class string, source_quote string, attributes map<string,string>")
    assert [x.d for x in r.select(PASS.drift("data", F.col("attributes")).alias("d")).collect()] == [["tier=odd"], []]
    assert {(x.attribute, x.share) for x in R.population(r).collect()} == {("tier", 0.5), ("where", 0.5)}
    docs = spark.createDataFrame([("d",), ("e",)], "doc_id string")
    a = R.absences(docs, r, {"data": {"where": "no_statement"}}, {"data": ["tier", "where"]}, "run").collect()
    assert [(x.doc_id, x.attributes) for x in a] == [("e", {"tier": None, "where": "no_statement"})]


def test_vocabulary_raw_values_stay(spark):
    r = spark.createDataFrame([("r", {"p": "a", "z": "k"}), ("s", {"p": "new"}), ("t", {})], "record_id string, attributes map<string,string>")
    v = spark.createDataFrame([("P", "a", "A")], "value_set string, surface_form string, canonical_form string")
    got = {x.record_id: (x.attributes, x.attributes_canonical) for x in R.apply_vocabulary(r, v, {"p": "P"}).collect()}
    assert got == {"r": ({"p": "a", "z": "k"}, {"p": "A", "z": "k"}), "s": ({"p": "new"}, {"p": "new"}), "t": ({}, None)}
    second = spark.createDataFrame([("P", "A", "AA")], "value_set string, surface_form string, canonical_form string")
    assert R.compose(v, second).first().canonical_form == "AA"


def test_labels_and_calibration(spark):
    have = spark.createDataFrame([("r", "correct", "me", "1")], "record_id string, human_label string, labeller string, labelled_at string")
    new = spark.createDataFrame([("r", "incorrect", "me", "2"), ("s", "unsure", "me", "2"), ("s", "odd", "you", "2")], have.schema)
    assert sorted((x.record_id, x.human_label) for x in R.import_labels(have, new.select(*have.columns)).collect()) == [("r", "correct"), ("s", "unsure")]
    j = spark.createDataFrame([("confirmed", "correct"), ("confirmed", "incorrect"), ("rejected", "correct"), ("uncertain", "correct"), ("confirmed", "unsure")], "verdict string, label string")
    c = R.calibration(j).first()
    assert (c.tp, c.fp, c.fn, c.tn, c.precision, c.recall) == (1, 1, 1, 0, 0.5, 0.5)
    assert R.calibration(j.limit(0)).first().precision is None


def test_request_keys_and_estimate(spark):
    t = spark.createDataFrame([("W1", "x" * 50_000), ("W2", None)], "doc_id string, text string")
    r = P.requests(t, PASS)
    assert sorted(x.key for x in r.select("key").collect()) == ["W1|0|0", "W1|1|28500"]
    e = P.estimate(r, 1.0, 6.0).first()
    assert e.n_requests == 2 and e.tokens_in > 12_000 and e.tokens_out == 800 and e.cost > 0


def test_files_and_connectors(spark, tmp_path):
    df = spark.createDataFrame([("r", None, 1)], "record_id string, judge_verdict string, char_start int")
    files.write_jsonl(df, str(tmp_path / "j"))
    assert "judge_verdict" in "".join(f.read_text() for f in (tmp_path / "j").glob("part-*"))
    assert files.read_jsonl(spark, str(tmp_path / "j"), files.RECORD).first().record_id == "r"
    (tmp_path / "seed.csv").write_text("pmid,doi,pmcid,title,centre,grant_numbers\n1,,,\"a, b\",x;y,\n")
    assert files.read_csv(spark, str(tmp_path / "seed.csv"), files.SEED).first().title == "a, b"
    for v in ("9", "10"):
        (tmp_path / "xml").mkdir(exist_ok=True)
        (tmp_path / "xml" / f"PMC1.{v}.xml").write_text(f"<article>{v}</article>")
    assert files.read_articles(spark, str(tmp_path / "xml")).first().version == "10"
    (tmp_path / "page_1.json").write_text(json.dumps({"results": [{"id": "W1", "title": "t"}]}))
    spark.dataSource.register(connectors.PagedWorks)
    assert spark.read.format("paged_works").load(str(tmp_path)).first().id == "W1"
    response = {"custom_id": "k", "response": {"candidates": [{"finishReason": "STOP", "content": {"parts": [{"text": "{"}, {"text": "}"}]}}], "usageMetadata": {"promptTokenCount": 3, "thoughtsTokenCount": 4}}}
    (tmp_path / "resp.jsonl").write_text(json.dumps(response) + "\n\n")
    r = files.read_responses(files.read_jsonl(spark, str(tmp_path / "resp.jsonl"), files.RESPONSE))
    assert tuple(r.first()) == ("k", "STOP", "{}", 3, 4)
    asked = spark.createDataFrame([("k", (1,)), ("l", (2,))], "key string, request struct<a:int>")
    assert connectors.ReplayClient(r).answer(asked).count() == 1
    assert {x.body for x in connectors.CallClient(lambda k, q: ("STOP", k, 1, 1)).answer(asked).collect()} == {"k", "l"}
    silver = spark.createDataFrame([("a", "x")], "run_id string, record_id string")
    bronze = spark.createDataFrame([("a", "y"), ("b", "z")], "run_id string, record_id string")
    assert sorted(x.record_id for x in files.records_of_runs(silver, bronze, ["a", "b"]).collect()) == ["x", "z"]
    with pytest.raises(FileNotFoundError):
        files.records_of_runs(silver, bronze, ["c"])
    assert files.merge_manifest(str(tmp_path / "m.json"), {"f": {"n": 1}}) == {"f": {"n": 1}}


def test_stream_takes_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": "1"}\n')
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("id string")
    for name, rows in (("b.json", 2), ("c.json", 3)):
        ingest_jsonl(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp"), ["id"]).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == rows - 1
        (tmp_path / "in" / name).write_text(f'{{"id": "{rows}"}}\n')


def test_command_line(spark, tmp_path, capsys):
    from conftest import DATA
    from spanloom import cli

    assert cli.main(["list"]) == 0 and "f7_statements" in capsys.readouterr().out
    assert cli.main(["windows", DATA, str(tmp_path / "w")]) == 0
    assert spark.read.parquet(str(tmp_path / "w")).count() > 0
