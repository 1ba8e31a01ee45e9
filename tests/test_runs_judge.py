import json

import pytest
from pyspark.sql import functions as F

from spanloom.operators import acquire as A, document_sets as D, judge as J, passes as P, records as R, runs as U
from spanloom.operators.harvest import canary_passes, with_issues
from spanloom.plans.report import lookup, percent
from spanloom.sources import connectors, files
from spanloom.sources.packages import metered, read_packages

RAW = {"pass": "p", "version": "2", "applies_to": ["corpus"], "classes": {"data": {"attributes": {"kind": {"type": "array", "vocabulary": "k"}, "where": {}}}}}
PASS = P.Pass.of(RAW, {"k": ["a", "b"]}.__getitem__)
SECTIONS = "array<struct<labels:array<string>,title:string,start:int,end:int>>"


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame([("W1", "corpus", " Full-Text", "an abstract", "t"), ("W1", "corpus", "fulltext", "b abstract", "t"), ("W2", "corpus", "abstract_only", "only", None), ("W3", "citing", "FULLTEXT", "", "x"), ("W4", "corpus", "fulltext", None, "y")],
                              "doc_id string, doc_type string, oa_status string, abstract string, title string")
    text = "We NACRE. Data availability here." + " x" * 20_000
    parsed = spark.createDataFrame([("W1", "T", text, [(["data_availability"], "", 10, 33)]), ("W3", None, "Other text", None), ("W4", None, "", None)], f"doc_id string, doc_title string, text string, sections {SECTIONS}")
    return d, parsed


def test_document_sets(spark, docs):
    d, parsed = docs
    assert [r.doc_id for r in D.full_texts(d, parsed, "corpus").collect()] == ["W1"]
    got = {r.doc_id: (r.text, r.sections[0].labels, r.sections[0].end) for r in D.abstracts(d, "corpus").collect()}
    assert got == {"W1": ("an abstract", ["abstract"], 11), "W2": ("only", ["abstract"], 4)}
    with pytest.raises(ValueError):
        D.texts_of(PASS, "citing", d, parsed)
    texts, windows = D.texts_of(PASS, "corpus", d, parsed)
    assert windows is None and texts.count() == 1
    around = P.Pass.of(RAW | {"text_source": "anchors", "anchor_radius": 5}, {"k": []}.__getitem__)
    with pytest.raises(ValueError):
        D.texts_of(around, "corpus", d, parsed)
    anchors = spark.createDataFrame([("W1", 3, 8, "identity_string"), ("W1", 100, 101, "accession")], "doc_id string, start int, end int, kind string")
    texts, windows = D.texts_of(around, "corpus", d, parsed, anchors)
    assert sorted((r.window_index, r.window_start, r.window_end) for r in windows.collect()) == [(0, 0, 13), (1, 95, 106)]
    assert P.requests(texts, around, windows).count() == 2
    assert D.texts_of(around, "corpus", d, parsed, anchors.limit(0))[0].count() == 0
    assert D.corpus_and_citing(d.select("doc_id", "title"), d.select("doc_id", "abstract")).columns == ["doc_id", "title", "abstract"]


def test_plan_trial_submit(spark, docs, tmp_path):
    d, parsed = docs
    texts, _ = D.texts_of(PASS, "corpus", d, parsed)
    made = U.plan(PASS, texts)
    assert made.requests.count() == 2 and made.estimate.first().n_requests == 2
    config = made.requests.select("request.generationConfig.*").first()
    assert (config.temperature, config.maxOutputTokens, config.responseSchema.properties.data.type) == (0, 16384, "ARRAY")
    assert U.plan(PASS, texts, covered=spark.createDataFrame([("W1",)], "doc_id string")).requests.count() == 0
    assert U.plan(PASS, parsed, sample=1).requests.select("doc_id").distinct().count() <= 1
    assert sorted((r.window_index, r.priority) for r in U.trial_priority(made.requests, parsed, ["NACRE"]).collect()) == [(0, 0), (1, 2)]
    assert sorted((r.window_index, r.priority) for r in U.trial_priority(made.requests, parsed).collect()) == [(0, 1), (1, 2)]
    passed, failed = (spark.createDataFrame([(x,)], "ok boolean") for x in (True, False))
    more = {"run_id": "r1", "community": "c", "model": "m", "folder": str(tmp_path)}
    assert U.extract(PASS, texts, None, trial=lambda p: failed, dry_run=True, **more).columns[0] == "n_requests" and not list(tmp_path.iterdir())
    with pytest.raises(RuntimeError):
        U.extract(PASS, texts, None, trial=lambda p: failed, **more)
    assert not list(tmp_path.iterdir())
    with pytest.raises(ValueError):
        U.extract(PASS, texts.limit(0), None, trial=lambda p: passed, **more)
    assert U.extract(PASS, texts, None, trial=lambda p: passed, **more).first().canary_passed
    runs, index = spark.read.parquet(f"{tmp_path}/runs"), spark.read.parquet(f"{tmp_path}/key_index")
    assert U.run_row(runs, "r1")["n_requests"] == 2 and index.count() == 2
    assert json.loads(next((tmp_path / "requests" / "r1").glob("part-*")).read_text().splitlines()[0])["request"]["generationConfig"]["temperature"] == 0
    assert [r.doc_id for r in U.covered_by(index, runs, "p").collect()] == ["W1"]
    with pytest.raises(Exception):
        U.extract(PASS, texts, None, trial=lambda p: passed, **more)  # a run id is written once
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 1
    with pytest.raises(FileNotFoundError):
        U.run_row(runs, "none")
    answers = spark.createDataFrame([("k", "a")], "key string, body string")
    with pytest.raises(RuntimeError):
        U.store_responses(answers, str(tmp_path), "r1", "JOB_STATE_RUNNING")
    path = U.store_responses(answers, str(tmp_path), "r1", "JOB_STATE_SUCCEEDED")
    assert U.store_responses(answers.limit(0), str(tmp_path), "r1", "JOB_STATE_FAILED") == path and spark.read.json(path).count() == 1
    s = U.summaries_of_runs(spark.createDataFrame([("r1", 3), ("r9", 1)], "run_id string, records int"), runs).collect()
    assert [(r.run_id, r.records, r.model) for r in s] == [("r1", 3, "m")]


def test_issues_gate(spark):
    r = spark.createDataFrame([("a", '{"data": []}'), ("b", "{"), ("c", None), ("d", '{"data": [{"source_quote": "q", "kind": ["a"]}]}')], "key string, body string")
    assert {x.key: x.issues for x in with_issues(r, PASS).collect()} == {"a": [], "b": ["no JSON"], "c": ["no JSON"], "d": ["data[0]: no where"]}
    s = spark.createDataFrame([(2, 2, 0, 1), (2, 2, 1, 1)], "n_responses int, n_stop int, n_invalid int, extracted int")
    assert [x.ok for x in canary_passes(s).collect()] == [True, False]


def test_judge(spark, tmp_path):
    rec = spark.createDataFrame([("d", f"r{i}", "data", "quote", "results", {"where": "x"}, 5, 10) for i in range(450)] + [("d", "e", "data", "", "none", {}, 0, 0), ("n", "s", "data", "q", None, None, None, None)],
                                "doc_id string, record_id string, extraction_class string, source_quote string, source_section string, attributes map<string,string>, char_start int, char_end int")
    parsed = spark.createDataFrame([("d", "01234quote" + "y" * 1_000)], "doc_id string, text string")
    cands = spark.createDataFrame([("d", "vault", "V1", "results")] * 3, "doc_id string, kind string, value string, section string")
    with pytest.raises(ValueError):
        J.judge_requests(rec, parsed, cands, "m", "m")
    reqs = J.judge_requests(rec, parsed, cands, "m2", "m1")
    got = reqs.collect()
    assert sum(r.n_records for r in got if r.doc_id == "d") == 450 and max(r.n_records for r in got) < 300
    body = next(r for r in got if r.doc_id == "d").request.contents[0].parts[0].text
    assert body.count('"V1"') == 1 and json.loads(body.splitlines()[-1])["context"] == "01234quote" + "y" * 400
    assert "(none)" in next(r for r in got if r.doc_id == "n").request.contents[0].parts[0].text
    assert [r.doc_id for r in J.judge_trial(reqs).collect()] == ["d", "n"]
    made = J.judge_plan(reqs)
    U.submit(made, PASS, "j1", "c", "m2", str(tmp_path), U.gate(J.judge_passes(spark.createDataFrame([("STOP", '{"verdicts": [{"record_id": "a", "verdict": "rejected"}]}')], "finish string, body string"))))
    assert U.run_row(spark.read.parquet(f"{tmp_path}/runs"), "j1")["n_requests"] == len(got)
    with pytest.raises(RuntimeError):
        U.gate(J.judge_passes(spark.createDataFrame([("STOP", '{"verdicts": []}')], "finish string, body string")))
    told = spark.createDataFrame([("STOP", '{"verdicts": [{"record_id": "a", "verdict": "confirmed"}, {"record_id": "b", "verdict": "maybe"}, {"record_id": "c"}]}'), ("STOP", "no"), ("MAX_TOKENS", '{"verdicts": []}')], "finish string, body string")
    assert J.verdict_summary(told).first().asDict() == {"confirmed": 1, "rejected": 0, "uncertain": 0, "unknown_verdicts": 2, "bad_responses": 2}
    assert J.verdict_summary(told.limit(0)).first().confirmed == 0
    bronze = spark.createDataFrame([("a", {"p": "x"}, None, None, None)], "record_id string, attributes map<string,string>, judge_verdict string, judge_confidence double, judge_reason string")
    voc = spark.createDataFrame([("s", "x", "X")], "value_set string, surface_form string, canonical_form string")
    silver = J.rebuild_silver(bronze, voc, J.verdicts(told, "m", "t"), {"p": "s"}).first()
    assert (silver.attributes_canonical, silver.attributes, silver.judge_verdict) == ({"p": "X"}, {"p": "x"}, "confirmed")


def test_normalise_and_views(spark, tmp_path):
    bronze = spark.createDataFrame([("a", {"p": "x", "q": "y"}, None, None, None)], "record_id string, attributes map<string,string>, judge_verdict string, judge_confidence double, judge_reason string")
    log = spark.createDataFrame([("a", "rejected", 0.5, "r", "t1"), ("a", "confirmed", 0.9, "s", "t2")], "record_id string, verdict string, confidence double, reason string, tag string")
    vocabulary, silver = J.normalise(bronze, spark.createDataFrame([("s", "x", "X")], "value_set string, surface_form string, canonical_form string"), log, {"p": "s", "q": "s"})
    assert {tuple(r) for r in vocabulary.collect()} == {("s", "x", "X"), ("s", "y", "y")}
    r = silver.first()
    assert (r.attributes_canonical, r.judge_verdict, r.judge_confidence) == ({"p": "X", "q": "y"}, "confirmed", 0.9)
    files.write_gold_csv(spark.createDataFrame([("a", None, '1 "x", y')], "k string, e string, v string"), f"{tmp_path}/gold_thing")
    assert files.gold_views(spark, str(tmp_path), ["thing"]) == ["thing"]
    assert [tuple(r) for r in spark.sql("SELECT * FROM thing WHERE e = ''").collect()] == [("a", "", '1 "x", y')]


def test_list_values(spark):
    r = spark.createDataFrame([("data", {"kind": "a; z;b", "where": "q;r"}), ("data", {"kind": '["a", "y"]', "where": None}), ("data", {"kind": None}), ("data", None)], "extraction_class string, attributes map<string,string>")
    assert [x.d for x in r.select(PASS.drift("data", F.col("attributes")).alias("d")).collect()] == [["kind=z"], ["kind=y"], [], []]
    forms = R.surface_values(r, {"k": ["kind"], "w": ["where"]}, ["kind"])
    assert {tuple(x) for x in forms.collect()} == {("k", "a"), ("k", "z"), ("k", "b"), ("k", "y"), ("w", "q;r")}
    assert R.attribute_names(r, "data") == ["kind", "where"]
    v = spark.createDataFrame([("s", "a", "A", 1), ("s", "a", "B", 2)], "value_set string, surface_form string, canonical_form string, at int")
    assert R.latest_forms(v, "at").first().canonical_form == "B"


def test_funnel_counts_members_of_lists(spark, tmp_path):
    from spanloom.plans.figure_queries import f6_funnel

    pubs = spark.createDataFrame([("W1", 1, "Full Text", "citing", None, "2024", None, None), ("W2", 2, None, "citing", None, None, None, None)], "doc_id string, row_id long, oa_status string, doc_type string, group_key string, pub_date string, venue string, author_overlap string")
    rec = spark.createDataFrame([("W1", "engagement", {"engagement_kind": "method_reuse; data_reuse"}, "confirmed"), ("W2", "engagement", {"engagement_kind": "metadata_reuse"}, None)], "doc_id string, extraction_class string, attributes map<string,string>, judge_verdict string")
    for name, df in (("publications", pubs), ("records", rec), ("candidates", spark.createDataFrame([("W1",)], "doc_id string")), ("corpus_seed", spark.createDataFrame([("x", "y")], "doc_id string, centre string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert tuple(f6_funnel(spark, str(tmp_path)).first()) == (2, 1, 1, 1, 1, 0)


def test_sources(spark, tmp_path):
    asked, waits = [], []

    def fetch(cursor):
        asked.append(cursor)
        if len(asked) in (2, 3):
            raise connectors.Busy
        return {"*": {"results": [1, 2], "meta": {"next_cursor": "b"}}, "b": {"results": [3], "meta": {"next_cursor": "c"}}, "c": {"results": [], "meta": {"next_cursor": "d"}}}[cursor]

    assert list(connectors.walk_pages(fetch, sleep=waits.append)) == [1, 2, 3] and asked == ["*", "b", "b", "b", "c"] and waits == [1.0, 2.0]
    with pytest.raises(connectors.Busy):
        list(connectors.walk_pages(lambda c: (_ for _ in ()).throw(connectors.Busy()), tries=2, sleep=waits.append))
    for folder, page, ids in (("q1", 1, ["W1"]), ("q1", 2, ["W2"]), ("q2", 1, ["W3"])):
        (tmp_path / "works" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "works" / folder / f"page_{page}.json").write_text(json.dumps({"results": [{"id": i} for i in ids]}))
    spark.dataSource.register(connectors.PagedWorks)
    assert sorted(r.id for r in spark.read.format("paged_works").load(str(tmp_path / "works")).collect()) == ["W1", "W2", "W3"]
    kind = "doc_id string, version string, content string"
    local, cache, remote = (spark.createDataFrame(rows, kind) for rows in ([("a", None, "l")], [("a", "7", "c"), ("b", "9", "c9"), ("b", "10", "c10")], [("b", "11", "r"), ("c", "1", "r")]))
    assert {r.doc_id: (r.content, r.source) for r in files.first_held(local, cache, remote).collect()} == {"a": ("l", 0), "b": ("c10", 1), "c": ("r", 2)}
    (tmp_path / "x.json").write_text('{"a": "1"}\n')
    (tmp_path / "y.json").write_text('{"b": "2", "z": 1}\n')
    assert sorted((r.a, r.b) for r in files.read_many(spark, [f"{tmp_path}/x.json", f"{tmp_path}/y.json"], "a string, b string").na.fill("").collect()) == [("", "2"), ("1", "")]
    import zipfile

    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("a.xml", "12345")
        z.writestr("b.png", "x" * 1_000)
    df, seen = metered(read_packages(spark, str(tmp_path)))
    assert df.count() == 1 and seen.get == {"requests": 1, "bytes": 5}


def test_months_and_ids(spark, tmp_path):
    d = spark.createDataFrame([("W1", "Preprint requester pays pending", "10.1101/2024.01.02.11", "2024-01-05"), ("W2", "preprint_requester_pays_pending", "10.1101/22", "20240301"), ("W3", "fulltext", "10.1/3", "2024-01-05"), ("W4", "preprint_requester_pays_pending", "10.1/4", "2024-01-05")],
                              "doc_id string, oa_status string, doi string, pub_date string")
    held = spark.createDataFrame([("W4",)], "doc_id string")
    months = A.pending_by_month(d, held)
    assert sorted((r.month, r.article_id, r.doc_id) for r in months.collect()) == [("January_2024", "11", "W1"), ("March_2024", "22", "W2")]

    def fetch(rows):
        if rows.first().doc_id == "W2":
            raise OSError("away")
        return rows.select("doc_id", F.lit("<x/>").alias("content"))

    store = str(tmp_path / "store")
    assert A.sweep(months, fetch, store) == {"January_2024": "done", "March_2024": "failed: OSError"}
    left = A.pending_by_month(d, held.union(spark.read.parquet(store).select("doc_id")))
    assert A.sweep(left, lambda rows: rows.select("doc_id", F.lit("<y/>").alias("content")), store) == {"March_2024": "done"}
    assert sorted(r.doc_id for r in spark.read.parquet(store).collect()) == ["W1", "W2"]
    ids = spark.createDataFrame([("1", "12"), ("1", "PMC11"), ("2", None)], "pmid string, pmcid string")
    own = spark.createDataFrame([("1", None), ("2", None), ("3", "PMC3"), (None, None)], "pmid string, pmcid string")
    assert sorted((r.pmid or "", r.pmcid) for r in A.with_pmcids(own, ids).collect()) == [("", None), ("1", "PMC11"), ("2", None), ("3", "PMC3")]


def test_labels_domains_prose(spark):
    labels = spark.createDataFrame([("a", "correct"), ("b", "incorrect"), ("c", "unsure"), ("x", "correct")], "record_id string, human_label string")
    rec = spark.createDataFrame([("a", "k", "odd"), ("b", "k", "match_exact"), ("c", "k", None)], "record_id string, extraction_class string, alignment_status string")
    assert [tuple(r) for r in R.precision_by_class(labels, rec).collect()] == [("k", 2, 0.5)]
    assert [tuple(r) for r in R.outside_domains(rec).collect()] == [("alignment_status", "odd", 1)]
    assert [percent(a, b) for a, b in ((0, 5), (1, 30), (1, 2))] == ["0%", "3.3%", "50%"]
    assert lookup([{"a": 1, "n": 2}, {"a": 3, "n": 4}], a="3")["n"] == 4
    with pytest.raises(KeyError):
        lookup([], a=1)
