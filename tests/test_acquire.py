import json

import pytest
from pyspark.sql import functions as F

from spanloom.operators import acquire as A
from spanloom.plans.report import render
from spanloom.sources.config import Community, key_of, read_env


def work(i, pmid=None, doi=None, refs=(), author="A1"):
    return {"id": f"https://x/{i}", "doi": f"https://doi.org/{doi}" if doi else None, "title": f"t {i}", "publication_date": "2020-01-01", "type": "article",
            "ids": {"pmid": f"https://y/{pmid}" if pmid else None, "pmcid": None}, "primary_location": {"source": {"display_name": "V"}}, "referenced_works": [f"https://x/{r}" for r in refs],
            "authorships": [{"author_position": "first", "author": {"id": f"https://x/{author}", "display_name": "Ann Hof"}, "institutions": [{"id": "https://x/I1"}]}]}


@pytest.fixture(scope="module")
def works(spark):
    rows = [work("W1", pmid="1"), work("W2", doi="10.5/AB"), work("W3", refs=["W1", "W2"]), work("W4", doi="10.1101/z", refs=["W2"], author="B9"), work("W5"), work("W1x", refs=["W5"])]
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def test_corpus_and_citing(spark, works):
    seed = spark.createDataFrame([("1", None, "x; y", None), (None, "10.5/ab", None, "G1"), ("9", "10.9/q", None, None)], "pmid string, doi string, centre string, grant_numbers string")
    texts = spark.createDataFrame([("W2",)], "doc_id string")
    more = spark.createDataFrame([("W1", "<p>an abstract</p>")], "doc_id string, abstract string")
    corpus = A.corpus_documents(seed, works, texts, more)
    got = {r.doc_id: (r.oa_status, r.group_key, r.grants, r.abstract) for r in corpus.collect()}
    assert got == {"W1": ("abstract_only", ["x", "y"], [], "an abstract"), "W2": ("fulltext", [], ["G1"], None)}
    citing, edges = A.citing_documents(works, corpus, texts)
    assert {r.doc_id: (r.oa_status, r.author_overlap) for r in citing.collect()} == {"W3": ("unavailable", "shared_senior_author"), "W4": ("preprint_requester_pays_pending", "external")}
    assert sorted((r.citing_doc_id, r.cited_doc_id) for r in edges.collect()) == [("W3", "W1"), ("W3", "W2"), ("W4", "W2")]
    assert sorted(r.citing_doc_id for r in A.citing_of(edges, "W2").collect()) == ["W3", "W4"]


def test_all_documents_acquired(spark):
    rows = [work("C1", pmid="1"), work("P1", doi="10.5/p", refs=["C1"], author="A7"), work("Q1", doi="10.1101/p", refs=["C1"], author="A8"), work("R1", doi="10.1101/r", refs=["C1"]), work("S1", pmid="9", refs=["C1"])]
    for r, title in zip(rows, ("corpus", "Same title", "same  TITLE", "other", "third")):
        r["title"] = title
    rows[2]["type"] = rows[3]["type"] = "preprint"
    works = spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    seed = spark.createDataFrame([("1", None, "x", None)], "pmid string, doi string, centre string, grant_numbers string")
    texts, ids = spark.createDataFrame([("S1",)], "doc_id string"), spark.createDataFrame([("9", "77")], "pmid string, pmcid string")
    documents, edges = A.acquire(works, A.corpus_documents(seed, works, texts), texts, ids, spark.createDataFrame([("P1", "an abstract")], "doc_id string, abstract string"))
    got = {r.doc_id: (r.doc_type, r.oa_status, r.tier, r.merged_from, r.pmcid) for r in documents.collect()}
    assert got == {"C1": ("corpus", "unavailable", None, None, None), "P1": ("citing", "abstract_only", "abstract", ["Q1"], None), "R1": ("citing", "preprint_requester_pays_pending", "requester_pays", [], None),
                   "S1": ("citing", "fulltext", "archive", [], "PMC77")}
    assert edges.count() == 4


def test_attempted_chunks_answers_cost(spark):
    index = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", "c")], "run_id string, doc_id string")
    runs = spark.createDataFrame([("r1", "p", "done", False), ("r2", "p", "cancelled_x", None), ("r3", "p", "done", True)], "run_id string, pass_name string, status string, is_sample boolean")
    assert [r.doc_id for r in A.attempted(index, runs, "p").collect()] == ["a"]
    values = spark.range(200).select(F.lit("s").alias("value_set"), F.col("id").cast("string").alias("surface_form"))
    chunks = A.value_chunks(values, 80).collect()
    assert sum(len(c.surface_forms) for c in chunks) == 200 and len(chunks) <= 3
    known = A.answered(values, spark.createDataFrame([("s", "7", "seven"), ("s", "8", "")], "value_set string, surface_form string, canonical_form string"))
    assert {r.surface_form: r.canonical_form for r in known.where("surface_form IN ('7', '8', '9')").collect()} == {"7": "seven", "8": "8", "9": "9"}
    usage = spark.createDataFrame([("m", 1_000_000, 500_000), ("m", 1_000_000, 0)], "model string, tokens_in long, tokens_out long")
    assert A.cost(usage, spark.createDataFrame([("m", 1.0, 6.0)], "model string, rate_in double, rate_out double")).first().cost == 5.0


def test_config_and_report(spark, tmp_path, monkeypatch):
    (tmp_path / "c.yaml").write_text("community: nacre\ncorpus: {seed: s.csv, group_by: centre}\nidentity_strings: [NACRE]\naccession_patterns: {vault: 'VLT-\\d+'}\n")
    c = Community.load(str(tmp_path / "c.yaml"))
    assert (c.name, c.seed, c.identity_strings, c.accession_patterns, c.passes) == ("nacre", "s.csv", ["NACRE"], {"vault": "VLT-\\d+"}, [])
    assert Community.load("c", str(tmp_path)).name == "nacre"
    (tmp_path / ".env").write_text("# x\nexport SPANLOOM_TEST_KEY='v'\n\n")
    assert read_env(str(tmp_path / ".env")) == {"SPANLOOM_TEST_KEY": "v"} and key_of("SPANLOOM_TEST_KEY", str(tmp_path / ".env")) == "v"
    with pytest.raises(KeyError):
        key_of("SPANLOOM_TEST_KEY")
    text = render("R", {"a": spark.createDataFrame([(1, None)], "n int, x string"), "b": spark.range(200)}, {"a": "none"})
    assert "| 1 |  |" in text and "Filter: none" in text and "(more than 100 rows)" in text


def test_packages(spark, tmp_path):
    import zipfile

    from spanloom.sources.packages import read_packages

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("content/1.xml", "<article/>")
        z.writestr("content/1.png", "x")
    (tmp_path / "b.zip").write_bytes(b"not a package")
    got = {(r.path.rsplit("/", 1)[-1], r.entry, bytes(r.content) if r.content else None, r.error is None) for r in read_packages(spark, str(tmp_path)).collect()}
    assert got == {("a.zip", "content/1.xml", b"<article/>", True), ("b.zip", None, None, False)}
