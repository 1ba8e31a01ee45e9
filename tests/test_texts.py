import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as X
from spanloom.operators import candidates as C
from spanloom.operators.align import align, locate
from spanloom.sources.articles import article_parts, labels_of, parse_article, parse_articles

ARTICLE = """<article><front><article-meta><title-group><article-title>A <i>study</i></article-title></title-group><abstract><p>Short  view.</p></abstract></article-meta></front>
<body><p>Loose words.</p><sec sec-type="intro"><title>Start</title><p>See <xref rid="r1">1</xref> for the earlier work on maps.<fig><p>gone</p></fig> Tail kept.</p></sec>
<sec sec-type="materials|methods"><title>What was done</title><p>First.</p><sec><title>Details</title><p>Inner.</p></sec>
<sec><title>Data and code availability</title><p>In the vault.</p></sec><disp-formula>x</disp-formula></sec></body>
<back><ack><p>Thanks.</p></ack><ref-list><ref id="r1"><pub-id pub-id-type="doi">https://doi.org/10.5/ABC</pub-id></ref></ref-list></back></article>"""


def test_article_sections_and_positions():
    p = parse_article(ARTICLE)
    assert p["doc_title"] == "A study" and "gone" not in p["text"] and "Tail kept." in p["text"] and "x" not in p["text"].split()
    at = {s["title"]: (s["labels"], p["text"][s["start"]:s["end"]]) for s in p["sections"]}
    assert at["Abstract"] == (["abstract"], "Short view.")
    assert at[""] == (["other"], "Loose words.")
    assert at["Start"][0] == ["introduction"]
    assert at["Details"] == (["methods"], "Details\n\nInner.")
    assert at["Data and code availability"][0] == ["data_availability", "code_availability"]
    assert at["What was done"][1].endswith("In the vault.")
    assert at["Acknowledgements"] == (["other"], "Thanks.")
    assert [s["title"] for s in p["sections"]].index("Details") < [s["title"] for s in p["sections"]].index("What was done")
    assert [s["title"] for s in p["sections"]] == ["Abstract", "", "Start", "Details", "Data and code availability", "What was done", "Acknowledgements"]


def test_article_with_late_title_stray_text_and_inner_article():
    p = parse_article("""<set xmlns="urn:x"><article><!-- c --><body>stray<sec>stray<p>H<sub>2</sub>O</p><title>Findings</title><title>Again</title></sec><p>a</p><list><p>b</p><p>c</p></list></body>
        <sub-article><body><p>not this</p></body></sub-article><body><p>nor this</p></body></article><article><body><p>nor that</p></body></article></set>""")
    assert p["text"] == "Findings\n\nH 2 O\n\na\n\nb c" and p["doc_title"] is None
    assert [(s["labels"], s["title"], p["text"][s["start"]:s["end"]]) for s in p["sections"]] == [(["results"], "Findings", "Findings\n\nH 2 O"), (["other"], "", "a\n\nb c")]
    assert parse_article("<article/>") == {"doc_title": None, "text": "", "sections": [], "refs": [], "marks": []}


def test_citation_anchors(spark):
    long = "word " * 60
    plain = ARTICLE.replace("<fig><p>gone</p></fig>", "")
    second = plain.replace("<p>Thanks.</p>", f'<p>{long}<xref rid="r1 r2">2</xref> and <xref rid="r2">3</xref></p><p>short <xref rid="r1">1</xref></p>').replace(
        "<ref-list>", '<ref-list><ref id="r2"><pub-id pub-id-type="pmid">77</pub-id></ref><ref><pub-id pub-id-type="doi">10.5/abc</pub-id></ref>')
    parts = article_parts(spark.createDataFrame([("a", plain.encode()), ("b", second.encode()), ("c", b"<no"), ("f", ARTICLE.encode())], "doc_id string, content binary"))
    texts = {r.doc_id: r.text for r in parts.collect()}

    def found(*corpus):
        return sorted((r.doc_id, texts[r.doc_id][r.start:r.end], r.start) for r in C.citation_anchors(parts, spark.createDataFrame(list(corpus), "doi string, pmid string")).collect())

    # a paragraph is found by all its characters, so one that loses a figure among the first of them is not (f)
    at = {k: t.find("1 for the earlier") for k, t in texts.items() if t}
    assert found(("10.5/ABC", None)) == [("a", "1", at["a"]), ("b", "1", at["b"]), ("b", "w", texts["b"].find("word word"))]  # a far marker: its paragraph's start
    assert found((None, "77")) == [("b", "w", texts["b"].find("word word"))] and found((None, "9")) == []


def test_values_of_the_corpus(spark):
    rec = spark.createDataFrame([("d", "data_availability", {"direction": "released", "accession": "(VLT1); ab (xy)."}), ("e", "data_availability", {"direction": "released", "accession": "OTHER1"})],
                                "doc_id string, extraction_class string, attributes map<string,string>")
    hits = spark.createDataFrame([("d", "k", "H1"), ("e", "k", "H2")], "doc_id string, kind string, value string")
    corpus = spark.createDataFrame([("d",)], "doc_id string")
    assert {r.value for r in C.known_values(rec, hits, corpus).collect()} == {"VLT1", "xy"}
    assert {r.value for r in C.known_values(rec.limit(0), hits, corpus).collect()} == {"H1"}


def test_broken_article_fails_its_row_only(spark):
    rows = spark.createDataFrame([("a", ARTICLE.encode()), ("b", b"<no"), ("c", b"<x/>"), ("d", None)], "doc_id string, content binary")
    got = {r.doc_id: r.error is None for r in parse_articles(rows).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}


@pytest.mark.parametrize(("title", "labels"), [
    ("Materials and Methods", ["methods"]), ("Data availability", ["data_availability"]), ("Data and code availability", ["data_availability", "code_availability"]),
    ("Software availability", ["code_availability"]), ("Availability of data and materials", ["data_availability"]), ("Findings", ["results"]), ("Conclusion", ["discussion"]),
    ("Background", ["introduction"]), ("Abstract", ["abstract"]), ("Accession numbers", ["data_availability"]), ("Funding", []), (None, []),
])
def test_headings(spark, title, labels):
    assert labels_of(title) == labels
    assert spark.createDataFrame([(title,)], "t string").select(X.heading_labels(F.col("t")).alias("x")).first().x == labels


TEXT = "The  panel's data-set was kept. THE end. The panel was kept. abab"


@pytest.mark.parametrize(("quote", "hint", "want"), [
    ("The panel was kept.", None, (41, 60, "match_exact")), ("panel's data–set", None, None), ("The panel's data-set", None, (0, 21, "match_fuzzy")),
    ("the END.", None, (32, 40, "match_lesser")), ("nowhere", None, None), ("", None, None), ("  ", None, None), ("kept", 50, (55, 59, "match_exact")), ("kept", 0, (26, 30, "match_exact")),
    ("ab", 64, (63, 65, "match_exact")), (None, None, None),
])
def test_align(spark, quote, hint, want):
    assert locate(quote, TEXT, hint) == want
    q = spark.createDataFrame([("d", quote, hint)], "doc_id string, source_quote string, hint int")
    r = align(q, spark.createDataFrame([("d", TEXT)], "doc_id string, text string")).first()
    assert ((r.aligned_start, r.aligned_end, r.aligned_status) if r.aligned_start is not None else None) == want
    if want:
        assert TEXT[want[0]:want[1]] == r.aligned_quote


def test_align_many_and_repeated(spark):
    rows = [("d", "The panel was kept.", None, {"k": "v"})] * 700 + [("d", f"w{i}", i, None) for i in range(500)] + [(None, "x", None, None)] * 2 + [("none", "x", 1, None)]
    q = spark.createDataFrame(rows, "doc_id string, source_quote string, hint int, more map<string,string>")
    texts = spark.createDataFrame([("d", TEXT + " " + " ".join(f"w{i}" for i in range(500)))], "doc_id string, text string")
    got = align(q, texts, part=50)
    assert got.columns == [*q.columns, "aligned_start", "aligned_end", "aligned_status", "aligned_quote"] and got.count() == len(rows)
    assert got.where("aligned_quote = source_quote").count() == 1_200 and got.where("aligned_start IS NULL").count() == 3
    assert align(q.limit(0), texts).count() == 0


def test_align_typographic_marks():
    assert locate("it's a \"so-called\" test", "it’s a “so–called” test") == (0, 23, "match_fuzzy")


def test_candidates_and_anchors(spark):
    t = spark.createDataFrame([("d", "See VLT-000001 at portal.example.org and GBX12345, NACRE."), ("e", None), ("f", "")], "doc_id string, text string")
    hits = C.find_spans(t, C.pattern_set({"vault": r"VLT-\d{6}", "basket": r"GBX\d{5}"}, ["portal.example.org"]) | C.identity_patterns(["NACRE"]))
    got = {(r.kind, r.value, r.char_start, r.char_end) for r in hits.collect()}
    assert got == {("vault", "VLT-000001", 4, 14), ("portal_portal", "portal.example.org", 18, 36), ("basket", "GBX12345", 41, 49), ("identity_string", "NACRE", 51, 56)}
    free = spark.createDataFrame([("none",)], "value string")
    assert {r.kind for r in C.anchors(hits, free, ["vault"]).collect()} == {"accession", "identity_string"}
    assert C.anchors(hits, free, ["vault"]).count() == 3
    assert C.anchors(hits, spark.createDataFrame([("GBX12345",)], "value string"), ["vault"]).count() == 4


def test_small_functions(spark):
    df = spark.createDataFrame([("  a b\n c ", "10.1101/2020.01.02.123", "Ann  van Hof", "PMC12.3.xml", "https://x.org/works/W1/")], "b string, doi string, n string, f string, u string")
    r = df.select(X.squeeze(F.col("b")).alias("b"), X.doi_prefix(F.col("doi")).alias("p"), X.article_id(F.col("doi")).alias("i"), X.surname(F.col("n")).alias("s"),
                  X.file_version(F.col("f")).alias("v"), X.last_segment(F.col("u")).alias("u"), X.title_form(F.lit("A-b C!" * 40)).alias("t"), X.stated(F.lit("not_stated")).alias("st")).first()
    assert (r.b, r.p, r.i, r.s, r.v, r.u, len(r.t), r.st) == ("a b c", "10.1101", "123", "hof", "3", "W1", 90, False)
