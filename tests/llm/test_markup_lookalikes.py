import random
import re
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st

from spanloom.llm import lookalikes as L, markup as M


# --- look-alikes

@pytest.mark.parametrize(("a", "b"), [
    ("ｗｅｒｅ 10", "were 10"), ("с\u0430t", "cat"), ("e\u0301", "é"), ("a\u00a0b", "a b"), ("a\u2007b\u3000c", "a b c"), ("so\u00adft", "soft"), ("\ufeffx\u200d", "x"), ("non\u2011stop", "non-stop"),
    ("ﬁeld", "field"), ("µm", "μm"), ("Αlpha", "Alpha"), ("e\u200d\u0301", "é"), ("ᄒ\u1161\u11ab", "한"), ("a\u0323\u0307", "a\u0307\u0323"), ("line\nend", "line end")])
def test_same_look(a, b):
    assert L.same_form(a) == L.same_form(b)


@pytest.mark.parametrize(("a", "b"), [("10³", "103"), ("naïve", "naive"), ("The", "the"), ("a b", "ab"), ("15", "18"), ("a-b", "a b"), ("½", "1/2")])
def test_other_look(a, b):
    assert L.same_form(a) != L.same_form(b)


def test_empty_null_long():
    assert L.same_form(None) is None and L.same_form("") == ""
    assert L.same_form("ab " * 300_000 + "e\u0301") == "ab " * 300_000 + "é"


def whole(text):
    """The form by brute force: every character folded, the whole text normalised."""
    fold, *_ = L._tables()
    return unicodedata.normalize("NFC", text.translate(fold))


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=30))
def test_segments_equal_the_whole(text):
    form = L.same_form(text)
    assert form == whole(text)
    assert L.same_form(form) == form


def test_blocks_taken_as_stable_are():
    for a, b in L.STABLE:
        for ch in map(chr, range(a, b + 1)):
            if unicodedata.category(ch) not in ("Cn", "Co", "Cs"):
                assert unicodedata.is_normalized("NFC", ch) and not unicodedata.combining(ch) and not unicodedata.decomposition(ch).startswith("<") and unicodedata.category(ch)[0] == "L" or not ch.isprintable(), hex(ord(ch))


def test_quotes_and_extra_columns(spark):
    text = "x 😀 Thе\u00a0cat sat. end"
    parsed = spark.createDataFrame([("d", text, "clash"), ("n", None, ""), ("e", "", "")], "doc_id string, text string, source_quote string")
    rec = spark.createDataFrame([("a", "d", "The cat sat.", 4, 16, "k"), ("b", "d", "The Cat sat.", 4, 16, "k"), ("c", "d", text[4:16], 4, 16, "k"), ("d", "n", "q", 0, 1, "k"), ("e", "e", "q", 0, 1, "k"),
                                 ("f", "d", None, 0, 1, "k"), ("g", "d", "x", None, 1, "k"), ("h", None, "x", 0, 1, "k"), ("i", "d", "x", 5, 1, "k"), ("a", "d", "The cat sat.", 4, 16, "k")],
                                "record_id string, doc_id string, source_quote string, char_start int, char_end int, stretch string")
    pairs = L.quoted_stretches(rec, parsed)
    formed = L.in_one_form(pairs.where("source_quote <> stretch"), ["source_quote", "stretch"])
    assert {r.record_id for r in formed.where("source_quote_form = stretch_form").collect()} == {"a"}
    assert L.quoted_stretches(rec.limit(0), parsed).count() == 0
    clash = spark.createDataFrame([("ａ", "old")], "t string, t_form string")
    assert L.in_one_form(clash, ["t"]).first().t_form == "a"


# --- markup

MARKED = ["a <i>b</i> c", "x<br/>y", "&amp; z", "&#945;", "<!-- n -->t", "<jats:p>t</jats:p>", '<xref rid="B4">35</xref>', "# Head\nt", "t\n\n## Head ##\nx", "Head\n====\nt", "**b** t", "t __b__ t", "~~s~~",
          "a `code` b", "```\nx = 1\n```", "[t](#s)", "![t](f.png)", "- item\n- item", "* **item**", "| a | b |\n|---|---|\n| 1 | 2 |", "[[Topic|t]]", "{{cite|id=3}}", "== Head ==\nt", "'''b'''", "''i''",
          "\\textbf{b}", "a~\\cite{r}", "($\\alpha_{7} \\le 7$)", "\\begin{itemize}\n\\item a\n\\end{itemize}", "{\\bf a} b", "&amp;lt;b", "unclosed <i>text", "t\n> said"]
PLAIN = ["Values < 5 and > 90", "Q&A and S&T differed (x < y > z)", "C++ and C# code; 3 * 4 = 12", "cell_id and batch_no (a_1, b_2)", "{A, B} and ~5", "outliers *.", "step #3 twice", "1/2 and 3|4 | see",
         "cost $40, or $35 [7]", "(p < 0.05)", "AT&T; the", "a - b\n\nc", "5 * 3 * 2", "", None, "it's", "no. 1) x", "a_b_c __init", "x == y"]


@pytest.mark.parametrize("text", MARKED)
def test_marks_are_found_and_go(text):
    assert M.has_residue(text)
    clean, blocks = M.clean(text)
    for kind, _, start, end in sorted(blocks, key=lambda b: -b[2]):
        if kind in ("code", "formula"):
            clean = clean[:start] + "x" + clean[end:]
    assert not M.has_residue(clean)


@pytest.mark.parametrize("text", PLAIN)
def test_plain_signs_stay(text):
    assert not M.has_residue(text) and M.clean(text) == (text, [])


def parts(text):
    clean, blocks = M.clean(text)
    return clean, [(k, n, clean[a:b]) for k, n, a, b in blocks]


def test_structure():
    clean, blocks = parts("<h2>Head</h2>\n<p>One <b>two</b>.</p>\n<ul><li>a</li><li>b</li></ul>\n<pre><code>f(<x>)\n  y</code></pre> ($\\alpha_1$)")
    assert clean.startswith("Head\n") and "One two." in clean
    assert blocks == [("heading", 2, "Head"), ("item", 1, "a"), ("item", 1, "b"), ("code", 0, "f(<x>)\n  y"), ("formula", 0, "\\alpha_1")]
    assert parts("\\section{Results}\nWe\\footnote{see} ran.\n\\begin{equation}\nd = \\frac{a}{b}\n\\end{equation}")[1] == [("heading", 1, "Results"), ("formula", 0, "d = \\frac{a}{b}")]
    assert parts("# Top #\n\n* **one** t\n* two\n\n```python\nx = 1\n```")[1] == [("heading", 1, "Top"), ("item", 1, "one t"), ("item", 1, "two"), ("code", 0, "x = 1")]
    assert parts("The value \\alpha = 3 \\pm 2 was found.") == ("The value \\alpha = 3 \\pm 2 was found.", [("formula", 0, "\\alpha"), ("formula", 0, "\\pm")])
    assert parts("so \\frac{a_{1}}{b} \\bf it is \\beta_{2}.") == ("so \\frac{a_{1}}{b} it is \\beta_{2}.", [("formula", 0, "\\frac{a_{1}}{b}"), ("formula", 0, "\\beta_{2}")])
    assert parts("about {{nowrap|5 km}} and {{lang|Wort|italic=no}}{{cite web|url=x|title=y}}{{stub}}")[0] == "about 5 km and Wort"
    assert parts("{{outer|a {{cite|b}} {{nowrap|c}}}}")[0] == "a c"
    deep = "x < y"
    for _ in range(9):
        deep = deep.replace("&", "&amp;").replace("<", "&lt;")
    assert parts(deep)[0] == "x < y"
    assert parts("== Wiki ==\n[[A|b]] c{{cite|id=1}}.") == ("Wiki\nb c.", [("heading", 2, "Wiki")])
    assert parts("69 % &lt;b&gt;of&lt;/b&gt; it")[0] == "69 % of it"
    assert parts("a\x02\x03\x04 <i>b</i>")[0] == "a b"


def test_long_text_is_scanned_whole():
    assert M.has_residue("plain text. " * 200_000 + "<i>x</i>")
    assert not M.has_residue("plain < text. " * 200_000)


def test_style_tree_drops_what_is_alike(spark):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randrange(5_000)}" for _ in range(n))
    page = lambda: f'<div class="menu"><ul><li>Home</li><li>About</li></ul></div><div class="main"><p>{words(30)}</p></div><div class="foot"><p>All rights kept</p></div>'
    rows = [("abstract", str(i), "h1", page()) for i in range(40)] + [("abstract", f"o{i}", "h2", page()) for i in range(3)] + [("abstract", "n", None, None), ("abstract", "e", "h1", ""), ("abstract", "p", "h1", "plain")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "field string, row_key string, host string, text string, clean string")
    got = {r.row_key: r for r in M.clean_texts(df).collect()}
    assert set(got) == {r[1] for r in rows[:43]}
    assert all("Home" not in got[str(i)].clean and "rights" not in got[str(i)].clean and "w" in got[str(i)].clean for i in range(40))
    assert "Home" in got["o1"].clean  # too few pages of that host to tell
    assert M.clean_texts(df.limit(0)).count() == 0


def test_usual_headings_stay(spark):
    rng = random.Random(3)
    words = lambda: " ".join(f"w{rng.randrange(5_000)}" for _ in range(12))
    rows = [("abstract", str(i), "h", f"<title>Background</title>\n<p>{words()}</p><div><h4>Links</h4><p>Home About</p></div>") for i in range(60)]
    got = M.clean_texts(spark.createDataFrame(rows, "field string, row_key string, host string, text string")).collect()
    assert all(r.clean.startswith("Background\n") and "w" in r.clean and "Links" not in r.clean and r.blocks[0].kind == "heading" for r in got) and len(got) == 60


def test_siblings_are_told_apart(spark):
    rng = random.Random(2)
    words = lambda: " ".join(f"w{rng.randrange(5_000)}" for _ in range(12))
    own = lambda tag: "".join(f"<{tag}>{words()}</{tag}>" for _ in range(rng.randrange(1, 5)))
    page = {"last": lambda: own("p") + "<p>All rights reserved</p>", "first": lambda: "<p>All rights reserved</p>" + own("p"),
            "list": lambda: f"<ul>{own('li')}<li>All rights reserved</li></ul>", "table": lambda: f"<table><tr><td>All rights reserved</td></tr>{own('tr')}</table>",
            "middle": lambda: f"<p>{words()}</p><p>All rights reserved</p>{own('p')}", "head": lambda: f"<h3>{words()}</h3><p>{words()}</p><h3>All rights reserved</h3>"}
    rows = [("abstract", f"{h}{i}", h, make()) for h, make in page.items() for i in range(40)]
    got = {r.row_key: r.clean for r in M.clean_texts(spark.createDataFrame(rows, "field string, row_key string, host string, text string")).collect()}
    for _, key, host, text in rows:
        assert ("rights" in got[key]) == (host == "head")  # a heading is alike by its office
        assert re.findall(r"w\d+", got[key]) == re.findall(r"w\d+", text)


@pytest.mark.parametrize("copies", [25, 2_000])
def test_copies_of_a_page_are_one_page(spark, copies):
    copy, other = "<div><p>One abstract in many rows</p></div>", [f"<ul><li>list {i} of {i * i}</li></ul>" for i in range(5)]
    rows = [("abstract", str(i), "h", copy) for i in range(copies)] + [("abstract", f"o{i}", "h", t) for i, t in enumerate(other)]
    got = M.clean_texts(spark.createDataFrame(rows, "field string, row_key string, host string, text string")).collect()
    assert sorted(r.clean for r in got) == sorted(["One abstract in many rows"] * copies + [f"list {i} of {i * i}" for i in range(5)])


def test_branches_of_untidy_markup():
    assert [b[0] for b in M.branches("<div><p>a<p>b</div></ul><li>c")] == ["div/p/p", "div/p", "div", "li"]
    noise = {"div>1": frozenset(["x"]), "p>1": frozenset(["z"])}
    assert M.drop_branches("<div>x</div>y<p>z", noise) == "y" and M.drop_branches("<div>own words</div>y<p>z", noise) == "<div>own words</div>y"
