import random
from collections import Counter
from math import sqrt

import pytest
from hypothesis import given, settings, strategies as st

from spanloom.llm import canonical as C, windows as N

ENTRIES = [("platform", 1, "Lumaris 200", ["L200"]), ("platform", 2, "Lumaris 200X", None), ("platform", 3, "Lumaris 400", [None, "L400"]), ("platform", 4, "Orbivue 7", None), ("platform", 5, "Orbivue 7 Plus", None),
           ("platform", 6, "Palisade Imaging Station", None), ("vendor", 7, "Kelbourne Biolabs", None), ("vendor", 8, "Kelbourne Biologics", None), ("format", 9, "CellMat", [".cm5"]), ("format", 10, "CellMat-Z", None),
           ("format", 11, "Delimited Text", None), ("format", 12, "Delimited Text Gzip", None)]
REF = "value_set string, canonical_id long, canonical_form string, known_as array<string>"
CASES = [("platform", "lumaris-200", 1), ("platform", "ＬＵＭＡＲＩＳ 200 system", 1), ("platform", "Lumaris Instruments Lumaris 200X", 2), ("platform", "luvaris 400", 3), ("platform", "L400", 3), ("platform", "200, Lumaris", 1),
         ("platform", "Lumaris 300", 0), ("platform", "orbivue 7 pllus", 5), ("platform", "Orbivue VII", 4), ("platform", "Orbivue VII+", 5), ("platform", "orbivue 7+", 5), ("format", "CellMats", 9), ("format", "CellMat-Zs", 10), ("platform", "Palisade Imaging Stn.", 6), ("platform", "wexmoor dial", 0), ("platform", "  ", 0), ("platform", "—", 0),
         ("vendor", "Kelbourne Bioabs", 7), ("vendor", "kelbourne biologisc", 8), ("format", "CELLMAT (gz)", 9), ("format", "cellmat-z file", 10), ("format", ".cm5", 9), ("format", "Delimited Text Gip", 12),
         ("format", "compressed Delimited Text", 11), ("platform", "Lum\u200baris 20\ufeff0", 1), ("platform", "x" * 5_000, 0), ("other", "CellMat", 0)]


@pytest.mark.parametrize("shards", [None, 3])
def test_values_and_shards(spark, shards):
    ref = spark.createDataFrame(ENTRIES, REF)
    values = spark.createDataFrame([(s, v, 5) for s, v, _ in CASES] + [("platform", None, 5)], "value_set string, value string, canonical_id int")
    got = {(r.value_set, r.value): r.canonical_id for r in C.map_values(values, ref, shards).collect()}
    assert got == {(s, v): i for s, v, i in CASES} | {("platform", None): 0}


@pytest.mark.parametrize("seed", range(5))
def test_shards_hits_mean_what_the_whole_list_means(seed):
    rng = random.Random(seed)
    names = [(i // 2, " ".join(rng.choice(["orbi", "orbit", "plus", "pls", "station", "7", "2", "lumar"]) for _ in range(rng.randrange(1, 4)))) for i in range(60)]
    whole, shards = C.Index(names), [C.Index([x for x in names if x[0] % 4 == k]) for k in range(4)]
    for _ in range(300):
        value = list(rng.choice(names)[1] + rng.choice(["", " ii", " plus", " orbi", " x"]))
        for _ in range(rng.randrange(3)):
            value[rng.randrange(len(value))] = rng.choice("abclo .,7")
        value = "".join(value)
        assert C.decide([h for s in shards for h in s.hits(value)]) == whole.best(value), value


def test_names_split_across_shards(spark):
    ref = spark.createDataFrame([("p", i, n, None) for i, n in ((1, "Orbivue 7"), (2, "Orbivue 7 Plus"))] +
                                [("t", i, n, None) for i, n in ((4, "abcdefgx"), (5, "abcdefgy"), (6, "abcdexyz"))], REF)
    values = spark.createDataFrame([("p", "orbivue 7 pllus"), ("t", "abcdefgz")], "value_set string, value string")
    want = sorted(tuple(r) for r in C.map_values(values, ref, 0).collect())
    assert want == [("p", "orbivue 7 pllus", 2), ("t", "abcdefgz", 0)]
    for shards in (2, 3, 5):
        assert sorted(tuple(r) for r in C.map_values(values, ref, shards).collect()) == want


def test_typed_and_respelt(spark):
    ref = spark.createDataFrame(ENTRIES, REF)
    rec = spark.createDataFrame([("a", {"platform": "Lumaris 200", "format": "cellmat"}), ("b", {"platform": "", "vendor": None}), ("c", {"platform": "not_stated", "format": "no_statement"}), ("d", None),
                                 ("e", {"platform": "junk"}), ("e", {"platform": "junk"})], "record_id string, attributes map<string,string>")
    typed = C.typed_values(rec, ["platform", "vendor", "format"])
    assert sorted(tuple(r) for r in C.respelt(typed, ref).collect()) == [("a", "format", 9), ("e", "platform", 0)]
    assert {r.canonical_id for r in C.respelt(typed, ref.limit(0)).collect()} == {0}
    assert C.respelt(typed.limit(0), ref).count() == 0


def test_shards_agree_on_all_typed_values(spark):
    from conftest import DATA

    ref = spark.read.parquet(f"{DATA}/canonical_values.parquet")
    values = C.typed_values(spark.read.parquet(f"{DATA}/records.parquet"), ["platform", "vendor", "repository", "format"]).select("value_set", "value").distinct()
    want = sorted(tuple(r) for r in C.map_values(values, ref).collect())
    for shards in (2, 3, 8):
        assert sorted(tuple(r) for r in C.map_values(values, ref, shards).collect()) == want


def test_a_long_list_is_searched_in_time():
    import time

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    names = [(i, f"{word()} {word()} {rng.choice(['', rng.randrange(9)])}".strip()) for i in range(5_000)]
    index = C.Index(names)
    began, missed = time.perf_counter(), 0
    for _ in range(300):
        number, name = rng.choice(names)
        at = rng.randrange(1, len(name) - 2)
        typo = name[:at] + "z" + name[at:]
        missed += number not in {n for d, hit in index.near(C._key(C.words(typo))) for n in index.ids[hit]}
    assert missed == 0 and (time.perf_counter() - began) / 300 < 0.02


WORD = st.text("abc", max_size=7)


@settings(max_examples=300, deadline=None)
@given(WORD, WORD, WORD)
def test_distance_is_a_metric(a, b, c):
    d = C.distance
    assert d(a, b) == d(b, a) and (d(a, b) == 0) == (a == b) and d(a, c) <= d(a, b) + d(b, c)
    assert d("ab", "ba") == 1 and d("ca", "abc") == 2
    assert all(d(a, b, n) == d(a, b) if d(a, b) <= n else d(a, b, n) > n for n in range(4))
    assert max((C.letters(a) & ~C.letters(b)).bit_count(), (C.letters(b) & ~C.letters(a)).bit_count()) <= d(a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(WORD, max_size=40), WORD, st.integers(0, 3), st.integers(0, 5))
def test_tree_equals_a_full_scan(keys, query, limit, leaf):
    class Tree(C.BKTree):
        LEAF = leaf

    assert sorted(set(Tree(iter(keys)).within(query, limit))) == sorted({(d, k) for k in keys if (d := C.distance(query, k)) <= limit})
    assert sorted(set(C.BKTree(iter(keys)).within(query, limit))) == sorted({(d, k) for k in keys if (d := C.distance(query, k)) <= limit})


def text_of(rng, n):
    topics = [[f"{t}{chr(97 + i)}word" for i in range(8)] for t in "abc"]
    return " ".join(" ".join(rng.choices(topics[i * 3 // n], k=9)).capitalize() + "." for i in range(n))


@pytest.mark.parametrize("seed", range(5))
def test_valleys_against_brute_force(seed):
    rng = random.Random(seed)
    text = text_of(rng, rng.randrange(2, 60))
    at = N.gaps(text)
    units = [Counter(N._TERM.findall(text[a:b].lower())) for a, b in zip([0, *at], [*at, len(text)])]
    near = []
    for i in range(1, len(units)):
        a, b = sum(units[max(0, i - N.BLOCK):i], Counter()), sum(units[i:i + N.BLOCK], Counter())
        near.append(sum(n * b[w] for w, n in a.items()) / sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values())) if a and b else 0.0)

    def peak(i, step):
        while 0 <= i + step < len(near) and near[i + step] >= near[i]:
            i += step
        return near[i]

    assert N.valley_depths(text, at) == pytest.approx([peak(i, -1) + peak(i, 1) - 2 * x for i, x in enumerate(near)])


@pytest.mark.parametrize("seed", range(3))
def test_cuts_hit_planted_changes_of_topic(seed):
    """Texts of paragraphs on changing topics, two to four changes a window: how many cuts fall on a planted change."""
    rng, hit, cuts = random.Random(seed), 0, 0
    topics = [[f"{a}{b}word" for b in "bcdfghjk"] for a in "abcdefgh"]
    for _ in range(6):
        text, changes, last = "", set(), None
        while len(text) < 20_000:
            last = rng.choice([t for t in topics if t is not last])
            if text:
                changes.add(len(text) - 1)
            text += " ".join(" ".join(rng.choices(last, k=9)).capitalize() + "." for _ in range(rng.randrange(8, 14))) + " "
        found = N.Cutter(text, 4_000, 200).windows()
        assert all(b - a <= 4_000 for a, b in found) and all(x[1] - 200 == y[0] for x, y in zip(found, found[1:]))
        cuts += len(found) - 1
        hit += sum(b in changes for _, b in found[:-1])
    assert cuts > 25 and hit / cuts >= 0.9


def test_repeated_windows_are_counted(spark):
    w = spark.createDataFrame([("d", 0, 0, 5)] * 500 + [("d", 1, 3, 8), (None, 0, 0, 1)], "doc_id string, window_index int, window_start int, window_end int")
    parsed = spark.createDataFrame([("d", "ab cd ef gh")], "doc_id string, text string")
    got = [(r.window_index, r.faults) for r in N.review_windows(w, parsed, 6, 2).collect()]
    assert got == [(0, ["overlap"])]  # the copies; the window behind them begins where it should


def test_cut_falls_on_the_change_of_topic():
    text = text_of(random.Random(1), 60)
    change = next(g for g in N.gaps(text) if text[g:].strip().lower().startswith("b") and text[:g].split()[-1].lower().startswith("a"))
    assert N.Cutter(text, change * 4 // 3, 10).end(0) == change


@pytest.mark.parametrize("text", ["word " * 3_000, "x" * 12_000, "a. " * 4_000, "é\n" * 6_000, "", "short."])
def test_windows_stay_within_the_limit(text):
    w = N.Cutter(text, 1_000, 100).windows()
    assert all(b - a <= 1_000 for a, b in w) and (w[0][0] == 0 and w[-1][1] == len(text) if text else w == [])
    assert all(w[i + 1][0] == w[i][1] - 100 for i in range(len(w) - 1))
    with pytest.raises(ValueError):
        N.Cutter(text, 10, 5)


def test_split_and_review(spark):
    t = "One two three. " * 10
    parsed = spark.createDataFrame([("a", t, "k"), ("n", None, "k"), ("e", "", "k")], "doc_id string, text string, given string")
    assert {r.doc_id for r in N.split_texts(parsed, 60, 10).collect()} == {"a"}
    w = [("a", 0, 0, 45), ("a", 1, 35, 100), ("a", 2, 91, 148), ("a", 3, 138, 151), ("n", 0, 0, 70), ("n", 1, 60, 61), ("e", 0, 0, 1), ("x", 0, None, 5), ("x", 0, None, 5), (None, 0, 0, 5)]
    given_ = spark.createDataFrame(w, "doc_id string, window_index int, window_start int, window_end int")
    got = {(r.doc_id, r.window_index): (r.faults, r.better_end) for r in N.review_windows(given_, parsed, 60, 10).collect()}
    assert got == {("a", 1): (["too_long", "inside_word"], 89), ("a", 2): (["overlap"], 150), ("a", 3): (["past_end"], 150), ("n", 0): (["too_long"], None), ("e", 0): (["past_end"], None), ("x", 0): (["null"], None)}
    assert N.faults("abcd ef", [(0, 2), (2, 5)], 60, 0) == [["inside_word"], []]
    assert N.review_windows(given_.limit(0), parsed).count() == 0
