import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spanloom.llm.components import components
from spanloom.llm.representatives import day_number, ordered, represent, status_name, version_number, work_key

STRINGS = ["doc_id", "doc_type", "community", "pmid", "pmcid", "doi", "title", "pub_date", "venue", "oa_status", "source_version", "group_key", "snapshot_date", "abstract", "author_overlap"]
SCHEMA = ", ".join(["row_id long", *[f"{c} string" for c in STRINGS], "merged_from array<string>", "author_ids array<string>", "institution_ids array<string>",
                    "shared_author_ids array<string>", "is_preprint boolean", "n_shared_authors int", "loaded_at timestamp", "component string", "_work string", "n_rows int"])


def pubs(spark, *rows):
    """Rows as dicts; columns that clash with the operator's own are there on purpose."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple({"component": "x", "_work": "y", "n_rows": 7, "loaded_at": dt.datetime(2024, 1, 1)}.get(n) if n not in r else r[n] for n in names) for r in rows], SCHEMA)


def groups(spark, *rows):
    return {r.group_row: (r.survivor_row, r.n_rows) for r in represent(pubs(spark, *rows))["records"].collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(60):03d}", f"n{rng.randrange(60):03d}") for _ in range(45)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)] + [("hub", f"s{i}") for i in range(50)] + [("q", "q"), (None, "z")]
    boss = {}

    def find(x):
        while boss.setdefault(x, x) != x:
            x = boss[x]
        return x

    for a, b in edges:
        if a and a != b:
            boss[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert got == {x: find(x) for x in boss}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_groups_and_survivors(spark):
    full = {"oa_status": "Full Text", "is_preprint": False}
    got = groups(
        spark,
        {"row_id": 1, "doc_id": "W100", "is_preprint": True, "oa_status": "fulltext"}, {"row_id": 2, "doc_id": "W200", "merged_from": ["works/w100/", "W999", None, "W200"], **full},
        {"row_id": 3, "doc_id": "W200", "source_version": "ver. 2", **full}, {"row_id": 4, "doc_id": "W200", "source_version": "V11", "snapshot_date": "May 3, 2024", **full},
        {"row_id": 5, "doc_id": "W200", "source_version": "11.0", "snapshot_date": "20240504", **full}, {"row_id": 6, "doc_id": "W200", "source_version": "meca", **full},
        {"row_id": 7, "doc_id": "W300"}, {"row_id": 8, "doc_id": None}, {"row_id": 9, "doc_id": None, "merged_from": ["<W300>"]}, {"row_id": 10, "doc_id": "W999000", "merged_from": []},
        {"row_id": 11, "doc_id": "W300", "is_preprint": False}, {"row_id": 12, "doc_id": "W300", "is_preprint": False, "oa_status": "unresolved"},
    )
    assert got == {1: (5, 6), 7: (12, 4), 8: (8, 1), 10: (10, 1)}


def test_rows_without_ids_and_without_values(spark):
    rows = [{"row_id": None, "doc_id": None}] * 2 + [{"row_id": 1, "doc_id": "W1"}, {"row_id": 2, "doc_id": " w1 ", "title": "  ", "author_ids": [None, " "], "abstract": "x" * 100_000}]
    out = represent(pubs(spark, *[{k: v for k, v in r.items()} for r in rows]))
    r = out["records"].collect()
    assert [(x.group_row, x.survivor_row, x.n_rows, x.title, len(x.abstract), x.doi) for x in r] == [(1, 1, 2, None, 100_000, None)] and out["values"].count() == 0


def test_repeated_rows_ties_and_empty_table(spark):
    row = {"row_id": 1, "doc_id": "W1", "title": "t"}
    assert groups(spark, row, row, {**row, "row_id": 2}) == {1: (1, 3)}
    out = represent(pubs(spark).limit(0))
    assert [out[k].count() for k in ("groups", "records", "values")] == [0, 0, 0]


def test_fields_take_the_value_most_trusted(spark):
    rows = []
    for g in range(30):  # published rows agree, preprints differ from each other
        base = {"doc_id": f"W{1000 + g}", "author_ids": ["A1", "A2"]}
        rows += [{"row_id": 10 * g + k, "title": f"true {g}", "is_preprint": False, "oa_status": "fulltext", **base} for k in range(2)]
        rows += [{"row_id": 10 * g + 5, "title": f"wrong {g}", "is_preprint": True, "oa_status": "unresolved", **base, "author_ids": ["A1", "A2", "A9"] if g == 0 else ["A1", "A2"]}]
    out = represent(pubs(spark, *rows))
    assert {r.title for r in out["records"].collect()} == {f"true {g}" for g in range(30)}
    q = {(r.field, r.source): r for r in out["quality"].collect()}
    assert q["title", "published/fulltext"].sensitivity > 0.9 > q["title", "preprint/unresolved"].sensitivity
    authors = {}
    for r in out["values"].where("field = 'author_ids'").collect():
        authors.setdefault(r.group_row, set()).add(r.value)
    assert authors[10] == {"A1", "A2"} and {"A1", "A2"} <= authors[0]


def test_planted_truth_with_many_preprints(spark):
    """One published row against two to five harvests of a preprint that has another DOI, date and venue, and both make mistakes."""
    rng, rows, truth = random.Random(4), [], {}
    for g in range(200):
        true = {"title": f"Work {g} on cells", "doi": f"10.1/{g}", "pub_date": f"2024-{1 + g % 12:02d}-11", "venue": f"Journal {g % 7}", "group_key": f"k{g % 5}", "abstract": f"Text {g}"}
        draft = {**true, "doi": f"10.9/pre.{g}", "pub_date": f"2023-{1 + g % 12:02d}-02", "venue": "Server"}
        truth[20 * g] = true

        def row(k, base, wrong, **more):
            made = {f: f"{v} wrong {rng.random()}" if rng.random() < wrong and f != "pub_date" else v for f, v in base.items()}
            authors = [f"A{g}", f"B{g}"] + ([f"X{k}"] if rng.random() < wrong else [])
            return {"row_id": 20 * g + k, "doc_id": f"W{5000 + g}", "author_ids": authors, **made, **more}

        published = 1 + (rng.random() < 0.5)
        rows += [row(k, true, 0.03, is_preprint=False, oa_status="fulltext") for k in range(published)]
        rows += [row(10 + k, draft, 0.2, is_preprint=True, oa_status=rng.choice(["abstract_only", "unresolved"]), merged_from=["W1"]) for k in range(rng.randrange(2, 6))]
        rows += [row(9, draft, 0.1, is_preprint=None, oa_status=None)] if rng.random() < 0.3 else []
    out = represent(pubs(spark, *rows))
    got = {r.group_row: r for r in out["records"].collect()}
    right = [got[k][f] == v for k, t in truth.items() for f, v in t.items()]
    assert sum(right) / len(right) >= 0.95
    assert not any(r.is_preprint for r in got.values()) and all(r.survivor_row == k for k, r in got.items())
    authors = {}
    for r in out["values"].where("field = 'author_ids'").collect():
        authors.setdefault(r.group_row, set()).add(r.value)
    assert sum(authors[20 * g] == {f"A{g}", f"B{g}"} for g in range(200)) >= 190
    assert {r.group_row for r in out["values"].where("field = 'merged_from'").collect()} == set(truth)  # links are kept, whoever tells them
    for field in ("*", "doi", "title"):
        q = {r.source: r for r in out["quality"].where(F.col("field") == field).collect()}
        assert q["published/fulltext"].sensitivity >= q["preprint/abstract_only"].sensitivity and q["published/fulltext"].specificity > q["preprint/abstract_only"].specificity


def test_order_of_trust_is_kept():
    assert ordered([0.5, 0.9, 0.2], [1, 3, 1]) == pytest.approx([0.8, 0.8, 0.2]) and ordered([], []) == []
    assert ordered([0.1, 0.2, 0.3], [1, 1, 1]) == pytest.approx([0.2] * 3)


def test_a_third_of_all_rows_in_one_group(spark):
    rows = spark.range(3_000).selectExpr("id AS row_id", "CASE WHEN id % 3 = 0 THEN 'W7' ELSE concat('W', 100 + id) END AS doc_id")
    for n, t in (x.split() for x in SCHEMA.split(", ") if x.split()[0] not in ("row_id", "doc_id")):
        rows = rows.withColumn(n, F.lit(None).cast(t))
    big = represent(rows)["records"].where("n_rows > 1").collect()
    assert [(r.group_row, r.survivor_row, r.n_rows) for r in big] == [(0, 0, 1_000)]


def test_spellings(spark):
    one = lambda f, x: spark.createDataFrame([(x,)], "x string").select(f(F.col("x")).alias("y")).first().y
    for x in ("W40000000237", "w40000000237", " W40000000237 ", "W40000000237\u00a0", "<W40000000237>", "works/w40000000237/", "40000000237", "https://x.org/W40000000237", "W4000\u200b0000237"):
        assert one(work_key, x) == "W40000000237"
    assert one(work_key, "row:5a") == "row:5a" and one(work_key, " ") is None
    assert [one(status_name, x) for x in (" Full-Text", "PreprintRequesterPaysPending", "other", None)] == ["fulltext", "preprint_requester_pays_pending", None, None]
    assert [one(version_number, x) for x in ("ver. 2", "V10", "012", "3.0", "meca", None)] == [2.0, 10.0, 12.0, 3.0, None, None]
    for x in ("2024-05-03", "2024/05/03", "20240503", "2024-05-03T00:00:00Z", "3 May 2024", "May 3, 2024"):
        assert one(day_number, x) == 20240503
    assert one(day_number, "soon") is None
