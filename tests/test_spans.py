import pytest
from pyspark.sql import functions as F

from spanloom.operators import spans as S


def windows(spark, n, *args):
    df = spark.createDataFrame([(n,)], "n int")
    return [(r.window_start, r.window_end) for r in S.fixed_windows(df, F.col("n"), *args).orderBy("window_index").collect()]


def test_windows(spark):
    assert windows(spark, 100) == [(0, 100)]
    w = windows(spark, 100_000)
    assert len(w) == 4 and w[0] == (0, 30_000) and w[-1][1] == 100_000
    assert all(b[0] == a[1] - 1_500 for a, b in zip(w, w[1:]))
    assert windows(spark, 0) == [] and windows(spark, None) == []
    with pytest.raises(ValueError):
        windows(spark, 10, 0)
    with pytest.raises(ValueError):
        windows(spark, 10, 5, 5)


def test_merge_touching_separate_clamped(spark):
    a = spark.createDataFrame([("d", 100, 110), ("d", 150, 160), ("d", 5_000, 5_010), ("e", 0, 3), ("e", 0, 3)], "doc_id string, start int, end int")
    n = spark.createDataFrame([("d", 5_050), ("e", 9)], "doc_id string, n int")
    got = sorted(tuple(r) for r in S.anchor_windows(a, n, 100).collect())
    assert got == [("d", 0, 260), ("d", 4_900, 5_050), ("e", 0, 9)]
    assert S.anchor_windows(a.limit(0), n, 100).count() == 0


def test_merge_over_bins_equals_plain_sweep(spark):
    import random

    rng = random.Random(3)
    rows = [(f"d{rng.randrange(3)}", s := rng.randrange(90_000), s + rng.randrange(1, 4_000)) for _ in range(400)]
    got = sorted(tuple(r) for r in S.merge_spans(spark.createDataFrame(rows, "k string, start int, end int"), "k", 1_000).collect())
    want = []
    for k in sorted({r[0] for r in rows}):
        out = []
        for _, s, e in sorted(r for r in rows if r[0] == k):
            if out and s <= out[-1][1]:
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([s, e])
        want += [(k, *o) for o in out]
    assert got == want


def test_narrowest_cover_and_ties(spark):
    sections = [(["a"], "", 0, 100), (["b", "c"], "", 10, 20), (["d"], "", 10, 20), ([], "", 30, 31)]
    parsed = spark.createDataFrame([("x", sections), ("y", None)], "doc_id string, sections array<struct<labels:array<string>,title:string,start:int,end:int>>")
    points = spark.createDataFrame([("x", 5), ("x", 10), ("x", 19), ("x", 20), ("x", 30), ("x", 100), ("y", 0), ("z", 0)], "doc_id string, p int")
    got = {(r.doc_id, r.p): r.section for r in S.section_at(points, parsed, "p").collect()}
    assert got == {("x", 5): "a", ("x", 10): "b", ("x", 19): "b", ("x", 20): "a", ("x", 30): "unknown", ("x", 100): "unknown", ("y", 0): "unknown", ("z", 0): "unknown"}


def test_containment_and_overlap_across_bins(spark):
    big = spark.createDataFrame([("d", 0, 3 * S.BIN), ("d", 5 * S.BIN, 5 * S.BIN + 10)], "doc_id string, start int, end int")
    small = spark.createDataFrame([("d", 2 * S.BIN - 1, 2 * S.BIN + 1), ("e", 1, 2)], "doc_id string, start int, end int")
    assert [tuple(r) for r in S.holds_any(big, small, ["doc_id"]).collect()] == [("d", 0, 3 * S.BIN)]
    assert [tuple(r) for r in S.outside_all(small, big, ["doc_id"], "start", "end").collect()] == [("e", 1, 2)]
    assert [tuple(r) for r in S.overlaps_any(big, small, ["doc_id"]).collect()] == [("d", 0, 3 * S.BIN)]


def test_context_is_clamped(spark):
    df = spark.createDataFrame([("abcdefghij", 4, 6)], "t string, s int, e int")
    assert df.select(S.context(F.col("t"), F.col("s"), F.col("e"), 2).alias("x")).first().x == "cdefgh"
    assert df.select(S.context(F.col("t"), F.col("s"), F.col("e"), 99).alias("x")).first().x == "abcdefghij"
