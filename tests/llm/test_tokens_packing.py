import random

import pytest
from hypothesis import given, settings, strategies as st

from spanloom.llm import packing as K, tokenizer as Z

VOCABULARY = f"{Z.TOKENIZERS}/{Z.VOCABULARY}"


@pytest.fixture(scope="module")
def encoder():
    return Z.Encoder(open(VOCABULARY, "rb").read())


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{Z.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "it's we'll I'M", "<|endoftext|>", "a" * 20_000, "ab" * 9_000, " " * 5_000 + "x", "\n\n \t x", "🧬🧫 👩🏽‍🔬", "細胞の画像", "étude näive \u202eabc", "x = y[i] + 0x1F;  // n²", "ﬁnal 3\u00b2"])
def test_ids_equal_the_reference(encoder, reference, text):
    assert encoder.encode(text) == reference(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoder, reference, text):
    assert encoder.encode(text) == reference(text)


def plain_merge(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return parts
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=24).map(lambda b: bytes(97 + x % 3 for x in b)), st.lists(st.binary(min_size=2, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12))
def test_segment_tree_equals_plain_merging(piece, merges):
    ranks = {m: i for i, m in enumerate(dict.fromkeys(merges))}
    assert Z.merge_ranks(piece, ranks.get) == plain_merge(piece, ranks)


def test_encode_rows(spark, encoder):
    df = spark.createDataFrame([(1, "Hello there", "x"), (2, None, "x"), (3, "", "x"), (1, "Hello there", "x"), (None, "a", "x")], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in Z.encode(df, "doc_id", "text").collect()), key=str)
    assert got == sorted([(1, encoder.encode("Hello there")), (2, []), (3, []), (1, encoder.encode("Hello there")), (None, encoder.encode("a"))], key=str)
    assert sorted(r.n_tokens for r in Z.encode(df, "doc_id", "text", counts_only=True).collect()) == [0, 0, 1, 2, 2]
    assert Z.encode(df.limit(0), "doc_id", "text").count() == 0


def plain_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        k = next((i for i, r in enumerate(room) if r >= s), len(room))
        if k == len(room):
            room.append(capacity)
        room[k] -= s
        out.append(k)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60))
def test_tournament_equals_plain_first_fit(sizes):
    sizes = sorted(sizes, reverse=True)
    assert K.first_fit_decreasing(sizes, 20) == plain_fit(sizes, 20)
    with pytest.raises(ValueError):
        K.first_fit_decreasing([21], 20)


def test_pack(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 3, 7, 10, 11, 25, 30])) for i in range(400)] + [(7, 4)] * 200 + [(None, 5), (None, 25), (None, 25)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, n int, container string")
    got = K.pack(df, "doc_id", "n", capacity=10, group_items=100).collect()
    used, per = {}, {}
    for r in got:
        used[r.container] = used.get(r.container, 0) + r.piece_tokens
        key = (r.doc_id, r.copy)
        per.setdefault(key, []).append((r.piece, r.piece_start, r.piece_tokens))
    assert max(used.values()) <= 10 and sum(used.values()) == sum(n for _, n in rows)
    items = sum(1 for _, n in rows)
    assert len({(r.doc_id, r.copy, r.piece, r.container) for r in got}) == len(got) == sum(max(1, -(-n // 10)) for _, n in rows) and items == len(rows)
    assert sum(used.values()) / (10 * len(used)) > 0.93
    assert sorted(per[7, 199]) == [(0, 0, 4)]
    assert sorted((r.piece, r.piece_tokens) for r in got if r.doc_id is None and r.copy == 1) == [(0, 10), (1, 10), (2, 5)]
    assert K.pack(df.limit(0), "doc_id", "n").count() == 0
