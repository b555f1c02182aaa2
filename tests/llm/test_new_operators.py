"""Alignment, prefix trie and exact duplicates against brute force."""

from itertools import product

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from daypanel.llm import chunk_recipes, token_alignment, turn_trie

# -- exact duplicates -----------------------------------------------------------------------------------------------------

LINES = "".join(f"Sentence number {i} is here. And a line\n" for i in range(400))
TEXTS = [
    (1, "one"), (2, "one"), (2, "one"), (3, "two"), (None, "one"), (None, "lone"), (None, "lone"), (4, None), (5, ""), (6, "One"),
    (7, LINES), (8, LINES), (9, LINES[:-1]), (10, "x" * 9000), (11, "x" * 9000), (12, "x" * 9001), (13, "é。😀" * 3000), (14, "é。😀" * 3000),
]


@pytest.mark.parametrize("names", [None, 1, 5])
def test_exact_duplicates(spark, names):
    """A few names for all chunks: contents have to tell them apart."""
    docs = spark.createDataFrame([(i, t, "x", 1, [1]) for i, t in TEXTS], "doc_id long, text string, list string, rank int, names array<int>")
    found = chunk_recipes.exact_duplicates(docs, names=names).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == brute.exact_groups(TEXTS)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found}) and all(r.doc_id == r.keep_id for r in kept)


def test_chunks_join_to_the_text(spark):
    docs = spark.createDataFrame([(t or "",) for _, t in TEXTS], "text string")
    cut = docs.select("text", chunk_recipes.chunks_of(F.col("text"), 8, 40).alias("c")).collect()
    assert all("".join(r.c) == r.text and all(0 < len(x) <= 44 for x in r.c) for r in cut)


def test_equal_passages_are_cut_alike(spark):
    docs = spark.createDataFrame([(LINES,), ("A few words before. " + LINES,)], "text string")
    one, other = (set(r.c) for r in docs.select(chunk_recipes.chunks_of(F.col("text")).alias("c")).collect())
    assert len(one & other) > 0.8 * len(one)


def test_exact_duplicates_of_nothing(spark):
    assert chunk_recipes.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_exact_duplicates_plan_has_no_python(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    plan = chunk_recipes.exact_duplicates(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Window" not in plan


# -- prefix trie ----------------------------------------------------------------------------------------------------------

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def talk(conv_id, *said):
    return [(conv_id, i, "user" if i % 2 == 0 else "bot", text) for i, text in enumerate(said)]


CONVERSATIONS = [
    *talk(0, "hi", "hello", "how", "fine", "bye", "bye", "again"), *talk(1, "hi", "hello", "how", "fine"), *talk(2, "a"), *talk(3, "a", "b"),
    *talk(4, *[f"turn {i}" for i in range(30)]), *talk(5, *[f"turn {i}" for i in range(30)]), *talk(6, *[f"turn {i % 19}" for i in range(30)]),
    *talk(250, "base is absent", "é😀"), *talk(251, "base is absent", "é😀"), *talk(-7, "below zero"), *talk(300, "x"), *talk(301, *"xyzxyzxyz"),
    (400, None, None, None), (400, 1, "user", ""), (400, 2, "user", "t"), (402, None, "", None), (403, 5, "q", "w"), (403, 9, "q", "w"),
]


@pytest.mark.parametrize("width, stride, max_rows", [(8, 1024, 10**6), (2, 2, 10**6), (3, 1, 8)])
def test_trie(spark, width, stride, max_rows):
    """Narrow blocks, short runs and cut conversations give the nodes of plain prefixes."""
    df = spark.createDataFrame([(*r, "u", 1) for r in CONVERSATIONS], "conv_id long, turn long, role string, text string, a string, pos int")
    found = turn_trie.prefix_trie(df, width, stride, max_rows).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == brute.trie(CONVERSATIONS)


def test_trie_counts_repeated_rows_and_leaves_out_nameless_ones(spark):
    rows = [(11, 1, "u", "same")] * 3 + [(None, 1, "u", "nobody")]
    found = turn_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).select(*COLUMNS)
    assert sorted(map(tuple, found.collect()), key=repr) == brute.trie(rows[:3])


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert turn_trie.prefix_trie(empty).collect() == []


def test_end_lists_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "PIECE", 3)
    rows = [r for i in range(120) for r in talk(1000 + i, "same", "turns", "all", "the", "way", "down")]
    found = turn_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).select(*COLUMNS)
    assert sorted(map(tuple, found.collect()), key=repr) == brute.trie(rows)


# -- alignment ------------------------------------------------------------------------------------------------------------

ODD = [
    (1, None), (2, ""), (3, "日本語のテキストは空白がない。" * 12), (4, "a" * 300), (5, "it's we'll  they're\n\n\tx  y 'quoted' !!'s ??'re" * 6),
    (6, "<s> <0x41> <|endoftext|> </s>▁x"), (7, "é́ ﬁ ½ 😀👍🏽" * 10), (8, " lead and trail "), (9, "\0\x01\x1c a b　c" * 5),
    (9, "the same words"), (None, "the same words"), (11, "▁ y"), (12, "the same words"), (13, "The other words, the same."),
]


@pytest.fixture(scope="module")
def aligner():
    return brute.Aligner(token_alignment.BYTE_LEVEL, token_alignment.PIECES)


@pytest.mark.parametrize("chunk", [1 << 16, 16, 3])
def test_alignment(spark, aligner, chunk, monkeypatch):
    """Chunks of a few characters: all texts are composed from fragments, over several rounds."""
    monkeypatch.setattr(token_alignment, "FAN", 4)
    docs = spark.createDataFrame([(*r, 7, "x") for r in ODD], "doc_id long, text string, seq int, uid string")
    found = token_alignment.alignment(docs, chunk=chunk).collect()
    assert sorted(map(tuple, found), key=repr) == aligner.rows(ODD)


def test_alignment_of_nothing(spark):
    assert token_alignment.alignment(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def _tokens(ends):
    return np.asarray([range(len(ends)), ends], np.int64).reshape(2, -1)


def test_composition_is_associative():
    """Any way of bracketing four byte ranges gives the same open ends and the same closed tokens."""
    draw = np.random.default_rng(1)
    for _ in range(300):
        sides = [np.flatnonzero(draw.random(24) < 0.25) + 1 for _ in range(2)]
        edges = [np.sort(draw.integers(0, 26, 3)) for _ in range(2)]
        leaves = []
        for k in range(4):
            part = tuple(_tokens(s[(s > [0, *e][k]) & (s <= [*e, 99][k])]) for s, e in zip(sides, edges))
            leaves.append(token_alignment.fragment(part))

        def joined(x, y):
            total, inner = token_alignment.compose(x[0], y[0])
            return total, x[1] + y[1] + inner

        a, b, c, d = leaves
        ways = [
            joined(joined(joined(a, b), c), d), joined(a, joined(b, joined(c, d))), joined(joined(a, b), joined(c, d)),
            joined(joined(a, joined(b, c)), d),
        ]
        shown = [
            (f.closed, *[t[1].tolist() for t in (*f.prefix, *f.suffix)], *[sorted(e for part in inner for e in part[k][1].tolist()) for k in (0, 1)])
            for f, inner in ways
        ]
        assert all(s == shown[0] for s in shown), list(product(sides))


def test_places_that_no_token_crosses(aligner):
    kit = token_alignment.tokenizers(token_alignment.BYTE_LEVEL, token_alignment.PIECES)
    for _, text in ODD:
        full = " " + (text or "")
        for cut, encode in ((kit.a_cut, lambda t: kit.a_ids(t).tolist()), (kit.b_cut, kit.b_chunk)):
            whole = encode(full)
            for p in range(1, min(len(full), 60)):
                if cut(full, p):
                    assert encode(full[:p]) + encode(full[p:]) == whole
