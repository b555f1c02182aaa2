"""Near-duplicate groups: closing of nodes, identity of rows, recall."""

import brute
import numpy as np
import pytest

from daypanel.llm import set_join


def near_rows(seed=4, groups=12, members=14):
    """Groups of texts that differ from a base in a few words each, so that many are linked only by way of others."""
    draw, rows = np.random.default_rng(seed), []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(120)]
        for _ in range(members):
            words = list(base)
            for at in draw.integers(0, 120, int(draw.integers(0, 4))):
                words[at] = f"x{draw.integers(10**6)}"
            rows.append((len(rows), " ".join(words)))
    common = [f"boilerplate{i}" for i in range(80)]
    rows += [(len(rows) + i, " ".join(common + [f"own{i}w{j}" for j in range(200)])) for i in range(40)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"SMALL": 2, "BLOCK_SKETCHES": 3}, {"SMALL": 2, "LEVELS": 1, "BLOCK_SKETCHES": 5, "BLOCK_CLASSES": 4}])
def test_groups_equal_brute_force(spark, monkeypatch, limits):
    """Nodes that are closed early and cut into small blocks give the same components."""
    for name, value in limits.items():
        monkeypatch.setattr(set_join, name, value)
    rows = near_rows()
    found = set_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.near_components(rows)


def test_common_passages_make_no_groups(spark):
    """Documents that share a passage and not enough of the rest never meet on full sets."""
    rows = near_rows(groups=0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketches = set_join.sketched(docs)
    classes = sketches.selectExpr("class_key AS key", "n_shingles AS n", "sketch")
    assert set_join.meetings(classes.cache(), 85, 3).isEmpty()


def test_first_of_each_group_tells_rows_apart(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, long, "a"), (1, "something else under the same id entirely", "b"), (2, long, "c"), (None, long, "d"), (None, long, "e"),
        (None, "a nameless text of its own", "f"), (None, "a nameless text of its own", "g"), (3, None, "h"), (4, "", "i"), (4, "", "j"),
        (None, "", "k"), (5, long + " more", "l"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _source string")
    kept = set_join.first_of_each_group(docs, percent=80)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found == sorted([(1, long), (1, rows[1][1]), (None, rows[5][1]), (3, None), (4, ""), (None, "")], key=repr)
    assert set_join.first_of_each_group(docs.where("_source = 'd' or _source = 'e'")).count() == 1


def test_trees_reach_the_recall_that_is_stated():
    """The probability that counts: over the agreeing coordinates, with the sketch limit."""
    for similarity in (0.8, 0.85):
        trees = set_join.trees_for(similarity, 0.99999)
        assert set_join.missed(similarity, trees) <= 1e-5 < set_join.missed(similarity, trees - 1)


def test_nodes_of_one_group_name_the_same_pairs(spark):
    """A group that meets in many nodes brings one pair per class and no tree of its own per node."""
    start = np.arange(set_join.TOKENS)
    sketches = [[int(x) if at >= 2 * i else -1 for at, x in enumerate(start)] for i in range(10)]  # a chain: only near ones are similar
    classes = spark.createDataFrame([(i, 100, s) for i, s in enumerate(sketches)], "key long, n long, sketch array<int>")
    nodes = [(node, i) for node in range(12) for i in range(10) if i == 0 or (i + node) % 6]
    found = set_join.close(spark.createDataFrame(nodes, "node long, key long"), classes, 85).distinct().collect()
    assert sorted((r.a, r.b) for r in found) == [(0, i) for i in range(1, 10)]
