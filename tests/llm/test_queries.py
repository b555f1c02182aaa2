"""Registered queries against SQL, the pipeline stage by stage, and the guard around this subpackage."""

import subprocess
import sys

import pytest
from compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", ["op2_warc", "op5_decontamination", "op12_prefix_trie", "op13_exact_duplicates"])
def test_query_against_sql(spark, connection, name):
    from daypanel.llm.checks import CHECKS
    from daypanel.llm.queries import QUERIES

    assert differences(QUERIES[name](spark, SF_DIR), connection, CHECKS[name]) is None


def test_pipeline(spark):
    import brute
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(p.STAGES)
    told = stages["language"](spark, docs, SF_DIR).cache()
    assert told.columns == docs.columns and told.count() >= 0.97 * docs.count()
    single = stages["near_duplicates"](spark, told, SF_DIR).cache()
    groups = brute.near_components([(r.doc_id, r.text) for r in told.select("doc_id", "text").collect()], percent=80)
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values()))
    clean = stages["decontaminate"](spark, single, SF_DIR).cache()
    wanted = sorted(r.doc_id for r in single.collect() if not brute.contaminated(r.text, items)[-1])
    assert sorted(r.doc_id for r in clean.collect()) == wanted
    mixed = stages["mix"](spark, clean, SF_DIR)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= set(wanted)
    assert stages["pack"](spark, mixed, SF_DIR).count() > 0


def test_pipeline_joins_near_duplicates_from_80_percent(spark):
    """Pairs of 0.81 to 0.84 are one document to the stage; op9's threshold of 0.85 would leave both."""
    import brute
    import corpus_pipeline as p

    rows = []
    for i, changed in enumerate((17, 18, 19, 20)):  # last words of 204 that are new
        words = [f"w{i}x{j}" for j in range(204)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[: 204 - changed] + [f"n{i}x{j}" for j in range(changed)]))]
    shares = [len(a & b) / len(a | b) for a, b in ((brute.shingle_set(rows[k][1]), brute.shingle_set(rows[k + 1][1])) for k in range(0, 8, 2))]
    assert all(0.81 <= s <= 0.85 for s in shares)
    found = dict(p.STAGES)["near_duplicates"](spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_DIR)
    assert sorted(r.doc_id for r in found.collect()) == sorted(set(brute.near_components(rows, percent=80).values())) == [0, 2, 4, 6]
    assert len(set(brute.near_components(rows).values())) == 8


def test_entry_without_the_subpackage(tmp_path):
    code = (
        "import sys; sys.path.insert(0, '/root/repo'); sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries()); assert e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], check=True)
