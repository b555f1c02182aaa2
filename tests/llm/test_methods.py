"""Estimates, searches and rules against plain versions."""

import math
import re

import numpy as np
import pytest

from daypanel.llm import mixing, rule_votes
from daypanel.llm.queries import op3_url_filter

SF_DIRS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")


def ruled(url):
    """(host, path, rule, verdict) by plain code; verdict None where no rule fits."""
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", "", None, None
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in found[1])
    fits = []
    for rule in rules:
        name, path = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and found[2].startswith("/" + path):
            fits.append(rule)
    best = max(fits, key=len, default=None)
    return host, found[2], best, rules.get(best)


@pytest.mark.parametrize("sf_dir", SF_DIRS)
def test_url_rules_of_the_query(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    found = op3_url_filter(spark, sf_dir).collect()
    assert len(found) == len(urls)
    for r in found:
        host, path, rule, verdict = ruled(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_mostly_bad_documents_have_a_low_prior():
    """Nine of ten documents are bad: the prior says so, and verdicts follow the votes."""
    draw = np.random.default_rng(0)
    patterns, bad_rows = {}, {}
    for _ in range(20_000):
        bad = draw.random() < 0.9
        votes = tuple(int(v) for v in draw.choice([-1, 0, 1], 6, p=[0.6, 0.2, 0.2] if bad else [0.03, 0.2, 0.77]))
        patterns[votes] = patterns.get(votes, 0) + 1
        bad_rows[votes] = bad_rows.get(votes, 0) + bad
    model = rule_votes.estimate(patterns)
    assert model.prior == pytest.approx(0.1, abs=0.02)
    wrong = sum(bad_rows[v] if model.posterior(v) >= 0.5 else n - bad_rows[v] for v, n in patterns.items())
    assert wrong < 0.02 * 20_000


def test_exponent_equals_a_bisection(spark):
    tokens = [10_000, 3_000, 500, 400, 20]
    sources = spark.createDataFrame([(str(i), n) for i, n in enumerate(tokens)], "source string, tokens long")
    shares = np.asarray(tokens) / sum(tokens)

    def entropy(a):
        w = shares**a / (shares**a).sum()
        return -(w * np.log(w)).sum() / math.log(len(w))

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if entropy(middle) >= 0.8 else (low, middle)
    assert mixing.exponent(sources, 0.8, 1e9, 1.0) == pytest.approx(low, abs=1e-5)
    # the repetition limit stops earlier: the smallest source would come too often
    limited = mixing.exponent(sources, 0.8, 3.0, 1.0)
    weights = shares**limited / (shares**limited).sum()
    assert limited > low and (weights / shares).max() == pytest.approx(3.0, abs=1e-2)


def test_a_budget_out_of_reach_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="2.0 times all tokens are missing"):
        mixing.mixed(docs, max_repeats=4.0, budget_share=6.0)
