"""Quality rules as weak supervision, in DataFrame operations only.

Each rule reads one measure of a text and votes good, bad or not at all. The votes of all documents are counted by
pattern (at most 3**rules patterns, whatever the number of documents); expectation-maximisation on these counts
estimates how often each rule is right and how common good documents are. A document is kept if the probability that
it is good, given its votes, reaches the threshold, and the base rule doesn't fail it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.words import blank_words, shingle_hashes
from daypanel.sources.scratch import materialised

SYMBOLS = r"[#*$%&|<>]"
REPEAT = 5


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good`` and bad from ``bad`` on (or the other way round if good > bad), else abstains."""

    measure: str
    good: float
    bad: float

    def vote(self) -> Column:
        x = F.col(self.measure)
        up = self.good < self.bad
        good, bad = (x <= self.good, x >= self.bad) if up else (x >= self.good, x <= self.bad)
        return F.when(bad, -1).when(good, 1).otherwise(0)


RULES = (
    Rule("n_words", 50, 10),
    Rule("word_length", 10, 14),
    Rule("symbols_per_word", 0.05, 0.3),
    Rule("dup_line_share", 0.1, 0.4),
    Rule("repeat_share", 0.05, 0.2),
    Rule("upper_share", 0.15, 0.5),
    Rule("marks_per_word", 0.2, 0.6),
)


def _repeated_words(hashes: Column, k: int) -> Column:
    """Words inside windows whose hash occurs twice or more. Hashes and places are sorted, never compared in pairs."""
    def marked(ordered: Column) -> Column:
        same = lambda x, i, step: F.coalesce(F.get(ordered, i + step).h == x.h, F.lit(False))
        places = F.transform(ordered, lambda x, i: F.when(same(x, i, 1) | ((i > 0) & same(x, i, -1)), x.p))
        return F.sort_array(F.filter(places, lambda p: p.isNotNull()))
    return marked(hashes)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and the measures of the rules; a null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("words", blank_words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"[A-ZÀ-ÖØ-Þ]")).alias("n_upper"),
        F.regexp_count("text", F.lit(r"[!?#*$%&|<>{}\[\]=_~^]")).alias("n_marks"),
        lines.alias("lines"),
    )
    rows = rows.withColumn("hashes", shingle_hashes("words", REPEAT))
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_upper", "n_marks",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.filter("hashes", lambda h: h.isNotNull()).alias("hashes"),
    )
    # sorting places along is needed only where some hash occurs twice
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.when(again, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    rows = rows.withColumn("placed", placed).withColumn("places", _repeated_words(F.col("placed"), REPEAT)).drop("hashes", "placed")
    gap = lambda p, i: F.least(F.lit(REPEAT), F.coalesce(F.get("places", i + 1) - p, F.lit(REPEAT)))
    covered = F.aggregate(F.transform("places", gap), F.lit(0), lambda total, x: total + x)
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")
    per_word = lambda c: F.col(c) / F.greatest("n_words", F.lit(1))
    return rows.withColumns({
        "word_length": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": per_word("n_repeat_words"),
        "upper_share": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
        "marks_per_word": per_word("n_marks"),
    })


@dataclass(frozen=True)
class Estimate:
    """Prior of good; for each rule the rates of (bad, none, good) votes among bad and among good documents."""

    prior: float
    bad: tuple[tuple[float, float, float], ...]
    good: tuple[tuple[float, float, float], ...]

    def log_odds(self, rule: int, vote: int) -> float:
        return math.log(self.good[rule][vote + 1] / self.bad[rule][vote + 1])

    def posterior(self, votes: tuple[int, ...]) -> float:
        odds = math.log(self.prior / (1 - self.prior)) + sum(self.log_odds(i, v) for i, v in enumerate(votes))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 60, pseudo: float = 1.0) -> Estimate:
    """Expectation-maximisation over vote patterns and their counts.

    Starts from bad documents that each break about a fifth of the rules, and good ones that break hardly any. A bad
    vote may never come to speak for good nor a good vote for bad, else the classes would be free to change places.
    """
    n_rules = len(next(iter(patterns), ()))
    now = Estimate(0.85, ((0.2, 0.1, 0.7),) * n_rules, ((0.01, 0.1, 0.89),) * n_rules)
    total = sum(patterns.values())
    if not total:
        return now
    for _ in range(rounds):
        share = {votes: now.posterior(votes) for votes in patterns}
        mass = sum(patterns[v] * p for v, p in share.items())
        bad, good = [], []
        for i in range(n_rules):
            b, g = [pseudo] * 3, [pseudo] * 3
            for votes, n in patterns.items():
                g[votes[i] + 1] += n * share[votes]
                b[votes[i] + 1] += n * (1 - share[votes])
            g, b = [x / sum(g) for x in g], [x / sum(b) for x in b]
            # a bad vote may not speak for good, nor a good vote for bad, nor an abstention for either
            if b[0] < g[0]:
                b[0] = g[0] = (b[0] + g[0]) / 2
            if g[2] < b[2]:
                b[2] = g[2] = (b[2] + g[2]) / 2
            b[1] = g[1] = (b[1] * (1 - mass / total) + g[1] * mass / total)
            bad.append(tuple(x / sum(b) for x in b))
            good.append(tuple(x / sum(g) for x in g))
        now = Estimate((mass + pseudo) / (total + 2 * pseudo), tuple(bad), tuple(good))
    return now


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, posterior and kept for every row of ``docs`` (doc_id, text).

    A null or empty text has no words and fails the base rule. Repeated rows and null ids are judged row by row. An
    empty table gives an empty table.
    """
    rows = materialised(measured(docs), "measures")
    votes = [rule.vote().alias(f"v{i}") for i, rule in enumerate(rules)]
    counted = rows.groupBy(*votes).agg(F.count("*").alias("n")).collect()  # one row per vote pattern
    model = estimate({tuple(r[: len(rules)]): r.n for r in counted} or {(0,) * len(rules): 0})
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for i, rule in enumerate(rules):
        v = rule.vote()
        odds = odds + F.when(v < 0, model.log_odds(i, -1)).when(v > 0, model.log_odds(i, 1)).otherwise(model.log_odds(i, 0))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (1 / (1 + F.exp(-odds))).alias("posterior"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
