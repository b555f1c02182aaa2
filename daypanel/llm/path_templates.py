"""URL filter: exact rules first, then a tree of path templates per host.

The tree is grown level by level over all distinct paths of all hosts at once, as deep as they are; a path that has ended,
or that stands alone under its prefix, leaves the loop. At each level, under each prefix:

1. a segment with too few pages to be judged is variable and becomes its shape (digits as ``<n>``, other text as ``<s>``,
   an extension stays), and so does a number whose share of bad labels doesn't differ from that of its siblings;
2. branches whose share of bad labels doesn't differ from that of their siblings (two-proportion z-test) merge into
   ``*``; a branch that differs keeps its name.

A template is rejected if its smoothed share of good labels, shrunk towards its host's and the host's towards the
overall share, is below a threshold. Work per host is sums by prefix, so a host that holds a third of all pages is
pre-aggregated like any other.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.words import LOWER, UPPER
from daypanel.sources.scratch import materialised

NUMBER = r"^[0-9]+(\.[A-Za-z]{1,5})?$"
#: Tables of finished paths that are read together before they are written as one.
TABLES = 32


@dataclass(frozen=True)
class Rule:
    """``name`` is a host and a path prefix; the host stands for its subdomains too."""

    name: str
    allow: bool

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.name.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a text without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def first_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, ties by name; null if none does."""
    name = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits, says = rule.fits(host, path), "allow" if rule.allow else "block"
        name = F.when(fits, rule.name) if name is None else name.when(fits, rule.name)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if name is None else (name, verdict)


def shape(segment: Column) -> Column:
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    digits = F.regexp_replace(segment, r"[0-9]+", "<n>")
    return F.when(segment.rlike(r"[0-9]"), F.when(F.length(digits) <= 24, digits).otherwise(F.concat(F.lit("<n>"), ending))).when(
        segment == "", F.lit("")
    ).otherwise(F.concat(F.lit("<s>"), ending))


def _differs(labelled: Column, bad: Column, all_labelled: Column, all_bad: Column, z_limit: float) -> Column:
    """Two-proportion z-test of a branch against its siblings."""
    other, other_bad = all_labelled - labelled, all_bad - bad
    pooled = all_bad / F.greatest(all_labelled, F.lit(1))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(labelled, F.lit(1)) + 1 / F.greatest(other, F.lit(1))))
    apart = F.abs(bad / F.greatest(labelled, F.lit(1)) - other_bad / F.greatest(other, F.lit(1)))
    return (labelled > 0) & (other > 0) & (spread > 0) & (apart > spread * z_limit)


def _level(rows: DataFrame, min_support: int, z_limit: float) -> DataFrame:
    """One more segment of every row's prefix; rows (host, path, prefix, rest, n, labelled, bad), none with an empty rest.

    A row that stands alone under its prefix takes all of its segments: none of them has a sibling.
    """
    counts = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    rows = rows.withColumn("segment", F.get("rest", F.lit(0)))
    branches = materialised(rows.groupBy("host", "prefix", "segment").agg(*counts, F.count("*").alias("paths")), "branches")
    parents = branches.groupBy("host", "prefix").agg(F.sum("labelled").alias("L"), F.sum("bad").alias("B"), F.sum("paths").alias("all"))
    tested = _differs(F.col("labelled"), F.col("bad"), F.col("L"), F.col("B"), z_limit)
    own = (F.col("n") >= min_support) & (~F.col("segment").rlike(NUMBER) | tested)
    name = F.when(own, F.col("segment")).otherwise(shape(F.col("segment")))
    named = materialised(branches.join(parents, ["host", "prefix"]).withColumn("name", name), "named")
    merged = named.groupBy("host", "prefix", "name").agg(*counts, F.first("L").alias("L"), F.first("B").alias("B"))
    siblings = merged.groupBy("host", "prefix").agg(F.count("*").alias("k"))
    differs = _differs(F.col("labelled"), F.col("bad"), F.col("L"), F.col("B"), z_limit)
    branch = F.when((F.col("k") == 1) | differs, F.col("name")).otherwise("*")
    merged = merged.join(siblings, ["host", "prefix"]).select("host", "prefix", "name", branch.alias("branch"))
    names = named.select("host", "prefix", "segment", "name", (F.col("all") == 1).alias("alone")).join(merged, ["host", "prefix", "name"])
    grown = rows.join(names.select("host", "prefix", "segment", "branch", "alone"), ["host", "prefix", "segment"])
    left = F.slice("rest", 2, F.greatest(F.size("rest") - 1, F.lit(1)))
    last = lambda s: F.when((F.col("n") >= min_support) & ~s.rlike(NUMBER), s).otherwise(shape(s))
    ended = F.when(F.col("alone"), F.transform(left, last)).otherwise(F.array().cast("array<string>"))
    prefix = F.concat_ws("/", "prefix", "branch", ended)
    rest = F.when(F.col("alone"), F.array().cast("array<string>")).otherwise(left)
    return grown.select("host", "path", prefix.alias("prefix"), rest.alias("rest"), "n", "labelled", "bad")


def templates(paths: DataFrame, min_support: int = 20, z_limit: float = 2.58, smoothing: float = 10.0, min_purity: float = 0.5) -> DataFrame:
    """host, path, template, purity, rejected for each distinct (host, path) of ``paths`` (host, path, bad: 0, 1 or null).

    The path of a URL that ends in ``/`` has an empty last segment, so ``/a`` and ``/a/`` differ. Without labels the
    purity is 1 and nothing is rejected.
    """
    rows = paths.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    parts = F.split(F.col("path"), "/")
    inner = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1)))
    rows = materialised(rows.select("host", "path", F.lit("").alias("prefix"), inner.alias("rest"), "n", "labelled", "bad"), "paths")
    ended = []
    while True:
        ended.append(rows.where(F.size("rest") == 0).drop("rest"))
        rows = rows.where(F.size("rest") > 0)
        if rows.isEmpty():
            break
        if len(ended) == TABLES:
            ended = [materialised(reduce(DataFrame.unionByName, ended), "ended")]
        rows = materialised(_level(rows, min_support, z_limit), "level")
    rows = reduce(DataFrame.unionByName, ended)
    good = lambda c: F.sum(F.col("labelled") - F.col("bad")).alias(c)
    overall = rows.agg(F.sum("labelled").alias("l"), good("g")).first()
    base = overall.g / overall.l if overall.l else 1.0
    own = rows.groupBy("host", "prefix").agg(F.sum("labelled").alias("l"), good("g"))
    hosts = own.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("g").alias("hg"))
    host_purity = (F.col("hg") + smoothing * base) / (F.col("hl") + smoothing)
    purity = (F.col("g") + smoothing * host_purity) / (F.col("l") + smoothing)
    judged = own.join(hosts, "host").select("host", "prefix", purity.alias("purity"))
    return rows.join(judged, ["host", "prefix"]).select(
        "host", "path", F.concat(F.col("host"), F.col("prefix")).alias("template"), "purity", (F.col("purity") < min_purity).alias("rejected")
    )


def filtered_urls(pages: DataFrame, labels: DataFrame, rules: list[Rule], **settings) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity for every row of ``pages`` (page_id, url).

    ``labels`` (page_id, bad) marks some pages; of several labels of a page the worst counts. Null ids join no label.
    Repeated rows are judged alike; an empty table gives an empty table.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    worst = labels.where("page_id is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    found = templates(rows.join(worst, "page_id", "left"), **settings)
    name, verdict = first_rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(found, ["host", "path"], "left")
    method = F.when(F.col("rejected"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", "purity")
