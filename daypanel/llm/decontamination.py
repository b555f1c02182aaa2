"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is 13 consecutive words of a benchmark item, or the whole item if it is shorter. Its shingles are runs of five
words (of all its words if it has fewer).

1. Each position of each document looks for its shingle among those of the benchmark.
2. The shingles are ordered by how often the documents show them. A window that occurs shows all of its shingles, so one
   of them is prefix enough: the rarest.
3. A document position that shows a window's prefix shingle is a candidate start, moved left by the shingle's place in
   the window. Starts before the text or too close to its end fall to the positional and length bounds.
4. The candidates go back to the texts, where the words of the window are compared one by one.

The benchmark's shingles are broadcast while there are at most ``MAX_BROADCAST`` of them; beyond that the join is
shuffled. Rows travel as hashes and positions; texts move once, to meet their candidates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.words import letter_words, shingle_hashes
from daypanel.sources.scratch import materialised

WINDOW = 13
SHINGLE = 5
#: Distinct shingles (16 bytes each) that may be broadcast.
MAX_BROADCAST = 500_000


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows: words, their number and the sorted ids (as text) of the items that have them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), letter_words(F.col("text").cast("string")).alias("words"))
    items = items.where("item_id is not null").where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    cut = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s + 1, size))).alias("window"))
    return cut.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items")).withColumn("length", F.size("window"))


def window_shingles(found: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(window, width, place, shingle): every shingle of every window; width is k, or the length of a shorter window."""
    widths = []
    for width in range(1, k + 1):
        own = found.where(F.col("length") >= k if width == k else F.col("length") == width)
        places = own.select("window", "items", F.lit(width).alias("width"), F.posexplode(shingle_hashes("window", width)).alias("place", "shingle"))
        widths.append(places.where("shingle is not null"))
    return reduce(DataFrame.unionByName, widths)


def shown(docs: DataFrame, wanted: DataFrame, widths: list[int]) -> DataFrame:
    """(doc_id, text_hash, n_words, width, shingle, position) where a document shows a wanted shingle (width, shingle)."""
    out = []
    for width in widths:
        own = wanted.where(F.col("width") == width).select("shingle")
        own = F.broadcast(own) if own.count() <= MAX_BROADCAST else own
        at = docs.select("doc_id", "text_hash", "n_words", F.posexplode(shingle_hashes("words", width)).alias("position", "shingle"))
        out.append(at.join(own, "shingle").withColumn("width", F.lit(width)))
    return reduce(DataFrame.unionByName, out)


def _merged_length(spans: Column) -> Column:
    """Number of positions in the union of half-open spans {start, stop}."""
    ordered = F.array_sort(spans)
    total = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("reach"), F.lit(0).alias("hit")),
        lambda s, x: F.struct(
            F.greatest(s.reach, x.stop).alias("reach"),
            (s.hit + F.greatest(F.lit(0), x.stop - F.greatest(s.reach, x.start))).alias("hit"),
        ),
    )
    return total.hit


def candidates(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """Per document (doc_id, text_hash) the candidate starts: an array of {start, window, items}; None without windows."""
    shingled = materialised(window_shingles(windows(benchmark)), "windows")
    widths = sorted(r.width for r in shingled.select("width").distinct().collect())  # at most five
    if not widths:
        return None
    wanted = shingled.select("width", "shingle").distinct()
    # counted before the words are spread, so that no spread row carries them
    hits = materialised(shown(docs.withColumn("n_words", F.size("words")), wanted, widths), "shown")
    rarity = hits.groupBy("width", "shingle").agg(F.count("*").alias("shows"))
    # a window with a shingle that no document shows occurs nowhere
    ranked = shingled.join(rarity, ["width", "shingle"], "left").groupBy("window").agg(
        F.first("items").alias("items"),
        F.min(F.struct(F.coalesce("shows", F.lit(0)).alias("shows"), "place", "width", "shingle")).alias("rarest"),
    ).where("rarest.shows > 0")
    prefix = ranked.select("window", "items", F.size("window").alias("length"), "rarest.place", "rarest.width", "rarest.shingle")
    starts = hits.join(prefix, ["width", "shingle"]).withColumn("start", F.col("position") - F.col("place"))
    inside = starts.where("start >= 0 and start + length <= n_words")
    return inside.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "window", "items")).alias("starts"))


def _judged(docs: DataFrame, benchmark: DataFrame, percent: int) -> DataFrame:
    """What ``contamination`` returns, and the text's hash."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    worded = texts.select("doc_id", "text_hash", letter_words(F.col("text")).alias("words"))
    found = candidates(worded, benchmark)
    if found is None:
        joined = texts.withColumn("starts", F.array().cast("array<struct<start:int,window:array<string>,items:array<string>>>"))
    else:
        found = found.withColumnsRenamed({"doc_id": "c_id", "text_hash": "c_hash"})
        joined = texts.join(found, texts.doc_id.eqNullSafe(found.c_id) & (texts.text_hash == found.c_hash), "left")
    judged = joined.select("doc_id", "text_hash", "starts", letter_words(F.col("text")).alias("words"))
    same = F.filter("starts", lambda c: F.slice("words", c.start + 1, F.size(c.window)) == c.window)
    judged = judged.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.coalesce(same, F.array()).alias("hits"))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda c: c["items"]))))
    spans = F.transform("hits", lambda c: F.struct(c.start.alias("start"), (c.start + F.size(c.window)).alias("stop")))
    judged = judged.select("doc_id", "text_hash", "n_words", items.alias("items"), _merged_length(spans).cast("long").alias("n_hit"))
    return judged.select(
        "doc_id", "text_hash", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)).alias("contaminated"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs`` (doc_id, text).

    A null text has no words, is hit by nothing and is clean. Items with a null id or without words are no windows.
    Repeated rows are judged alike, a null doc_id included. Without benchmark rows everything is clean.
    """
    return _judged(docs, benchmark, percent).drop("text_hash")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged. Other texts of a contaminated row's id stay."""
    bad = _judged(docs, benchmark, 5).where("contaminated").select(F.col("doc_id").alias("__bad"), F.col("text_hash").alias("__hash")).distinct()
    same = docs.doc_id.cast("long").eqNullSafe(F.col("__bad")) & (F.xxhash64(docs.text.cast("string")) == F.col("__hash"))
    return docs.join(bad, same, "left_anti")
