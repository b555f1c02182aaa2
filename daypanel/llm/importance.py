"""Quality selection by importance resampling.

Two generative models over hashed word unigrams and bigrams are counted: one from target texts (a documented, bounded
sample of labelled rows), one from all raw texts. The log importance weight of a document is the sum over its n-grams
of log p_target - log p_raw, where a ratio counts only by what exceeds its standard error at a one-sided level of 5 %: thousands
of rare n-grams that say nothing then don't drown the few that do. Documents are drawn without replacement by Gumbel top-k: weight plus Gumbel noise, the k
largest win. Noise comes from a hash of the id, so a lost task draws the same again. The k-th largest key is found by
counting in ever finer ranges of keys; no rows are sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm import wordhash
from daypanel.llm.wordhash import U
from daypanel.sources.scratch import materialised

UNIGRAMS, BIGRAMS = 1 << 17, 1 << 17
BUCKETS = UNIGRAMS + BIGRAMS
MAX_TARGET = 20_000


def _buckets(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, and of all pairs of neighbours (one fewer)."""
    pairs = wordhash.mix(words[:-1] * U(0xC2B2AE3D27D4EB4F) + words[1:])
    return (words >> U(47)).astype(np.int64), (pairs >> U(47)).astype(np.int64) + UNIGRAMS


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        target = np.asarray(batch.column(1).to_pylist(), bool)
        for first, words, bounds in wordhash.documents_in_blocks(batch.column(0), lower=True):
            ones, twos = _buckets(words)
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) + first
            inside = row[1:] == row[:-1]
            counts[0] += np.bincount(ones, minlength=BUCKETS) + np.bincount(twos[inside], minlength=BUCKETS)
            good = target[row]
            counts[1] += np.bincount(ones[good], minlength=BUCKETS) + np.bincount(twos[inside & good[1:]], minlength=BUCKETS)
    at = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[0][at]), pa.array(counts[1][at])], ["bucket", "raw", "target"])


def shrunk_ratios(target: np.ndarray, raw: np.ndarray, errors: float = 1.645) -> np.ndarray:
    """log p_target - log p_raw of each bucket, drawn towards 0 by ``errors`` of its standard errors."""
    # raw counts on the scale of the target's; half a count more on both sides
    expected = raw * (target.sum() / max(raw.sum(), 1)) + 0.5
    ratio = np.log((target + 0.5) / expected)
    return np.sign(ratio) * np.maximum(0, np.abs(ratio) - errors * np.sqrt(1 / (target + 0.5) + 1 / expected))


def log_ratios(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """:func:`shrunk_ratios` of words and of pairs. ``target_ids`` (doc_id) has at most ``MAX_TARGET`` distinct rows."""
    marked = docs.select("doc_id", "text").join(F.broadcast(target_ids.select("doc_id", F.lit(True).alias("target"))), "doc_id", "left")
    rows = marked.select("text", F.coalesce("target", F.lit(False)).alias("target")).mapInArrow(_counter, "bucket int, raw long, target long")
    found = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[found.bucket], target[found.bucket] = found.raw, found.target
    ratio = np.zeros(BUCKETS)
    for part in (slice(0, UNIGRAMS), slice(UNIGRAMS, BUCKETS)):
        ratio[part] = shrunk_ratios(target[part], raw[part])
    return ratio.astype(np.float32) if target.sum() else np.zeros(BUCKETS, np.float32)


def weighted(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id and log_weight of every row; 0 without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros(batch.num_rows)
            for first, words, bounds in wordhash.documents_in_blocks(batch.column(1), lower=True):
                ones, twos = _buckets(words)
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                each = ratios[ones].astype(np.float64)
                inside = row[1:] == row[:-1]
                each[1:] += np.where(inside, ratios[twos], 0)
                sums[first : first + len(bounds) - 1] = np.bincount(row, each, minlength=len(bounds) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums)], ["doc_id", "log_weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, log_weight double")


def gumbel_top_k(weights: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """``weights`` (doc_id, log_weight) with draw_key and kept: the k largest keys. Rows that tie at the end all stay.

    The key is turned into an integer in steps of one millionth. Its range is cut into 1024 parts, rows are counted
    per part, and the part with the k-th row is cut again, until it holds one value.
    """
    unit = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noisy = weights.withColumn("draw_key", F.col("log_weight") - F.log(-F.log(unit)))
    noisy = materialised(noisy.withColumn("__step", F.floor(F.col("draw_key") * 1_000_000).cast("long")), "draws")
    span = noisy.agg(F.min("__step").alias("low"), F.max("__step").alias("high"), F.count("*").alias("n")).first()
    if k <= 0 or not span.n:
        return noisy.withColumn("kept", F.lit(False)).drop("__step")
    low, high, left = span.low, span.high + 1, k
    while k < span.n and high - low > 1:
        width = max(1, -(-(high - low) // 1024))
        parts = noisy.where((F.col("__step") >= low) & (F.col("__step") < high)).groupBy(((F.col("__step") - low) / width).cast("long").alias("part")).count()
        for r in sorted(parts.collect(), key=lambda r: -r.part):
            if left <= r["count"]:
                low, high = low + r.part * width, min(high, low + (r.part + 1) * width)
                break
            left -= r["count"]
    return noisy.withColumn("kept", F.col("__step") >= low).drop("__step")


def resampled(docs: DataFrame, labels: DataFrame, max_target: int = MAX_TARGET, seed: int = 1) -> DataFrame:
    """doc_id, log_weight, draw_key and kept for every row of ``docs`` (doc_id, text).

    Target texts are documents labelled quality 1 and not toxic; of their ids at most about ``max_target`` are used,
    chosen by hash. The share of labels that are target sets the share of documents drawn. Rows of one doc_id and text
    share a draw. A null doc_id draws like any other id. Without usable labels all weights are 0 and all rows stay.
    """
    judged = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).alias("good"))
    judged = judged.where("good is not null")
    seen = judged.agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good")).first()
    share = (seen.good or 0) / seen.n if seen.n and seen.good else 1.0
    part = F.pmod(F.xxhash64("doc_id", F.lit("target")), F.lit(1_000_000)) / 1_000_000 < max_target / max(seen.good or 0, 1)
    ratios = log_ratios(docs, judged.where("good").where(part).select("doc_id"))
    weights = materialised(weighted(docs, ratios), "weights")
    return gumbel_top_k(weights, round(share * weights.count()), seed)
