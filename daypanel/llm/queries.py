"""Registered queries of this subpackage: each operator over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.llm import (
    archives, chunk_recipes, decontamination, importance, language_id, mixing, packing, path_templates, repeats, rule_votes,
    set_join, token_alignment, turn_trie,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the URL filter, longest fit first.
URL_RULES = [
    path_templates.Rule("org/", True),
    path_templates.Rule("example.org/es/", False),
    path_templates.Rule("example.org/en/1", False),
    path_templates.Rule("com/fr/", True),
    path_templates.Rule("com/de/", False),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in strings of 400 bytes found at another place too."""
    found = repeats.without_repeats(_table(spark, sf_dir, "documents"))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")]
    return found.select(*columns, (F.col("n_removed") > 0).alias("has_repeats"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back in the order of their capture histories."""
    merged = archives.archived(_table(spark, sf_dir, "pages"), least_bytes=0)
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page: the longest rule's, else that of the path-template tree.

    A page is labelled by the label of its id: bad if its quality is 0 or it is toxic.
    """
    bad = (F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    found = path_templates.filtered_urls(_table(spark, sf_dir, "pages"), labels, URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9).alias("purity"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed sequences of 2,048 tokens."""
    return packing.packed_sequences(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.fit(docs.where(~held))
    judged = language_id.predict(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw of every document by its importance for the labelled good ones."""
    return importance.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn for a mix of sources at 95 % of the largest entropy and at most four repeats."""
    drawn = mixing.mixed(_table(spark, sf_dir, "documents"), target_entropy=0.95, max_repeats=4.0)
    return drawn.select("doc_id", "source", "tokens", "copies", "epoch", "block", "place")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: five-word shingles, 85 % of the union shared."""
    return set_join.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op10_rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the weakly supervised verdict of every document."""
    judged = rule_votes.judged(_table(spark, sf_dir, "documents"))
    return judged.withColumn("posterior", F.round("posterior", 9))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document."""
    return token_alignment.alignment(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    found = turn_trie.prefix_trie(_table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents; of equal texts, the row of the largest id stays."""
    found = chunk_recipes.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_repeats, op2_warc, op3_url_filter, op4_packing, op5_decontamination, op6_language_id, op7_importance, op8_mixing,
        op9_near_duplicates, op10_rule_votes, op11_alignment, op12_prefix_trie, op13_exact_duplicates,
    )
}
