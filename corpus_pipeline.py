"""Preparation of a training corpus: language, near duplicates, benchmark passages, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the docs of the
next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.llm import decontamination, language_id, mixing, packing, set_join
from daypanel.sources.scratch import materialised

#: A language is rejected below this calibrated probability: no better than a guess between many.
LEAST_SCORE = 0.3
#: Share of the union of five-word shingles, in percent, from which documents are near duplicates. op9 has its own.
SIMILAR = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language can't be told, go; ``lang`` stays as it was."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.fit(docs.where(~held))
    judged = language_id.predict(docs, model)
    known = F.lit(True) if model is None else (F.col("score") >= LEAST_SCORE)
    return judged.where((F.col("lang_pred") != "und") & known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one of the smallest id."""
    return set_join.first_of_each_group(docs, percent=SIMILAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in windows of benchmark items go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources draws them."""
    return mixing.drawn_documents(docs, target_entropy=0.95, max_repeats=4.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2,048."""
    return packing.packed_sequences(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("pack", pack),
]

#: Learned languages and permutations by hash have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return docs
