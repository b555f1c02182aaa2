"""Exact duplicates by content-defined chunk recipes, in native functions only.

A text is cut where its own content says so: at the first line or sentence end after ``LEAST`` characters, at ``MOST`` at
the latest. Cuts follow from nearby characters, so equal passages are cut alike wherever they stand. The work then has
two parts:

* **Chunks to verified identifiers.** Equal chunks are merged before anything moves, so what moves is each distinct
  chunk, whatever the number or the length of the documents that hold it. A chunk's name is a 64-bit hash. Names of two
  or more different chunks are found by comparing contents; such a chunk is told apart by its rank among those of its
  name.
* **Recipes.** A document is from then on its ordered list of identifiers: the names, and the ranks of chunks whose name
  is shared. Equal lists are equal texts. Only lists move: they are merged per id, counted per list, and the row to
  keep is joined back.

A list held by a third of all rows is merged before the shuffle and joined to a single row, so its partition can be split.
Nothing is collected, broadcast by hint or held whole in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.sources.scratch import materialised

LEAST, MOST = 256, 4096
#: Where a chunk may end: after a line feed, or after the end of a sentence and a blank if there is one.
ENDS = r"(?:\n|[.!?。！？]\s?)"


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text as an array of chunks that join to it again; an empty text has none."""
    pattern = f"(?s).{{{least},{most}}}?{ENDS}|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def name_of(chunk: Column, names: int | None = None) -> Column:
    """A chunk's name; a number of names makes different chunks share them, as tests do."""
    name = F.xxhash64(chunk)
    return name if names is None else F.pmod(name, F.lit(names))


def shared_names(texts: DataFrame, names: int | None = None, **cut: int) -> DataFrame | None:
    """(name, chunk, rank) of different chunks that share a name, ranked by content; None if all names are unique.

    Among a million million chunks about thirty thousand pairs of names are expected to clash, so contents are read a
    second time for these names alone.
    """
    chunks = texts.select(F.explode(chunks_of(F.col("text"), **cut)).alias("chunk"))
    named = chunks.select(name_of(F.col("chunk"), names).alias("name"), "chunk")
    clashing = named.distinct().groupBy("name").agg(F.count("*").alias("different")).where("different > 1")
    clashing = materialised(clashing.select("name"), "shared-names")
    if clashing.isEmpty():
        return None
    contents = named.join(clashing, "name", "left_semi").distinct()
    rank = F.row_number().over(Window.partitionBy("name").orderBy("chunk"))
    return materialised(contents.withColumn("rank", rank), "shared-chunks")


def recipes(texts: DataFrame, names: int | None = None, **cut: int) -> DataFrame:
    """doc_id, n_bytes, text_sha256, names and ranks of every row of ``texts`` (doc_id, text without nulls)."""
    chunks = chunks_of(F.col("text"), **cut)
    lists = texts.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"),
        F.transform(chunks, lambda chunk: name_of(chunk, names)).alias("names"),
    )
    shared = shared_names(texts, names, **cut)
    no_ranks = F.array().cast("array<int>")
    if shared is None:
        return lists.withColumn("ranks", no_ranks)
    placed = texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.posexplode(chunks).alias("pos", "chunk"))
    placed = placed.withColumn("name", name_of(F.col("chunk"), names)).join(shared, ["name", "chunk"])
    # rows of one id and one text have the same ranks at the same places
    ranks = placed.groupBy("doc_id", "text_sha256").agg(F.array_sort(F.collect_set(F.struct("pos", "rank"))).alias("at"))
    ranks = ranks.select(F.col("doc_id").alias("of"), F.col("text_sha256").alias("sha"), F.col("at.rank").alias("ranks"))
    joined = lists.join(ranks, lists.doc_id.eqNullSafe(ranks.of) & (lists.text_sha256 == ranks.sha), "left")
    return joined.select(*lists.columns, F.coalesce("ranks", no_ranks).alias("ranks"))


def exact_duplicates(docs: DataFrame, names: int | None = None, **cut: int) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and n_chunks of every row of ``docs`` (doc_id, text; others are ignored).

    Texts are equal when all their bytes are; a null text counts as empty, and empty texts are equal. The row of the
    largest doc_id stays; of rows that repeat that id, exactly one. Null ids are smaller than all others: they give a row
    each, and one of them stays only if its group has no other id (keep_id is then null). An empty table gives an empty
    table.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    listed = recipes(texts, names, **cut).withColumn("list", F.xxhash64("names", "ranks"))
    same = ["list", "n_bytes", "names", "ranks"]  # the list's hash only sorts fast; the lists themselves are compared
    rows = listed.groupBy(*same, "text_sha256", "doc_id").agg(F.count("*").alias("copies"))
    rows = materialised(rows, "recipes")
    groups = rows.groupBy(*same).agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    joined = rows.join(groups, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return joined.select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", F.size("names").cast("long").alias("n_chunks")
    )
