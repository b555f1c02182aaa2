"""Temperature mixing of sources, realised as budgeted block permutations.

The weight of a source is its token share raised to an exponent and normalised. The exponent is searched on grids, many
candidates in one pass: from 1 (the natural mix) down to 0 (equal weights) it stops where the mix first reaches the
wanted entropy, and never passes the point where a source would be repeated more often than allowed.

A source is cut into blocks of documents by hash. Every epoch is a fresh permutation of each block. Whole epochs take
all documents of a block; the last one takes documents in permuted order while the block's share of the token budget
lasts. Blocks are bounded, so no window or task ever holds a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.words import blank_words
from daypanel.sources.scratch import materialised

#: Documents of a block, on average.
BLOCK_DOCS = 500
GRID = 64


def source_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, source, tokens, copies) per distinct row; a null source is a source of its own."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
                       F.col("source").cast("string"), F.size(blank_words(F.col("text").cast("string"))).cast("long").alias("tokens"))
    return rows.groupBy("doc_id", "text_hash", "source", "tokens").agg(F.count("*").alias("copies"))


def exponent(sources: DataFrame, target_entropy: float, max_repeats: float, budget_share: float, rounds: int = 4) -> float:
    """The exponent for ``sources`` (source, tokens): entropy as a share of its maximum, repeats as weight over share.

    Each round measures a grid of exponents over the table of sources and narrows to one step of it.
    """
    total = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not total.t or total.n < 2:
        return 1.0
    low, high, too_many = 0.0, 1.0, False
    for step in range(rounds):
        grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        p = F.col("tokens") / float(total.t)
        at = sources.select("tokens", F.explode(F.array(*[F.lit(a) for a in grid])).alias("a")).withColumn("u", F.pow(p, F.col("a")))
        measured = at.groupBy("a").agg(
            F.sum("u").alias("z"), F.sum(F.col("u") * F.log("u")).alias("ul"), F.max(F.col("u") / p).alias("r")
        ).orderBy(F.desc("a")).collect()
        above = None
        for r in measured:
            entropy = (math.log(r.z) - r.ul / r.z) / math.log(total.n)
            repeats = r.r / r.z * budget_share > max_repeats
            if entropy >= target_entropy or repeats:
                if above is None:
                    return r.a  # the natural mix is even enough, or can't be had without too many repeats
                low, high, too_many = r.a, above, repeats
                break
            above = r.a
        else:
            return low  # never reached: the flattest mix is nearest
    return high if too_many else low


def mixture(tokens: DataFrame, target_entropy: float, max_repeats: float, budget_share: float) -> DataFrame:
    """(source, tokens, docs, share, weight, epochs): how often the documents of a source are to be taken."""
    if budget_share > max_repeats:
        raise ValueError(
            f"a budget of {budget_share} times all tokens can't be met with {max_repeats} repeats of each source: "
            f"{budget_share - max_repeats} times all tokens are missing"
        )
    sources = materialised(tokens.where("tokens > 0").groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("docs")), "sources")
    a = exponent(sources, target_entropy, max_repeats, budget_share)
    total = sources.agg(F.sum("tokens").alias("t")).first().t or 1
    p = F.col("tokens") / float(total)
    powered = sources.withColumn("share", p).withColumn("u", F.pow(p, F.lit(a)))
    z = powered.agg(F.sum("u").alias("z")).first().z or 1.0
    weight = F.col("u") / F.lit(z)
    return powered.select("source", "tokens", "docs", "share", weight.alias("weight"), F.least(F.lit(max_repeats), weight / p * budget_share).alias("epochs"))


def mixed(
    docs: DataFrame, target_entropy: float = 0.9, max_repeats: float = 4.0, budget_share: float = 1.0, seed: int = 11
) -> DataFrame:
    """The drawn documents: doc_id, text_hash, source, tokens, copies, epoch, block and place in the block.

    ``target_entropy`` is a share of the largest entropy; ``budget_share`` is the token budget over all tokens there
    are. Documents without tokens are in no mix. Rows that repeat a document and source share their draws (``copies``).
    A tie in the permutation goes to the smaller id. An empty table gives an empty mix. A budget beyond ``max_repeats`` of
    everything is an error that names the shortfall.
    """
    tokens = materialised(source_tokens(docs), "tokens")
    weights = materialised(mixture(tokens, target_entropy, max_repeats, budget_share), "mixture")
    weights = weights.select(F.col("source").alias("of"), "docs", "epochs")
    rows = tokens.where("tokens > 0").join(weights, tokens.source.eqNullSafe(F.col("of")))
    blocks = F.ceil(F.col("docs") / BLOCK_DOCS)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), blocks))
    rows = rows.select("doc_id", "text_hash", "source", "tokens", "copies", "block", "epochs",
                       F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil("epochs")).cast("int"))).alias("epoch"))
    one = Window.partitionBy("source", "block", "epoch")
    order = one.orderBy(F.xxhash64("doc_id", "text_hash", "epoch", F.lit(seed + 1)), "doc_id", "text_hash")
    before = F.sum(F.col("tokens") * F.col("copies")).over(order) - F.col("tokens") * F.col("copies")
    rows = rows.withColumns({"before": before, "place": F.row_number().over(order), "all": F.sum(F.col("tokens") * F.col("copies")).over(one)})
    left = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("epochs") - F.col("epoch") + 1)) * F.col("all")
    # the document at the edge is taken if at least half of it fits
    taken = F.col("before") + F.col("tokens") * F.col("copies") / 2 <= left
    return rows.where(taken).select("doc_id", "text_hash", "source", "tokens", "copies", "epoch", "block", "place")


def drawn_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as they are drawn, columns unchanged."""
    drawn = mixed(docs, **settings).groupBy("doc_id", "text_hash", "source").agg(F.count("*").cast("int").alias("__times"))
    drawn = drawn.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash", "source": "__source"})
    here = docs.withColumn("__text_hash", F.xxhash64(F.col("text").cast("string")))
    same = here.doc_id.eqNullSafe(drawn["__id"]) & (here["__text_hash"] == drawn["__hash"]) & here.source.eqNullSafe(drawn["__source"])
    joined = here.join(drawn, same)
    return joined.withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
