"""Prefix trie of conversations by ROLLUP over columns of turns.

Turns become positions and identifiers first; texts do not move. A conversation is then one row per block of ``WIDTH``
turns: the node in which its earlier turns end, and one column per turn. ``GROUP BY block, before, ROLLUP (t1, ..., t8)``
aggregates all prefixes of a block together, and ``grouping_id`` tells their length. The node before a block is named by
the exclusive-or of the position-bound identifiers of all turns before it, which partial aggregates can combine; a long
conversation needs no loop over its blocks and no task that holds it whole.

What concerns whole subtrees follows from sums over members. The smallest member ``r`` of a node stands for it, and the
nodes that a conversation stands for are the last ones of its path, from some first depth on. So each distinct node is
counted once, by the conversation that stands for it:

* all tokens of members below a node: the members' totals less what lies before the node;
* tokens of the distinct nodes below it: what lies below on the path of ``r``, and for each other member the part of its
  path that it stands for;
* saved tokens are the difference; leaves are members that stand for a childless end; children are members whose own
  part begins one turn deeper, and the next turn of ``r``.

A first rollup finds the standing conversations, a second one sums over members. A prefix that a third of all
conversations share is merged before the shuffle. Ids of ends are joined to pieces within their order and
hashed as a stream, so no list of members is ever whole in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.operators.blocks import BLOCK, MAX_SERIES_ROWS, TIE, block_count, in_blocks, long_series, split_long
from daypanel.sources.scratch import materialised

#: Turns of a block, and blocks that share one partial prefix.
WIDTH, STRIDE = 8, 1024
#: Members of a piece of an end list.
PIECE = 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
TURN = "struct<a:bigint,b:bigint,chars:bigint>"


def _numbered(turns: DataFrame, max_rows: int) -> DataFrame:
    """Turns with their place ``pos`` from 1 on; conversations too long for one task are cut into ordered blocks."""
    order = ["turn", "a", "b"]
    of_conversation = Window.partitionBy("conv_id")
    long = long_series(turns, "conv_id", max_rows)
    if long is None:
        return turns.withColumn("pos", F.row_number().over(of_conversation.orderBy(*order)).cast("long"))
    usual, rest = split_long(turns, "conv_id", long)
    rows = in_blocks(rest, ["conv_id", *order], block_count(long, max_rows))
    sizes = rows.groupBy("conv_id", BLOCK).count()
    earlier = of_conversation.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv_id", BLOCK, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("conv_id", BLOCK).orderBy(*order, TIE))
    rows = rows.withColumn("_place", place).join(sizes, ["conv_id", BLOCK]).withColumn("pos", F.col("_place") + F.col("_before"))
    return usual.withColumn("pos", F.row_number().over(of_conversation.orderBy(*order)).cast("long")).unionByName(
        rows.select(*usual.columns, "pos")
    )


def rebuilt(conversations: DataFrame, inherit: int = 6, family: int = 100, max_rows: int = MAX_SERIES_ROWS) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, a, b, chars) of the rebuilt conversations, and (conv_id, n_turns) of all, turnless ones included.

    ``a`` and ``b`` name role, text and place. Conversation c begins with the first crc32(c) % ``inherit`` turns of c - c %
    ``family`` and goes on with its own from there.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.char_length(text).cast("long").alias("chars"),
    )
    turns = materialised(_numbered(turns, max_rows).drop("turn"), "turns")
    heads = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    heads = heads.select("conv_id", "own", base, (F.crc32(F.col("conv_id").cast("string")) % inherit).alias("h"))
    lengths = heads.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    heads = heads.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
    heads = materialised(heads.drop("base_own"), "heads")
    # a base gives at most a few turns to at most 2 * family conversations
    first = turns.where(F.col("pos") < inherit).select(F.col("conv_id").alias("base"), "pos", "a", "b", "chars")
    inherited = heads.where("taken > 0").join(first, "base").where("pos <= taken").select("conv_id", "pos", "a", "b", "chars")
    own = turns.join(heads.select("conv_id", "h", "taken"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "chars")
    bound = [F.xxhash64(F.lit(seed), "pos", "a", "b").alias(c) for seed, c in ((3, "a"), (4, "b"))]
    placed = inherited.unionByName(own).select("conv_id", "pos", *bound, "chars")
    lengths = heads.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    return placed, lengths


def _xor(total: Column, other: Column) -> Column:
    return total.bitwiseXOR(other)


def in_columns(turns: DataFrame, lengths: DataFrame, width: int = WIDTH, stride: int = STRIDE) -> DataFrame:
    """One row per conversation and block: conv_id, block, before, t1, ..., n_turns and total.

    ``before`` is the node in which the earlier turns end. Prefixes are combined per run of ``stride`` blocks, then within
    each run, so a conversation of any length is spread over tasks.
    """
    block = F.floor((F.col("pos") - 1) / width).cast("long")
    place = (F.col("pos") - 1) % width
    columns = [F.max(F.when(place == k, F.struct("a", "b", "chars"))).cast(TURN).alias(f"t{k + 1}") for k in range(width)]
    sums = [F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.sum("chars").alias("chars")]
    rows = turns.groupBy("conv_id", block.alias("block")).agg(*columns, *sums)
    rows = rows.withColumn("run", F.floor(F.col("block") / stride).cast("long"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)

    def prefix(frame):
        return [F.coalesce(f(c).over(frame), F.lit(0)) for f, c in ((F.bit_xor, "xa"), (F.bit_xor, "xb"), (F.sum, "chars"))]

    runs = rows.groupBy("conv_id", "run").agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"), F.sum("chars").alias("chars"))
    runs = runs.select("conv_id", "run", *[p.alias(n) for p, n in zip(prefix(earlier(Window.partitionBy("conv_id").orderBy("run"))), ("ra", "rb", "rc"))])
    totals = turns.groupBy("conv_id").agg(F.sum("chars").alias("total"))
    inner = prefix(earlier(Window.partitionBy("conv_id", "run").orderBy("block")))
    rows = rows.select("*", *[p.alias(n) for p, n in zip(inner, ("pa", "pb", "pc"))]).join(runs, ["conv_id", "run"])
    before = F.struct(_xor(F.col("ra"), F.col("pa")).alias("a"), _xor(F.col("rb"), F.col("pb")).alias("b"), (F.col("rc") + F.col("pc")).alias("chars"))
    names = [f"t{k + 1}" for k in range(width)]
    rows = rows.select("conv_id", "block", before.alias("before"), *names)
    known = lengths.join(totals, "conv_id", "left").select("conv_id", "n_turns", F.coalesce("total", F.lit(0)).alias("total"))
    turnless = known.where("n_turns = 0").select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.struct(*[F.lit(0).cast("long").alias(c) for c in ("a", "b", "chars")]).alias("before"),
        *[F.lit(None).cast(TURN).alias(n) for n in names],
    )
    return rows.unionByName(turnless).join(known, "conv_id")


def _nodes(rows: DataFrame, width: int, sums: str = "") -> DataFrame:
    """One row per node: depth, key (a, b), the parent's key, tokens before and in its turn, members and given sums.

    A member whose turns end above a place has a null there; groups that end in such a null are no nodes. A later block
    repeats the node it starts from, which an earlier block has already.
    """
    turns = [f"t{k + 1}" for k in range(width)]
    found = rows.sparkSession.sql(
        f"""
        SELECT block, before, {", ".join(turns)}, {width} - bit_count(grouping_id()) AS level, count(*) AS n_convs,
          min(conv_id) AS conv_id {sums}
        FROM {{rows}} GROUP BY block, before, ROLLUP ({", ".join(turns)})
        """,
        rows=rows,
    )
    last = F.get(F.array(*turns), F.col("level") - 1)
    found = found.withColumn("last", last).where("(level = 0 and block = 0) or last is not null")

    def whole(part):
        return reduce(_xor, [F.coalesce(F.col(f"{t}.{part}"), F.lit(0)) for t in turns], F.col(f"before.{part}"))

    own = {part: F.coalesce(F.col(f"last.{part}"), F.lit(0)) for part in ("a", "b", "chars")}
    tokens = reduce(lambda x, t: x + F.coalesce(F.col(f"{t}.chars"), F.lit(0)), turns, F.col("before.chars"))
    kept = [c for c in found.columns if c not in {"block", "before", "last", *turns}]
    return found.select(
        (F.col("block") * width + F.col("level")).alias("depth"), whole("a").alias("a"), whole("b").alias("b"),
        _xor(whole("a"), own["a"]).alias("parent_a"), _xor(whole("b"), own["b"]).alias("parent_b"),
        (tokens - own["chars"]).alias("tokens_before"), own["chars"].alias("tokens"), *kept,
    )


def _per_level(width: int, value: str, lift: int) -> str:
    """SQL for the number of members whose value, seen from the block's start, is the node's level plus ``lift``."""
    counts = ", ".join(f"count_if({value} - block * {width} = {k + lift})" for k in range(width + 1))
    return f"array({counts})[{width} - bit_count(grouping_id())]"


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of comma-joined ids of each node; rows come in order."""
    node, ids = None, []

    def piece():
        return pa.RecordBatch.from_pylist([{"depth": node[0], "a": node[1], "b": node[2], "first": ids[0], "ids": ",".join(map(str, ids))}], _PIECES)

    out = []
    for batch in batches:
        for *key, conv_id in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if key != node or len(ids) == PIECE:
                if ids:
                    out.append(piece())
                node, ids = key, []
            ids.append(conv_id)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
            out = []
    if ids:
        yield piece()


_PIECES = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the ids of each node, piece after piece."""
    node, digest = None, None
    schema = pa.schema([*list(_PIECES)[:3], ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for depth, a, b, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)]):
            if (depth, a, b) == node:
                digest.update(("," + ids).encode())
            else:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, a, b), hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    if node:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*node, digest.hexdigest())))], schema)


def end_hashes(ends: DataFrame) -> DataFrame:
    """depth, a, b and ends_sha256 of the nodes in which conversations end; ``ends`` has (depth, a, b, conv_id)."""
    ranged = ends.repartitionByRange("depth", "a", "b", "conv_id").sortWithinPartitions("depth", "a", "b", "conv_id")
    pieces = ranged.mapInArrow(_joined_ids, "depth long, a long, b long, first long, ids string")
    dealt = pieces.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "first")
    return dealt.mapInArrow(_hashed_ids, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, width: int = WIDTH, stride: int = STRIDE, max_rows: int = MAX_SERIES_ROWS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (conv_id, turn, role, text; others are ignored).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 as in the module's text,
    and the node's key (a, b) and ``tokens``, the code points of its last text. Null roles and texts are empty. Null turns
    come first; turns of one number are ordered by a hash of role and text, equal ones count each. Rows with a null
    conv_id name no conversation and are left out. An empty table gives an empty table, without a root.
    """
    turns, lengths = rebuilt(conversations, max_rows=max_rows)
    turns, lengths = materialised(turns, "rebuilt"), materialised(lengths, "lengths")
    rows = materialised(in_columns(turns, lengths, width, stride), "turn-columns")
    first_nodes = materialised(_nodes(rows, width, f", {_per_level(width, 'n_turns', 0)} AS n_ends"), "nodes")
    standing = first_nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "parent_a", "parent_b", "tokens_before")).alias("first"),
        F.max(F.struct("depth", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))).alias("last"),
    ).select("conv_id", F.col("first.depth").alias("from"), "first.parent_a", "first.parent_b", "first.tokens_before", F.col("last.leaf").alias("leaf"))
    above = first_nodes.select((F.col("depth") + 1).alias("from"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("above"))
    standing = standing.join(above, ["from", "parent_a", "parent_b"], "left").select("conv_id", "from", "tokens_before", "leaf", "above")
    standing = materialised(standing, "standing")
    known = rows.join(standing.select("conv_id", "from", "tokens_before", "leaf"), "conv_id", "left")
    own = F.coalesce(F.col("total") - F.col("tokens_before"), F.lit(0))
    known = known.withColumn("own", own).withColumn("leaf", F.coalesce("leaf", F.lit(0))).drop("tokens_before")
    sums = f", sum(total) AS totals, sum(own) AS owns, sum(leaf) AS n_leaves, {_per_level(width, '`from`', 1)} AS joining"
    nodes = _nodes(known, width, sums)
    ends = turns.groupBy("conv_id").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    ends = lengths.join(ends, "conv_id", "left").select(
        F.col("n_turns").alias("depth"), F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"), "conv_id"
    )
    hashes = end_hashes(materialised(ends, "ends"))
    totals = rows.where("block = 0").select("conv_id", "n_turns", "total")
    leaders = totals.join(standing, "conv_id").select(
        "conv_id", "n_turns", "total", F.col("from"), F.col("tokens_before").alias("lead_before"), "above"
    )
    found = nodes.join(leaders, "conv_id").join(hashes, ["depth", "a", "b"], "left")
    below = F.col("totals") - F.col("n_convs") * F.col("tokens_before")
    distinct = (F.col("total") - F.col("tokens_before")) + F.col("owns") - (F.col("total") - F.col("lead_before"))
    return found.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.when(F.col("from") == F.col("depth"), F.col("above")).otherwise(F.col("conv_id"))).alias("parent_conv_id"),
        "n_convs", (F.col("joining") + (F.col("n_turns") > F.col("depth")).cast("long")).alias("n_children"), "n_leaves",
        (below - distinct).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), "a", "b", "tokens",
    )
