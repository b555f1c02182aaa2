"""Near-duplicate classes by a chosen-path set similarity join.

Documents are sets of word shingles. Equal sets form a class, and one row stands for each class. A class carries a
sketch of minwise tokens. In each of several independent trees a node draws a few sketch coordinates and sends every
class to a child named by the value it has there, so that similar sets meet again and again and others part soon.

* A small node is closed: its classes are compared in pairs by size and sketch.
* A large node in which many classes look like the smallest one (the pivot) is dense; branching would not thin it, so it
  is closed, too. So is what is still large after ``LEVELS`` levels.
* Any other node branches again.

A large node that is closed compares the sketches of its classes within tasks: it is cut into blocks by hash, every pair of
blocks is a task, and a task returns a spanning forest of the pairs that may reach the threshold. Only such pairs make
coarse groups; to share a node, as all documents with a common passage do, is not enough. Links are then found
inside the groups on full sets, again by blocks and forests. A group of n copies gives n rows and not n*n, and no link between
components is lost.

A pair of similarity s agrees in m of ``TOKENS`` coordinates, m being binomial. One tree misses it with probability ``q``
where ``q = (1 - p + p*q)**DRAWS`` and ``p = m / TOKENS``; the number of trees follows from the mean over m, with pairs below the
sketch limit counted as missed.

Everything is keyed by class, so exact copies cost one row each. No row leaves a join or an aggregate for the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm import wordhash
from daypanel.llm.wordhash import U
from daypanel.sources.scratch import materialised

TOKENS = 32
DRAWS = 3
#: Largest node that compares all its classes.
SMALL = 5
LEVELS = 3
#: A large node is dense if this share of its classes may be similar to the pivot.
DENSE = 0.25
#: Tokens of a block: two blocks have to fit into a task.
BLOCK_TOKENS = 1_500_000
#: Classes of a block: short texts meet in many classes of few tokens, and a task holds a matrix of classes.
BLOCK_CLASSES = 2_000
#: Sketches of a block.
BLOCK_SKETCHES = 4_096
#: Columns of the token matrix that are multiplied at once.
COLUMNS = 2048
SKETCH_SCHEMA = "doc_id long, n_shingles long, class_key long, sketch array<int>"


def missed(similarity: float, trees: int, draws: int = DRAWS, tokens: int = TOKENS) -> float:
    """Probability that a pair of this similarity meets in no tree or fails the sketch limit of the same threshold."""
    total, least = 0.0, least_matches(similarity)
    for m in range(tokens + 1):
        chance = math.comb(tokens, m) * similarity**m * (1 - similarity) ** (tokens - m)
        q = 0.0
        for _ in range(200):
            q = (1 - m / tokens + m / tokens * q) ** draws
        total += chance * (q**trees if m >= least else 1.0)
    return total


def trees_for(similarity: float, recall: float) -> int:
    """Trees needed so that a pair at the threshold is found with the wanted probability."""
    trees = 1
    while missed(similarity, trees) > 1 - recall:
        trees += 1
        if trees > 1000:
            raise ValueError(f"no number of trees reaches a recall of {recall} with {TOKENS} tokens")
    return trees


def least_matches(similarity: float) -> int:
    """Tokens that have to agree before full sets are read: five deviations below the mean at the threshold."""
    return max(1, math.floor(TOKENS * similarity - 5 * math.sqrt(TOKENS * similarity * (1 - similarity))))


def _set_of(words: np.ndarray, k: int) -> np.ndarray:
    found = wordhash.shingles(words, k)
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def _key_of(found: np.ndarray) -> int:
    """A name for a set of hashes, independent of order."""
    with np.errstate(over="ignore"):
        total = wordhash.mix(found + U(0x5851F42D4C957F2D)).sum(dtype=U) + U(len(found))
    return int(np.asarray(wordhash.mix(np.asarray([total], U))).view(np.int64)[0])


def _sketcher(k: int):
    multipliers = wordhash.mix(np.arange(1, TOKENS + 1, dtype=U)) | U(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, keys, sketches = batch.column(0), [], [], []
            for _, words, bounds in wordhash.documents_in_blocks(batch.column(1), lower=True):
                sets = [_set_of(words[a:b], k) for a, b in zip(bounds[:-1], bounds[1:])]
                full = [s for s in sets if len(s)]
                if full:
                    joined, at = np.concatenate(full), np.cumsum([0, *map(len, full)])[:-1]
                    tokens = np.stack([np.minimum.reduceat(joined * m, at) >> U(32) for m in multipliers], 1)
                    tokens = iter(tokens.astype(np.uint32).view(np.int32))
                for s in sets:
                    sizes.append(len(s))
                    keys.append(_key_of(s) if len(s) else None)
                    sketches.append(next(tokens) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(sketches, pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "class_key", "sketch"],
            )

    return run


def sketched(docs: DataFrame, k: int = 5) -> DataFrame:
    """One row per document: set size, class and minwise tokens; class and tokens are null without words."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sketcher(k), SKETCH_SCHEMA)


def _set_builder(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, keys, sets = batch.column(2).to_pylist(), [], []
            for first, words, bounds in wordhash.documents_in_blocks(batch.column(1), lower=True):
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    found = _set_of(words[a:b], k)
                    if len(found) and _key_of(found) == wanted[first + i]:
                        keys.append(wanted[first + i])
                        sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "tokens"])

    return run


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Full sets of the classes in ``wanted`` (key, doc_id), as sorted 64-bit hashes."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # both sides move at every size: a join that is a broadcast on small inputs only would hide what it costs on large ones
    found = texts.join(wanted.hint("merge"), "doc_id")
    return found.select("doc_id", "text", "key").mapInArrow(_set_builder(k), "key long, tokens binary")


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets reach the threshold, as a square matrix; shared tokens are counted by matrix products."""
    n = len(sets)
    sizes = np.asarray([len(s) for s in sets], np.float64)
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes.astype(np.int64))
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    fresh = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    number = np.cumsum(fresh) - 1
    common = np.bincount(number)[number] > 1  # a token of one set is shared with none
    number, owner = number[common], owner[common]
    number = np.unique(number, return_inverse=True)[1]
    shared = np.zeros((n, n), np.float32)
    for low in range(0, int(number.max()) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(number, [low, low + COLUMNS])
        block = np.zeros((n, COLUMNS), np.float32)
        block[owner[a:b], number[a:b] - low] = 1
        shared += block @ block.T
    linked = np.empty((n, n), bool)
    for row in range(n):  # whole numbers beyond the precision of the products' type
        same = shared[row].astype(np.float64)
        linked[row] = 100 * same >= percent * (sizes[row] + sizes - same)
    return linked


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a link matrix, as (root, member) pairs."""
    left, out = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while len(front):
            reached = np.flatnonzero(linked[front].any(0) & left)
            left[reached] = False
            out += [(root, int(x)) for x in reached]
            front = reached
    return out


def _comparer(percent: int):
    def links(keys: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        found = _forest(_linked(sets, percent)) if len(keys) > 1 else []
        pairs = [pa.array([keys[x[i]] for x in found], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(pairs, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members = None, {}
        for batch in batches:
            for task, key, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if task != group:
                    if members:
                        yield links(list(members), list(members.values()))
                    group, members = task, {}
                members[key] = np.frombuffer(tokens.as_buffer(), U)
        if members:
            yield links(list(members), list(members.values()))

    return run


def _block_pairs(rows: DataFrame, group: str, blocks: Column, *columns: str) -> DataFrame:
    """Rows dealt to tasks: a group of ``blocks`` blocks gives a task for each pair of them, named ``task``."""
    sizes = rows.groupBy(group).agg(blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("key"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = rows.join(sizes, group).select("key", group, *columns, block.alias("own"), other)
    pair = F.struct(group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return dealt.select(F.xxhash64(pair).alias("task"), "key", *columns)


def links_within(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that span the components of each coarse group. ``groups`` has (key, label, n)."""
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK_TOKENS), F.ceil(F.count("*") / BLOCK_CLASSES))
    tasks = _block_pairs(groups, "label", blocks).join(sets, "key").select("task", "key", "tokens")
    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_comparer(percent), "a long, b long")


def _sketch_comparer(percent: int):
    least = least_matches(percent / 100)

    def links(keys: list[int], sizes: list[int], sketches: list[np.ndarray]) -> pa.RecordBatch:
        sizes, matrix = np.asarray(sizes, np.float64), np.concatenate(sketches).reshape(len(keys), TOKENS)
        left, found = np.ones(len(keys), bool), []
        for root in range(len(keys) if len(keys) > 1 else 0):
            if not left[root]:
                continue
            left[root] = False
            front = [root]
            while front:  # rows are compared with those that no tree holds yet
                at = front.pop()
                rest = np.flatnonzero(left)
                small, large = np.minimum(sizes[rest], sizes[at]), np.maximum(sizes[rest], sizes[at])
                rest = rest[100 * small >= percent * large]
                reached = rest[(matrix[rest] == matrix[at]).sum(1) >= least]
                left[reached] = False
                found += [(root, int(x)) for x in reached]
                front += reached.tolist()
        pairs = [pa.array([keys[x[i]] for x in found], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(pairs, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, keys, sizes, sketches = None, [], [], []
        for batch in batches:
            tasks = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(tasks[1:] != tasks[:-1]) + 1).tolist(), len(tasks)] if len(tasks) else [0]
            for low, high in zip(edges, edges[1:]):
                if tasks[low] != group:
                    if keys:
                        yield links(keys, sizes, sketches)
                    group, keys, sizes, sketches = tasks[low], [], [], []
                part = batch.slice(low, high - low)
                keys += part.column(1).to_pylist()
                sizes += part.column(2).to_pylist()
                sketches.append(part.column(3).flatten().to_numpy())
        if keys:
            yield links(keys, sizes, sketches)

    return run


def close(nodes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the classes in each of ``nodes`` (node, key) that span what sizes and sketches may link.

    ``a`` is the smallest key of what hangs together in a task. Nodes that share most of a group then name the same pairs, and
    a group has about as many distinct ones as it has classes, whatever the number of nodes it meets in.
    """
    rows = nodes.join(classes.select("key", "n", "sketch"), "key").select("node", "key", "n", "sketch")
    tasks = _block_pairs(rows, "node", F.ceil(F.count("*") / BLOCK_SKETCHES), "n", "sketch")
    return tasks.repartition("task").sortWithinPartitions("task", "key").mapInArrow(_sketch_comparer(percent), "a long, b long")


def similar_sketches(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of distinct pairs (a, b), those whose sizes and sketches allow the threshold."""
    side = lambda c: classes.select(
        F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")
    )
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(
        (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    )
    equal = F.zip_with("sketch_a", "sketch_b", lambda x, y: (x == y).cast("int"))
    matches = F.aggregate(equal, F.lit(0), lambda total, x: total + x)
    return sized.withColumn("matches", matches).where(F.col("matches") >= least_matches(percent / 100)).select("a", "b")


def _children(node: Column, sketch: Column) -> Column:
    draws = [F.pmod(F.xxhash64(node, F.lit(j)), F.lit(TOKENS)).cast("int") for j in range(DRAWS)]
    return F.array_distinct(F.array(*[F.xxhash64(node, c, F.get(sketch, c)) for c in draws]))


def _branched(rows: DataFrame) -> DataFrame:
    return rows.select("key", F.explode(_children(F.col("node"), F.col("sketch"))).alias("node"))


def _distinct_nodes(nodes: DataFrame) -> DataFrame:
    """Of nodes with the same classes, one: large groups of near copies meet in many nodes."""
    named = materialised(nodes, "dense")
    contents = named.groupBy("node").agg(F.count("*").alias("n"), *[F.bit_xor(F.xxhash64(F.lit(i), "key")).alias(f"x{i}") for i in (0, 1)])
    first = contents.groupBy("n", "x0", "x1").agg(F.min("node").alias("node"))
    return named.join(first.select("node"), "node", "left_semi")


def meetings(classes: DataFrame, percent: int, trees: int) -> DataFrame:
    """Pairs (a, b) of similar sketches: all of small nodes, spanning ones of large nodes that are closed."""
    roots = F.explode(F.array(*[F.lit(t).cast("long") for t in range(trees)])).alias("node")
    level = _branched(classes.select("key", "sketch", roots))
    found = []
    for depth in range(LEVELS):
        level = materialised(level, f"level-{depth}")
        sizes = level.groupBy("node").agg(F.count("*").alias("size"), F.min("key").alias("pivot")).where("size > 1")
        rows = materialised(level.join(sizes, "node"), f"nodes-{depth}")
        # the pivot's pairs are filtered first; other pairs of a small node only matter if it holds three or more
        small = rows.where(F.col("size") <= SMALL)
        pairs = small.select("node", F.col("key").alias("a")).join(small.select("node", F.col("key").alias("b")), "node")
        found.append(materialised(similar_sketches(pairs.where("a < b").select("a", "b").distinct(), classes, percent), f"pairs-{depth}"))
        large = rows.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        if depth == LEVELS - 1:
            found.append(materialised(close(large.select("node", "key"), classes, percent).distinct(), "closed"))
            break
        star = large.where("key != pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
        alike = similar_sketches(star, classes, percent).select(F.col("a").alias("pivot"), F.col("b").alias("key"), F.lit(1).alias("alike"))
        judged = materialised(large.join(alike, ["pivot", "key"], "left"), f"judged-{depth}")
        dense = (F.sum(F.coalesce("alike", F.lit(0))) >= DENSE * (F.max("size") - 1)).alias("dense")
        judged = judged.join(judged.groupBy("node").agg(dense), "node")
        dense_nodes = _distinct_nodes(judged.where("dense").select("node", "key"))
        found.append(materialised(close(dense_nodes, classes, percent).distinct(), "closed"))
        level = _branched(judged.where("not dense").select("node", "key").join(classes.select("key", "sketch"), "key"))
    return reduce(DataFrame.unionByName, found)


def components(links: DataFrame) -> DataFrame:
    """(key, label) for every class of a link; the label is the smallest key that can be reached."""
    # one pass over the links, which are computed as they are read
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialised(links.select(F.inline(ways)).distinct(), "links")
    labels = materialised(both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("key"), F.least("a", "near").alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("key").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(seen.withColumnRenamed("a", "key"), "key").select("key", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        # follow the label's own label: chains halve instead of losing one link a round
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("root"))
        moved = moved.join(jump, "label", "left").select("key", F.least("label", F.coalesce("root", "label")).alias("label"), "old")
        moved = materialised(moved, "labels")
        if moved.where("label != old").isEmpty():
            return moved.select("key", "label")
        labels = moved.select("key", "label")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 85, recall: float = 0.99999) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text; others are ignored).

    Null or empty texts have no shingles and stay alone. Rows with a null doc_id are neither linked nor named: their
    component is null and they are kept. Rows that repeat a doc_id belong to the component of that id, and all of them
    are kept if the id is. An empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    sketches = materialised(sketched(docs, k), "sketches")
    named = sketches.where("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("class_key").agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("x")).select(
        F.col("class_key").alias("key"), "x.doc_id", F.col("x.n_shingles").alias("n"), "x.sketch"
    )
    classes = materialised(classes, "classes")
    coarse = components(meetings(classes, percent, trees_for(percent / 100, recall)))
    groups = materialised(coarse.join(classes.select("key", "doc_id", "n"), "key"), "groups")
    sets = full_sets(docs, groups.select("key", "doc_id"), k)
    labels = components(links_within(groups.select("key", "label", "n"), sets, percent))
    same_id = named.select(F.col("class_key").alias("key"), "doc_id").distinct()
    roots = same_id.join(labels, "key", "left").select("key", "doc_id", F.coalesce("label", "key").alias("label"))
    least = roots.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    placed = roots.join(least, "label").groupBy("key").agg(F.min("component_id").alias("component_id"))
    joined = sketches.join(placed, sketches.class_key == placed.key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def first_of_each_group(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stand for their group, columns unchanged: of each group, the row of the smallest doc_id.

    Rows are told apart by id and text, so distinct texts under one id, or without one, are judged on their own. Null ids
    come last; ties are broken by a hash of the text. Of rows that repeat id and text, one stays.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit("/"), text)
    named = docs.select(row.alias("doc_id"), F.col("doc_id").cast("long").alias("id"), "text")
    grouped = near_duplicates(named, **settings).select("doc_id", "component_id").distinct()
    ranked = named.select("doc_id", "id").distinct().join(grouped, "doc_id")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "doc_id")
    keep = ranked.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias("_row"))
    # the id and another hash keep rows apart that share a 64-bit name
    rows = docs.withColumns({"_row": row, "_id": F.col("doc_id").cast("string"), "_text": F.xxhash64(F.lit("/"), text)})
    return rows.join(keep, "_row", "left_semi").dropDuplicates(["_row", "_id", "_text"]).select(*docs.columns)
