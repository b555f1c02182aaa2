"""Removal of repeated strings by grouping sampled suffixes and their Burrows-Wheeler symbols across shards.

Suffixes are sampled, since only strings of ``span`` bytes matter. Sampled positions (anchors) are minima of a rolling
hash over ``REACH`` neighbouring positions: two equal strings of ``span`` bytes always share an anchor among their first
``REACH`` positions, at the same offset. The text around an anchor is read as four symbols, each the hash of a piece:
``first`` and ``second`` make up the core that every string through this anchor contains, ``right`` is what can follow
within ``span``, and ``left`` is what can precede. A suffix is the string first, second, right; ``left`` is the symbol
before it, its entry in the Burrows-Wheeler transform.

1. Shard: a task sorts the sampled suffixes of its texts and writes them in that order with their left symbols, equal
   rows collapsed.
2. Merge: slices of all shards that begin with the same symbols meet in a task. The shuffle keeps no order of rows, so the
   interleave is a sort again, symbol by symbol: rows move only inside their block, and a block of one row is finished and
   looked at no more. Blocks that stay together through the core are the repeated intervals; the left symbols tell which
   of them are repeated as a whole.
3. Edges: a repeated core whose surroundings differ is the edge of a repeat. Its surroundings are compared byte by byte
   in bands of offsets, under the hash of all that a band has in common. A name of more than ``HOT_NAMES`` rows is not
   held in a task: its members are counted by offset and surrounding bytes instead.
4. The covered bytes of a text are united and cut out.

Hashes have 64 bits and are compared two or more at a time. Texts with equal 64-bit hashes count as copies. Work that
meets in a task is bounded: shards by ``SHARD_ROWS``, merges by routing the suffixes of a very frequent first symbol by
all of their symbols (each of them then counts as an edge or as a whole repeat, which stage 3 decides anyway), and edges
by counting the members of frequent names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm import wordhash
from daypanel.llm.wordhash import ODD, POWERS, U, mix
from daypanel.sources.scratch import materialised

SPAN = 400
REACH = 192
GRAM = 16
#: Bands of offsets that are compared under one hash; divides REACH.
BANDS = 4
SHARD_ROWS = 200_000
#: Rows of a first symbol from which on copies are added up first and, if that isn't enough, rows routed by all symbols.
HOT_ROWS = 100_000
#: Edge candidates under one name that a task may hold.
HOT_NAMES = 20_000
SUFFIXES = "first long, second long, right long, left long, text_key long, at int, room int, copies int"
PIECES = "text_key long, start int, stop int"
BYTES = wordhash.byte_values(21)


class Hashed:
    """Prefix sums of a text, for hashes of any of its pieces."""

    def __init__(self, text: np.ndarray) -> None:
        self.up, self.down = POWERS.reach(len(text) + 1)
        self.sums = np.zeros(len(text) + 1, U)
        np.cumsum(BYTES[text] * self.up[: len(text)], out=self.sums[1:])

    def pieces(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U) * U(ODD))


def _sliding(values: np.ndarray, reach: int, best) -> np.ndarray:
    """best() over every run of ``reach`` values."""
    width = 1
    while 2 * width <= reach:
        values, width = best(values[:-width], values[width:]), 2 * width
    return best(values[: len(values) - (reach - width)], values[reach - width :]) if width < reach else values


def anchors(hashed: Hashed, n: int) -> np.ndarray:
    """Positions that are a minimum of some run of ``REACH`` positions, ties included."""
    grams = n - GRAM + 1
    if grams < REACH:
        return np.zeros(0, np.int64)
    starts = np.arange(grams)
    values = (hashed.pieces(starts, starts + GRAM) >> U(32)).astype(np.uint32)
    lows = _sliding(values, REACH, np.minimum)
    padded = np.concatenate([np.zeros(REACH - 1, np.uint32), lows, np.zeros(REACH - 1, np.uint32)])
    return np.flatnonzero(_sliding(padded, REACH, np.maximum) == values)


def _suffixes(text: np.ndarray, span: int) -> list[np.ndarray] | None:
    n, core = len(text), span - REACH + 1
    if n < span:
        return None
    hashed = Hashed(text)
    at = anchors(hashed, n)
    at = at[at + core <= n]
    middle, end = at + core // 2, at + core
    right, left = np.minimum(end + REACH - 1, n), np.maximum(at - REACH + 1, 0)
    return [hashed.pieces(at, middle), hashed.pieces(middle, end), hashed.pieces(end, right), hashed.pieces(left, at), at, right - end]


def _shards(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            data, offsets = wordhash.text_bytes(batch.column(0))
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                found = _suffixes(data[offsets[i] : offsets[i + 1]], span)
                if found:
                    held.append([*found, np.full(len(found[0]), keys[i])])
                    rows += len(found[0])
                if rows >= SHARD_ROWS:
                    yield _shard(held)
                    held, rows = [], 0
        if rows:
            yield _shard(held)

    return run


def _shard(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    """One shard's suffixes in order, with left symbols; equal rows (of copied texts) are counted."""
    first, second, right, left, at, room, key = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((at, key, left, right, second, first))
    columns = [x[order] for x in (first, second, right, left, key, at, room)]
    new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in columns[:6]], axis=0)])
    copies = np.diff(np.append(np.flatnonzero(new), len(new)))
    columns = [x[new] for x in columns]
    arrays = [pa.array(x.view(np.int64)) for x in columns[:4]] + [pa.array(columns[4], pa.int64())]
    arrays += [pa.array(x.astype(np.int32)) for x in (*columns[5:], copies)]
    return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in SUFFIXES.split(", ")])


def refined(order: np.ndarray, block: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round of the interleave: rows move within their block by the next symbol; (order, block) afterwards."""
    step = np.lexsort((symbol[order], block))
    order, block = order[step], block[step]
    parts = np.concatenate([[False], (block[1:] != block[:-1]) | (symbol[order][1:] != symbol[order][:-1])])
    return order, np.cumsum(parts)


def _unfinished(order: np.ndarray, block: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only blocks that hold more than one occurrence."""
    more = np.bincount(block, copies[order])[block] > 1 if len(block) else np.zeros(0, bool)
    return order[more], block[more]


def merged(symbols: list[np.ndarray], copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated intervals of shard-wise sorted suffixes (first, second, right, left).

    Returns rows in merged order, their core interval, and whether all four symbols are shared with another occurrence.
    """
    order, block = np.arange(len(copies)), np.zeros(len(copies), np.int64)
    for symbol in symbols[:2]:
        order, block = _unfinished(*refined(order, block, symbol), copies)
    core = block
    place = np.empty(len(copies), np.int64)
    place[order] = core
    whole = np.zeros(len(copies), bool)
    inner, deep = order, core
    for symbol in symbols[2:]:
        inner, deep = _unfinished(*refined(inner, deep, symbol), copies)
    whole[inner] = True
    return order, core, whole[order]


def _merger(span: int, hot: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None:
            return
        symbols = [table.column(i).to_numpy() for i in range(4)]
        keys, at, room, copies = (table.column(i).to_numpy() for i in range(4, 8))
        order, core, whole = merged(symbols, copies)
        if hot:  # slices of one symbol are spread: all of them stay candidates
            lone = np.setdiff1d(np.arange(len(copies)), order)
            order, whole = np.concatenate([order, lone]), np.concatenate([whole, np.zeros(len(lone), bool)])
            core = np.concatenate([core, np.arange(len(lone)) + (core.max() + 1 if len(core) else 0)])
            edge = np.ones(len(order), bool)
        else:  # an interval without edges needs no comparison
            edge = (np.bincount(core, ~whole)[core] > 0) if len(core) else np.zeros(0, bool)
        # of occurrences that share everything one stands for all in comparisons
        names = mix(symbols[0].view(U)[order] ^ mix(symbols[1].view(U)[order]))
        context = mix(names ^ mix(symbols[2].view(U)[order]) + symbols[3].view(U)[order])
        stands = np.zeros(len(order), bool)
        stands[np.unique(context, return_index=True)[1]] = True
        out = [keys[order], at[order], room[order], whole, edge & (~whole | stands)]
        keep = whole | out[4]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in out], ["text_key", "at", "room", "whole", "compare"]
        )

    return run


def repeated_intervals(suffixes: DataFrame, span: int) -> DataFrame:
    """(text_key, at, room, whole, compare) of suffixes whose core occurs again; ``suffixes`` is stored."""
    schema = "text_key long, at int, room int, whole boolean, compare boolean"
    total = suffixes.count()
    parts = max(1, -(-total // SHARD_ROWS))
    if total <= HOT_ROWS:  # no symbol can be hot
        return suffixes.repartition(parts, "first").mapInArrow(_merger(span, False), schema)
    frequent = lambda rows: rows.groupBy("first").count().where(F.col("count") > HOT_ROWS).select("first")
    hot = materialised(frequent(suffixes), "hot-symbols")
    if hot.isEmpty():
        return suffixes.repartition(parts, "first").mapInArrow(_merger(span, False), schema)
    cool = suffixes.join(hot, "first", "left_anti")
    keys = [c for c in suffixes.columns if c != "copies"]
    added = suffixes.join(hot, "first", "left_semi").groupBy(*keys).agg(F.sum("copies").cast("int").alias("copies"))
    added = materialised(added.select(*suffixes.columns), "hot-suffixes")
    hot = materialised(frequent(added), "hot-symbols")
    cool = cool.unionByName(added.join(hot, "first", "left_anti")).repartition(parts, "first").mapInArrow(_merger(span, False), schema)
    if hot.isEmpty():
        return cool
    spread = added.join(hot, "first", "left_semi").repartition(parts, "first", "second", "right", "left")
    return cool.unionByName(spread.mapInArrow(_merger(span, True), schema))


def _edges(span: int):
    """Per anchor to compare and band: the hash of what all strings of the band share, and the bytes around it.

    The strings of band b start b*width to (b+1)*width-1 bytes before the anchor.
    """
    salts = mix(np.arange(1, BANDS + 1, dtype=U))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = wordhash.text_bytes(batch.column(0))
            keys, places = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            for i, marked in enumerate(places):
                text = data[offsets[i] : offsets[i + 1]]
                raw, hashed, width = text.tobytes(), Hashed(text), REACH // BANDS
                at = np.repeat(np.asarray(marked, np.int64), BANDS)
                band = np.tile(np.arange(BANDS), len(marked))
                start = at - band * width
                end = start - width + 1 + span
                inside = (start >= 0) & (end <= len(text))
                at, band, start, end = at[inside], band[inside], start[inside], end[inside]
                out[0].append(hashed.pieces(start, end) ^ salts[band])
                out[1].append(np.full(len(at), keys[i]))
                out[2].append(at)
                out[3].append(band)
                out[4] += [raw[max(0, a - width + 1) : a] for a in start.tolist()]
                out[5] += [raw[e : e + width - 1] for e in end.tolist()]
            if not out[0]:
                continue
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            columns = [np.concatenate(out[0]).view(np.int64), *map(np.concatenate, out[1:4]), *out[4:]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["name", "text_key", "at", "band", "before", "after"])

    return run


def _matches(members: list[tuple], span: int) -> Iterator[tuple[int, int, int]]:
    """Covered pieces (text_key, start, end) of anchors that share a band's common part."""
    width = REACH // BANDS - 1
    for extra in range(width + 1):  # bytes taken before the common part; the others are taken behind it
        found = [
            ((m[3][len(m[3]) - extra :] if extra else b"", m[4][: width - extra]), m)
            for m in members
            if len(m[3]) >= extra and len(m[4]) >= width - extra
        ]
        counts = Counter(key for key, _ in found)
        for key, m in found:
            if counts[key] > 1:
                start = m[1] - m[2] * REACH // BANDS - extra
                yield m[0], start, start + span


def _edge_matcher(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, members = None, set()
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            names = batch.column(0).to_numpy()
            same = names[1:] == names[:-1]
            # a name that stands alone matches nothing; the ends of a batch may go on in the next one
            batch = batch.filter(pa.array(np.append(True, same) | np.append(same, True)))
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if row[0] != name:
                    out += _united(members, span)
                    name, members = row[0], set()
                members.add(row[1:])  # copies of a text show the same rows
            yield _pieces(out)
        yield _pieces(_united(members, span))

    return run


def _united(members: set, span: int) -> list[tuple[int, int, int]]:
    """Matches of one group with touching pieces of a text joined."""
    out: list[tuple[int, int, int]] = []
    for key, start, end in sorted(set(_matches(list(members), span))) if len(members) > 1 else ():
        if out and out[-1][0] == key and start <= out[-1][2]:
            out[-1] = (key, out[-1][1], max(end, out[-1][2]))
        else:
            out.append((key, start, end))
    return out


def _pieces(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()))], ["text_key", "start", "stop"])


def _hot_pieces(edges: DataFrame, span: int) -> DataFrame:
    """What ``_edge_matcher`` finds, by counts: a member has a key per offset, and equal keys of two members are a repeat.

    Keys are counted by hash first. Those found twice go back to their members, where the bytes themselves are counted.
    """
    width = REACH // BANDS - 1
    before, after = F.octet_length("before"), F.octet_length("after")
    low, high = F.greatest(F.lit(0), F.lit(width) - after), F.least(F.lit(width), before)
    extra = F.explode(F.when(low <= high, F.sequence(low, high))).alias("extra")
    member = F.xxhash64("text_key", "at", "band").alias("member")
    dealt = edges.select("name", "text_key", "at", "band", member, F.concat("before", "after").alias("around"), before.alias("n"), extra)
    dealt = dealt.withColumn("bytes", F.substring("around", F.col("n") - F.col("extra") + 1, F.lit(width))).drop("around", "n")
    dealt = dealt.withColumn("key", F.xxhash64("name", "extra", "bytes"))
    # copies of a text are one member
    twice = lambda rows, *key: rows.groupBy(*key).agg(F.min("member").alias("x"), F.max("member").alias("y")).where("x < y").select(*key)
    near = materialised(dealt.join(materialised(twice(dealt, "key"), "hot-keys"), "key", "left_semi"), "hot-members")
    same = ["name", "extra", "bytes"]
    found = near.join(materialised(twice(near, *same), "hot-matches"), same, "left_semi")
    # strings of one member start less than their length apart, so they are one piece
    united = found.groupBy("text_key", "at", "band").agg(F.min("extra").alias("least"), F.max("extra").alias("most"))
    start = F.col("at") - F.col("band") * (REACH // BANDS)
    return united.select("text_key", (start - F.col("most")).alias("start"), (start - F.col("least") + span).alias("stop"))


def _edge_pieces(edges: DataFrame, span: int) -> DataFrame:
    """Covered pieces (text_key, start, stop) of ``edges``, which are stored."""
    matched = lambda rows: rows.repartition("name").sortWithinPartitions("name").mapInArrow(_edge_matcher(span), PIECES)
    if edges.count() <= HOT_NAMES:  # no name can be hot
        return matched(edges)
    hot = materialised(edges.groupBy("name").count().where(F.col("count") > HOT_NAMES).select("name"), "hot-names")
    if hot.isEmpty():
        return matched(edges)
    return matched(edges.join(hot, "name", "left_anti")).unionByName(_hot_pieces(edges.join(hot, "name", "left_semi"), span))


def repeated_pieces(texts: DataFrame, span: int = SPAN) -> DataFrame:
    """Per text_key the covered pieces, as an array of {start, stop}. ``texts`` has (text, text_key)."""
    suffixes = materialised(texts.select("text", "text_key").mapInArrow(_shards(span), SUFFIXES), "suffixes")
    found = materialised(repeated_intervals(suffixes, span), "intervals")
    # a string of a whole repeat starts up to REACH-1 before the anchor and has to end inside the text
    behind = F.col("room") - (REACH - 1)
    start = F.greatest(F.lit(0), F.col("at") - (REACH - 1))
    whole = found.where("whole").select("text_key", start.alias("start"), (F.col("at") + behind + span).alias("stop")).where(F.col("stop") - F.col("start") >= span)
    marked = found.where("compare").groupBy("text_key").agg(F.collect_set("at").alias("places"))
    edges = texts.join(marked, "text_key").select("text", "text_key", "places").mapInArrow(
        _edges(span), "name long, text_key long, at int, band int, before binary, after binary"
    )
    near = _edge_pieces(materialised(edges, "edges"), span)
    pieces = whole.unionByName(near).groupBy("text_key").agg(F.collect_set(F.struct("start", "stop")).alias("pieces"))
    return pieces


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = wordhash.text_bytes(batch.column(1))
        out: list[tuple] = []
        for i, pieces in enumerate(batch.column(2).to_pylist()):
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            spans: list[list[int]] = []
            for start, stop in sorted((p["start"], p["stop"]) for p in pieces or ()):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], stop)
                else:
                    spans.append([start, stop])
            kept, last = [], 0
            for start, stop in spans:
                kept.append(raw[last:start])
                last = stop
            kept.append(raw[last:])
            out.append((len(raw), sum(b - a for a, b in spans), len(spans), b"".join(kept), spans))
        columns = list(zip(*out)) if out else [[]] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"]
        )


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) and spans for every row of ``docs`` (doc_id, text).

    Every byte goes that is covered by a string of ``span`` bytes which starts at another place too, in the same text or
    another one. A null text is empty. Repeated rows are occurrences of their own, so they remove each other. ``span``
    has to exceed ``REACH`` by at least the length of two grams. An empty table gives an empty table.
    """
    if span < REACH + 2 * GRAM:
        raise ValueError(f"span has to be at least {REACH + 2 * GRAM}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    pieces = materialised(repeated_pieces(texts, span), "pieces").withColumnRenamed("text_key", "p_key")
    joined = texts.join(pieces, F.col("text_key") == F.col("p_key"), "left").select("doc_id", "text", "pieces")
    return joined.mapInArrow(_remover, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<array<int>>")
