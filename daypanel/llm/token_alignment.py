"""Alignment of two tokenizers over whole texts, as a monoid of fragments.

Both tokenizers spell the same bytes. Where tokens of both end, the text falls into groups; tokens are linked where their
byte ranges overlap. A ``Fragment`` is what is known of a byte range: tokens before its first common end (open prefix), the
groups closed within it, and tokens after its last common end (open suffix). ``compose`` joins neighbours: the left
suffix and the right prefix meet, close what ends together there, and pass on the rest. It is associative, so the chunks of
a very long text are encoded in different tasks and composed by a tree. Closed groups leave the fragments as pieces
at once; only open ends travel, and they stay small.

A chunk begins at the first place from a multiple of ``CHUNK`` characters on where no token can reach across: for each
tokenizer its own place, so that prefix and suffix are open in general. Such a place lies before a blank between two visible
characters, or between two that stand side by side in no entry of the vocabulary.

Counts of id pairs are corpus-wide. Texts are encoded once; a task gathers a block of them with the distinct pairs of the
block. Pairs are counted from those, looked up per block, and meet the texts of their block again. No table of pairs is
broadcast, and a frequent pair is one row per block.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm.packing import PATTERN
from daypanel.sources.scratch import materialised

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk: longer texts are cut.
CHUNK = 1 << 16
#: Characters that are encoded at once, and that share a block of pairs.
STEP, BLOCK = 1 << 20, 1 << 23
#: Fragments that a task composes per round.
FAN = 16
DOCUMENT, PIECE, PAIRS, FRAGMENT = range(4)
SCHEMA = (
    "kind int, block string, uid string, doc_id long, at long, n_a long, n_b long, n_groups long, n_links long, sha string, "
    "groups binary, keys array<long>, times array<int>, seq long, ok boolean, closed boolean, prefix_a binary, prefix_b binary, "
    "suffix_a binary, suffix_b binary"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


# -- tokenizers ---------------------------------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if visible, else from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both vocabularies: ids and byte lengths of texts, and the places where a text may be cut."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        import sentencepiece
        import tiktoken

        with open(byte_level, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        spelled = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()}
        merged = [x if isinstance(x, str) else " ".join(x) for x in model["merges"]]
        order = [model["vocab"][x.replace(" ", "", 1)] for x in merged]
        if any(a >= b for a, b in zip(order, order[1:])):
            raise ValueError("merges of the byte-level vocabulary don't follow its ids")
        self.plain = tiktoken.Encoding("alignment", pat_str=PATTERN, mergeable_ranks=spelled, special_tokens={})
        self.a_size = max(spelled.values()) + 1
        self.a_lengths = np.zeros(self.a_size, np.int64)
        for token, i in spelled.items():
            self.a_lengths[i] = len(token)
        self.a_pairs = {(x, y) for token in spelled for x, y in zip(token, token[1:])}
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b_size = self.pieces.get_piece_size()
        texts = [self.pieces.id_to_piece(i).replace("▁", " ") for i in range(self.b_size)]
        self.b_bytes = [bytes([int(t[1:-1], 16)]) if self.pieces.is_byte(i) else t.encode() for i, t in enumerate(texts)]
        self.b_lengths = np.asarray([len(x) for x in self.b_bytes], np.int64)
        self.b_pairs = {x + y for i, t in enumerate(texts) if not self.pieces.is_byte(i) for x, y in zip(t, t[1:])}
        if any("\n" in pair for pair in self.b_pairs) or len(self.pieces.encode("\n")) != 2:
            raise ValueError("the piece vocabulary joins line feeds")

    def a_ids(self, text: str) -> np.ndarray:
        return self.plain.encode_to_numpy(text).astype(np.int64)

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        """Pieces of texts that begin with the blank that the tokenizer puts there itself."""
        return self.pieces.encode([t[1:] for t in texts], num_threads=1)

    def b_chunk(self, text: str) -> list[int]:
        """Pieces of a part of a text, without a blank before it: a line feed takes that blank, and joins no piece."""
        return self.pieces.encode("\n" + text)[2:]

    def spells(self, a: np.ndarray, b: list[int], text: bytes) -> bool:
        """Whether both join to the text again. Byte-level tokens are cut from its bytes, so their length tells."""
        return int(self.a_lengths[a].sum()) == len(text) and b"".join([self.b_bytes[i] for i in b]) == text

    def a_cut(self, text: str, p: int) -> bool:
        """Whether no byte-level token can reach across place p."""
        x, y = text[p - 1], text[p]
        if x.isspace():
            return False
        if y == " ":
            return p + 1 < len(text) and not text[p + 1].isspace()
        return not y.isspace() and "'" not in (x, y) and (x.encode()[-1], y.encode()[0]) not in self.a_pairs

    def b_cut(self, text: str, p: int) -> bool:
        return text[p - 1 : p + 1].replace("▁", " ") not in self.b_pairs


def cuts(text: str, safe, chunk: int) -> list[int]:
    """Starts of the chunks of a text, and its end: the first safe place from each multiple of ``chunk`` on."""
    places = [0]
    for start in range(chunk, len(text), chunk):
        at = max(start, places[-1])
        while at > places[-1] and at < len(text) and not safe(text, at):
            at += 1
        places.append(at)
    return [*places, len(text)]


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    """The vocabularies in a task, from the files shipped with the job, or from the paths themselves elsewhere."""
    key = (byte_level, pieces)
    if key not in _LOADED:
        _LOADED[key] = Tokenizers(byte_level, pieces)
    return _LOADED[key]


# -- alignment of token arrays ------------------------------------------------------------------------------------------


def _digit_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    text = np.char.mod("%d", np.arange(size))
    digits = np.zeros((size, max(1, len(str(size - 1)))), np.uint8)
    for i, t in enumerate(text):
        digits[i, : len(t)] = np.frombuffer(t.encode(), np.uint8)
    return digits, np.char.str_len(text).astype(np.int64)


_DIGITS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def grouped_text(a: np.ndarray, b: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2;`` for tokens (ids, ends) with these common ends, and where each group ends in them."""
    size = int(max(a[0].max(initial=0), b[0].max(initial=0))) + 1
    size = 1 << size.bit_length()
    if size not in _DIGITS:
        _DIGITS[size] = _digit_table(size)
    digits, lengths = _DIGITS[size]
    of_a, of_b = np.searchsorted(common, a[1]), np.searchsorted(common, b[1])
    place_a = np.arange(len(of_a)) + np.searchsorted(of_b, of_a)
    place_b = np.arange(len(of_b)) + np.searchsorted(of_a, of_b, "right")
    ids, marks = np.empty(len(of_a) + len(of_b), np.int64), np.full(len(of_a) + len(of_b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a[0], b[0]
    last_b = place_b[np.searchsorted(b[1], common)]
    marks[place_a[np.searchsorted(a[1], common)]], marks[last_b] = ord("|"), ord(";")
    n = lengths[ids]
    ends = np.cumsum(n + 1)
    out, starts = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8), ends - n - 1
    for d in range(digits.shape[1]):
        has = n > d
        out[starts[has] + d] = digits[ids[has], d]
    out[ends - 1] = marks
    return out, ends[last_b]


def linked_keys(a: np.ndarray, b: np.ndarray, b_size: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair keys, end of the shared bytes) of all overlaps: one per stretch between neighbouring ends of either side."""
    ends = np.union1d(a[1], b[1])
    return a[0][np.searchsorted(a[1], ends)] * b_size + b[0][np.searchsorted(b[1], ends)], ends


@dataclass(frozen=True)
class Fragment:
    """Open tokens of a byte range, as (ids, ends) arrays of both sides; without a common end all are prefix."""

    prefix: tuple[np.ndarray, np.ndarray]
    suffix: tuple[np.ndarray, np.ndarray]
    closed: bool


Tokens = tuple[np.ndarray, np.ndarray]
NONE = np.zeros((2, 0), np.int64)


def _split(tokens: Tokens, at: int) -> tuple[Tokens, Tokens]:
    left = tuple(t[:, : np.searchsorted(t[1], at, "right")] for t in tokens)
    return left, tuple(t[:, x.shape[1] :] for t, x in zip(tokens, left))


def _joined(x: Tokens, y: Tokens) -> Tokens:
    return tuple(np.concatenate(side, 1) for side in zip(x, y))


def fragment(tokens: Tokens) -> tuple[Fragment, list[Tokens]]:
    """The fragment of these tokens and the closed part, if any."""
    common = np.intersect1d(tokens[0][1], tokens[1][1], assume_unique=True)
    if not len(common):
        return Fragment(tokens, (NONE, NONE), False), []
    prefix, rest = _split(tokens, common[0])
    inner, suffix = _split(rest, common[-1])
    return Fragment(prefix, suffix, True), [inner] if len(common) > 1 else []


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, list[Tokens]]:
    """Two neighbours as one, and what they close between them."""
    middle, inner = fragment(_joined(left.suffix if left.closed else left.prefix, right.prefix))
    if left.closed and middle.closed:  # the left's last common end closes the first group of the middle too
        inner = [_joined(middle.prefix, inner[0] if inner else (NONE, NONE))]
    if left.closed:
        suffix = right.suffix if right.closed else middle.suffix if middle.closed else middle.prefix
        return Fragment(left.prefix, suffix, True), inner
    return Fragment(middle.prefix, right.suffix if right.closed else middle.suffix, middle.closed), inner


# -- rows ---------------------------------------------------------------------------------------------------------------


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{name: row.get(name) for name in _NAMES} for row in rows], _ARROW)


_TYPES = {
    "int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}
_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in (part.split() for part in SCHEMA.split(", "))])


class PairBlock:
    """Distinct pairs of the texts of a block, with the number of texts that hold each."""

    def __init__(self) -> None:
        self.name, self.keys, self.size = uuid.uuid4().hex, [], 0

    def add(self, keys: np.ndarray, size: int) -> None:
        self.keys.append(keys)
        self.size += size

    def row(self, counted: bool) -> dict:
        keys, docs = np.unique(np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64), return_counts=True)
        return {"kind": PAIRS, "block": self.name, "keys": keys, "times": docs if counted else docs * 0}


def _piece(tokens: Tokens, b_size: int, **more) -> list[dict]:
    """Rows of a closed part of a long text: its groups, and its pairs as a block of their own."""
    a, b = tokens
    common = np.intersect1d(a[1], b[1], assume_unique=True)
    text, _ = grouped_text(a, b, common)
    links, _ = linked_keys(a, b, b_size)
    keys, times = np.unique(links, return_counts=True)
    block = PairBlock()
    block.add(keys, 0)
    piece = {
        "kind": PIECE, "block": block.name, "at": int(a[1][0]), "n_a": a.shape[1], "n_b": b.shape[1], "n_groups": len(common),
        "n_links": len(links), "groups": text[:-1].tobytes(), "keys": keys, "times": times, **more,
    }
    return [piece, block.row(counted=False)]


def _fragment_row(found: Fragment, ok: bool, **more) -> dict:
    sides = {f"{part}_{side}": t.tobytes() for part in ("prefix", "suffix") for side, t in zip("ab", getattr(found, part))}
    return {"kind": FRAGMENT, "ok": ok, "closed": found.closed, **sides, **more}


def _fragment_of(row: dict) -> Fragment:
    prefix, suffix = (tuple(np.frombuffer(row[f"{part}_{side}"], np.int64).reshape(2, -1) for side in "ab") for part in ("prefix", "suffix"))
    return Fragment(prefix, suffix, row["closed"])


def _aligned_texts(ids: list, texts: list[str | None], kit: Tokenizers, block: PairBlock) -> list[dict]:
    """Rows of short texts; their pairs go to the block."""
    full = [" " + t if t else None for t in texts]
    encoded = iter(kit.b_ids([t for t in full if t]))
    rows, parts, at = [], [], 0
    for doc_id, text in zip(ids, full):
        row = {"kind": DOCUMENT, "block": block.name, "doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "sha": "", "keys": [], "times": []}
        rows.append(row)
        if text:
            a, b, data = kit.a_ids(text), next(encoded), text.encode()
            if kit.spells(a, b, data):
                b = np.asarray(b, np.int64)
                parts.append((row, np.stack([a, np.cumsum(kit.a_lengths[a]) + at]), np.stack([b, np.cumsum(kit.b_lengths[b]) + at])))
                at += len(data)
    if not parts:
        return rows
    # one pass over all texts, end to end: each text's end is an end of both sides
    a, b = (np.concatenate([p[i] for p in parts], 1) for i in (1, 2))
    common = np.intersect1d(a[1], b[1], assume_unique=True)
    buffer, group_ends = grouped_text(a, b, common)
    links, ends = linked_keys(a, b, kit.b_size)
    text_ends = np.asarray([p[1][1, -1] for p in parts])
    pairs = kit.a_size * kit.b_size
    distinct, times = np.unique(np.searchsorted(text_ends, ends) * pairs + links, return_counts=True)
    cut = np.searchsorted(distinct, np.arange(len(parts) + 1) * pairs)
    distinct %= pairs
    groups, linked = (np.searchsorted(x, text_ends, "right") for x in (common, ends))
    bytes_to = group_ends[groups - 1]
    last_group = last_link = first_byte = 0
    for i, (row, own_a, own_b) in enumerate(parts):
        row |= {
            "n_a": own_a.shape[1], "n_b": own_b.shape[1], "n_groups": int(groups[i]) - last_group, "n_links": int(linked[i]) - last_link,
            "sha": hashlib.sha256(buffer[first_byte : bytes_to[i] - 1]).hexdigest(),
            "keys": distinct[cut[i] : cut[i + 1]], "times": times[cut[i] : cut[i + 1]],
        }
        last_group, last_link, first_byte = int(groups[i]), int(linked[i]), int(bytes_to[i])
    block.add(distinct, sum(len(t) for t in full if t))
    return rows


def _shipped(paths: tuple[str, str]) -> Tokenizers:
    return tokenizers(*[SparkFiles.get(p.rsplit("/", 1)[-1]) for p in paths])


def _short_texts(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit, block = _shipped(paths), PairBlock()
        for batch in batches:
            first, size = 0, 0
            for i, text in enumerate(batch.column(1)):
                size += text.as_buffer().size if text.is_valid else 0
                if size >= STEP or i + 1 == batch.num_rows:
                    ids, texts = (batch.column(c).slice(first, i + 1 - first).to_pylist() for c in (0, 1))
                    yield _batch(_aligned_texts(ids, texts, kit, block))
                    first, size = i + 1, 0
                    if block.size >= BLOCK:
                        yield _batch([block.row(counted=True)])
                        block = PairBlock()
        if block.keys:
            yield _batch([block.row(counted=True)])

    return run


def _long_texts(paths: tuple[str, str], chunk: int):
    """Cuts long texts: uid, doc_id, seq, and for both sides the chunk's text and its place in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = _shipped(paths)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                full, uid = " " + text.as_py(), uuid.uuid4().hex
                places = [cuts(full, safe, chunk) for safe in (kit.a_cut, kit.b_cut)]
                at = [0, 0]
                for seq, bounds in enumerate(zip(*[zip(p, p[1:]) for p in places])):
                    row = {"uid": uid, "doc_id": doc_id, "seq": seq}
                    for k, (low, high) in enumerate(bounds):
                        row |= {f"text_{'ab'[k]}": full[low:high], f"at_{'ab'[k]}": at[k]}
                        at[k] += len(row[f"text_{'ab'[k]}"].encode())
                    yield pa.RecordBatch.from_pylist([row], _CHUNK_ARROW)

    return run


CHUNKS = "uid string, doc_id long, seq long, text_a string, at_a long, text_b string, at_b long"
_CHUNK_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in (part.split() for part in CHUNKS.split(", "))])


def _chunks(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = _shipped(paths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                a, b = kit.a_ids(row["text_a"]), kit.b_chunk(row["text_b"])
                ok = int(kit.a_lengths[a].sum()) == len(row["text_a"].encode()) and b"".join([kit.b_bytes[x] for x in b]) == row["text_b"].encode()
                b = np.asarray(b, np.int64)
                tokens = (np.stack([a, np.cumsum(kit.a_lengths[a]) + row["at_a"]]), np.stack([b, np.cumsum(kit.b_lengths[b]) + row["at_b"]]))
                found, inner = fragment(tokens) if ok else (Fragment((NONE, NONE), (NONE, NONE), False), [])
                named = {"uid": row["uid"], "doc_id": row["doc_id"]}
                out = [_fragment_row(found, ok, seq=row["seq"], **named)]
                for part in inner:
                    out += _piece(part, kit.b_size, **named)
                yield _batch(out)

    return run


def _composer(b_size: int):
    """Composes the fragments of a group in their order."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
        named = {"uid": rows[0]["uid"], "doc_id": rows[0]["doc_id"]}
        total, out, ok = _fragment_of(rows[0]), [], all(r["ok"] for r in rows)
        for row in rows[1:] if ok else []:
            total, inner = compose(total, _fragment_of(row))
            for part in inner:
                out += _piece(part, b_size, **named)
        out.append(_fragment_row(total, ok, seq=rows[0]["seq"] // FAN, **named))
        return pa.Table.from_batches([_batch(out)])

    return run


def _first_groups(b_size: int):
    """The prefix of a whole text is closed, as the text's start is a common end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                prefix = _fragment_of(row).prefix
                if row["ok"] and prefix[0].shape[1]:
                    yield _batch(_piece(prefix, b_size, uid=row["uid"], doc_id=row["doc_id"]))

    return run


def _pieces_hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, sha) of the joined groups of each text; pieces come in order."""
    uid, digest = None, None
    schema = pa.schema([("uid", pa.string()), ("sha", pa.string())])
    for batch in batches:
        for own, groups in zip(batch.column(0).to_pylist(), batch.column(2)):
            if own == uid:
                digest.update(b";")
            else:
                if uid:
                    yield pa.RecordBatch.from_pylist([{"uid": uid, "sha": digest.hexdigest()}], schema)
                uid, digest = own, hashlib.sha256()
            digest.update(groups.as_buffer())
    if uid:
        yield pa.RecordBatch.from_pylist([{"uid": uid, "sha": digest.hexdigest()}], schema)


def _valued(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """n_best and count_sum of the texts of a block, whose pairs come with their counts."""
    order = np.argsort(keys := pairs.column("key").to_numpy())
    keys, counts, top = keys[order], pairs.column("n").to_numpy()[order], pairs.column("top").to_numpy()[order]
    lists, times = (texts.column(c).combine_chunks() for c in ("keys", "times"))
    place = np.searchsorted(keys, lists.flatten().to_numpy())
    times, bounds = times.flatten().to_numpy().astype(np.int64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * top[place], times * counts[place])]
    told = [pa.array((s[bounds[1:]] - s[bounds[:-1]]).astype(np.int64)) for s in sums]
    kept = texts.select(["uid", "doc_id", "at", "n_a", "n_b", "n_groups", "n_links", "sha", "groups"])
    return kept.append_column("n_best", told[0]).append_column("count_sum", told[1])


def aligned(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, chunk: int = CHUNK) -> DataFrame:
    """Rows of texts (uid null) and of closed parts of long texts (uid, ``at``, ``groups``), pairs and fragments by kind."""
    spark, paths = docs.sparkSession, (byte_level, pieces)
    for path in paths:
        spark.sparkContext.addFile(path)
    b_size = tokenizers(*paths).b_size
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = texts.where(~is_long).mapInArrow(_short_texts(paths), SCHEMA)
    chunks = materialised(texts.where(is_long).mapInArrow(_long_texts(paths, chunk), CHUNKS), "text-chunks")
    parts = materialised(chunks.repartition("uid", "seq").mapInArrow(_chunks(paths), SCHEMA), "fragments")
    found = [materialised(short, "aligned"), parts]
    left = parts.where(F.col("kind") == FRAGMENT)
    count = (chunks.agg(F.max("seq")).first()[0] or 0) + 1
    while count > 1:
        group = left.withColumn("group", F.floor(F.col("seq") / FAN)).groupBy("uid", "group")
        parts = materialised(group.applyInArrow(_composer(b_size), SCHEMA), "fragments")
        found.append(parts.where(F.col("kind") != FRAGMENT))
        left, count = parts.where(F.col("kind") == FRAGMENT), -(-count // FAN)
    found[1] = found[1].where(F.col("kind") != FRAGMENT)
    first = materialised(left.mapInArrow(_first_groups(b_size), SCHEMA), "first-groups")
    whole = found[0]
    for more in (*found[1:], first, left):
        whole = whole.unionByName(more)
    return whole


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """(key, n, top): number of documents that hold a pair linked, and whether no other pair of its first id has more."""
    pairs = rows.where(F.col("kind") == PAIRS).select(F.explode(F.arrays_zip("keys", "times")).alias("x"))
    short = pairs.select(F.col("x.keys").alias("key"), F.col("x.times").cast("long").alias("n")).where("n > 0")
    long = rows.where(F.col("kind") == PIECE).select("uid", F.explode("keys").alias("key")).distinct().select("key", F.lit(1).cast("long").alias("n"))
    counts = short.unionByName(long).groupBy("key").agg(F.sum("n").alias("n"))
    counts = materialised(counts.withColumn("a", F.floor(F.col("key") / b_size)), "pair-counts")
    best = counts.groupBy("a").agg(F.max("n").alias("best"))  # at most b_size pairs an id
    return counts.join(best, "a").select("key", "n", (F.col("n") == F.col("best")).alias("top"))


VALUED = (
    "uid string, doc_id long, at long, n_a long, n_b long, n_groups long, n_links long, sha string, groups binary, n_best long, "
    "count_sum long"
)


def alignment(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs`` (doc_id, text; others are
    ignored).

    Null and empty texts, and texts that a tokenizer changes, have no tokens: zeros and an empty digest. Rows that repeat a
    doc_id, or have none, are documents of their own, equal ones included. A text is encoded whole: where it is cut, no token
    could reach across; a stretch without such a place is encoded in one piece. An empty table gives an empty table.
    """
    rows = aligned(docs, byte_level, pieces, chunk)
    fragments = rows.where(F.col("kind") == FRAGMENT)
    failed = fragments.where("not ok").select("uid")
    # rows of short texts have no uid and take no part in the join
    parts = rows.where(F.col("kind") == PIECE).join(failed, "uid", "left_anti")
    texts = rows.where(F.col("kind") == DOCUMENT).unionByName(parts)
    counts = materialised(pair_counts(texts.unionByName(rows.where(F.col("kind") == PAIRS)), tokenizers(byte_level, pieces).b_size), "pair-values")
    asked = rows.where(F.col("kind") == PAIRS).select(F.col("block").alias("of"), F.explode("keys").alias("key"))
    known = asked.join(counts, "key").select("of", "key", "n", F.col("top").cast("long").alias("top"))
    valued = texts.drop("seq", "ok", "closed").groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_valued, VALUED)
    valued = materialised(valued, "valued")
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("sha").alias("groups_sha256")]
    parts = valued.where("uid is not null")
    summed = parts.groupBy("uid").agg(*sums)
    dealt = parts.select("uid", "at", "groups").repartition("uid").sortWithinPartitions("uid", "at")
    hashed = dealt.mapInArrow(_pieces_hashed, "uid string, sha string")
    long = fragments.select("uid", "doc_id").join(summed, "uid", "left").join(hashed, "uid", "left")
    long = long.na.fill(0, ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]).na.fill("", ["sha"])
    return valued.where("uid is null").select(*columns).unionByName(long.select(*columns))
