"""Token ids packed into fixed-length rows by best-fit decreasing.

A task reads its documents, tokenises whole texts and cuts overlong ones into pieces without loss. Whenever about
``block_tokens`` are in hand, the pieces of that block are packed, the longest first, each into the fullest row that
still has room. Rows are looked up in a segment tree over room left. Nothing is shuffled, memory follows the block,
and a task that runs again on the same rows packs the same.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokenisation pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PACKED = (
    "sequence_id string, n_tokens int, n_segments int, doc_ids array<long>, piece_starts array<long>, "
    "cu_seqlens array<int>, ids binary, positions binary"
)


class RoomTree:
    """Counts of open rows by room left, with a search for the least room of at least a given size."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = [0] * (2 * self.leaves)

    def change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self.change(room, 1)

    def least(self, need: int) -> int | None:
        """The smallest room >= need that some row has."""
        at, count = need + self.leaves, self.count
        if count[at]:
            return need
        while at > 1:  # up until a right neighbour holds something, then down on the left
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None

    def take(self, room: int) -> int:
        self.change(room, -1)
        return self.rows[room].pop()


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of item numbers: items by falling length, ties in given order, each into the fullest row that has room."""
    tree, rows = RoomTree(capacity), []
    for item in np.argsort(-lengths, kind="stable"):
        need = int(lengths[item])
        room = tree.least(need)
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = tree.take(room)
        rows[row].append(int(item))
        if room > need:
            tree.put(room - need, row)
    return rows


class Encoder:
    """Token ids of whole texts as little-endian bytes."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")

    def __call__(self, text: str) -> bytes:
        return np.asarray(self.plain.encode_ordinary(text), self.kind).tobytes()


def _packer(path: str, length: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        width = encode.kind.itemsize
        held: list[tuple[int | None, int, bytes]] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) if text.is_valid else b""
                for at in range(0, len(ids), length * width):
                    held.append((doc_id, at // width, ids[at : at + length * width]))
                size += len(ids) // width
                if size >= block_tokens:
                    yield _packed(held, length, encode.kind)
                    held, size = [], 0
        if held:
            yield _packed(held, length, encode.kind)

    return run


def _packed(held: list[tuple[int | None, int, bytes]], length: int, kind: np.dtype) -> pa.RecordBatch:
    lengths = np.asarray([len(x[2]) // kind.itemsize for x in held])
    out: dict[str, list] = {name: [] for name in ("sequence_id", "n_tokens", "n_segments", "doc_ids", "piece_starts", "cu_seqlens", "ids", "positions")}
    for row in best_fit(lengths, length):
        sizes = lengths[row]
        used = int(sizes.sum())
        ids = b"".join(held[i][2] for i in row)
        out["sequence_id"].append(f"{held[row[0]][0]}-{held[row[0]][1]}")
        out["n_tokens"].append(used)
        out["n_segments"].append(len(row))
        out["doc_ids"].append([held[i][0] for i in row])
        out["piece_starts"].append([held[i][1] for i in row])
        out["cu_seqlens"].append(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        out["ids"].append(ids + bytes((length - used) * kind.itemsize))
        positions = np.concatenate([np.arange(n, dtype=kind) for n in [*sizes, length - used]])
        out["positions"].append(positions.tobytes())
    types = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def packed_sequences(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = 2048, block_tokens: int = 2_000_000) -> DataFrame:
    """One row per packed sequence of ``docs`` (doc_id, text; other columns are ignored).

    ``ids`` has ``length`` little-endian ids (two bytes each, four if the vocabulary needs them), zero behind the last
    segment; ``cu_seqlens`` bounds the segments, ``doc_ids`` and ``piece_starts`` say which tokens they are, and
    ``positions`` starts anew at 0 in each segment and in the padding. Null and empty texts have no tokens and appear
    nowhere; a repeated row is packed as often as it occurs; an empty table gives no sequence.
    """
    if length < 1 or length > 65535:
        raise ValueError("length has to be between 1 and 65535")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_packer(vocabulary, length, block_tokens), PACKED)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Store packed rows as parquet: a file's ``ids`` column is one matrix, row by row."""
    packed.write.parquet(path)


def matrix(table: pa.Table, length: int, column: str = "ids") -> np.ndarray:
    """The matrix of a table read from such a file; cells are as wide as they were written."""
    values = table.column(column).combine_chunks()
    data = b"".join(pc.drop_null(values).to_pylist())
    width = len(data) // max(1, len(values)) // length
    return np.frombuffer(data, np.dtype("<u2" if width == 2 else "<u4")).reshape(len(values), length)
