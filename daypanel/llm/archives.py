"""WARC archives and the global order of their captures.

Writing: a record is text (UTF-8), its end the two line breaks that the format asks for, so Spark's text sink writes an
archive with that line separator, gzip-compressed, to any file system Spark knows. Of captures with equal payload the
one of the smallest id is a response; the others are revisits that name it and carry no payload.

Reading: archives are read as binary files and walked by Content-Length; payloads are hashed again. An archive is of
bounded size (``archive_bytes`` of payload on average, cut by hash of the id).

Index: each archive gives one run of captures, sorted in its task by URL key, time and id. The runs are dealt to ranges
of that order; in each range a tree of losers merges the slices of all runs. Ranges are cut by key, time and id, so a
URL with very many captures spans several of them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.sources.scratch import materialised, new_path

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
#: Digits of Spark's base 32 and of the one that archives use (fixed values).
PLAIN_32, DIGEST_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = (
    "page_id long, url_key string, captured string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, uri string, archive string, record_at long, place int"
)


def digest(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1: 160 bits are eight times twenty, and twenty bits are four digits."""
    hex_text = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hex_text, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), PLAIN_32, DIGEST_32)


def record_types(pages: DataFrame) -> DataFrame:
    """(page_id, payload_digest, refers_to) of distinct captures that repeat an earlier one."""
    rows = pages.select("page_id", "payload_digest").where("page_id is not null")
    heads = rows.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last")
    return rows.distinct().join(heads.select("payload_digest", "refers_to"), "payload_digest").where("page_id > refers_to")


def _record() -> Column:
    """A whole record but for its end. Header values keep no line breaks."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    maybe = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        maybe("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        maybe("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        line("WARC-Date", F.col("captured")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.octet_length("payload").cast("string")),
        maybe("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + CRLF)).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF), body,
    )


def write_archives(pages: DataFrame, path: str, archive_bytes: int = 16 << 20, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html; captured, an ISO time, if there is such a column) as archives below ``path``.

    A null html is an empty payload. Payloads under ``least_bytes`` are always responses. A null id is written without
    record id, always as a response; rows that repeat both id and payload are written each time with the same type.
    """
    when = F.col("captured").cast("string") if "captured" in pages.columns else F.date_format(F.timestamp_seconds(F.pmod(F.col("page_id").cast("long"), F.lit(10**9)) + F.lit(10**9)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(when, F.lit("2001-09-09T01:46:40Z")).alias("captured"), html.alias("payload"))
    rows = rows.withColumn("payload_digest", digest(F.col("payload")))
    small = rows.select("page_id", "payload_digest", F.octet_length("payload").alias("n"))
    small = materialised(small, "digests")
    total = small.agg(F.sum("n").alias("n")).first().n or 0
    again = record_types(small.where(F.col("n") >= least_bytes)).withColumnsRenamed({"page_id": "r_id", "payload_digest": "r_digest"})
    again = again.select("r_id", "r_digest", "refers_to")
    archives = max(1, -(-total // archive_bytes))
    # both sides are dealt to the archives before they are joined, so that payloads move once
    again = again.repartition(archives, "r_id", "r_digest")
    spread = rows.repartition(archives, "page_id", "payload_digest")
    spread = spread.join(again, (spread.page_id == again.r_id) & (spread.payload_digest == again.r_digest), "left")
    spread.select(_record().alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the top down, then what follows, A-Z lower-cased."""
    _, mark, rest = url.partition("://")
    if not mark:
        return url.lower()
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host) :].lower()


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an unpacked archive; raises ValueError where it is broken."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode().split(CRLF)[1:]
        headers = {k: v for k, _, v in (line.partition(": ") for line in lines)}
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} ends elsewhere")
        yield at, headers, data[start:stop]
        at = stop + 4


def _number(name: str | None) -> int | None:
    return int(name.removeprefix("<urn:page:").removesuffix(">")) if name else None


def capture_order(url: str, captured: str, page: int | None) -> tuple:
    return url, captured, page is not None, page or 0


def _captures(path: str, data: bytes) -> Iterator[tuple]:
    """Rows of INDEX but for the place."""
    for at, headers, block in records(data):
        response = headers["WARC-Type"] == "response"
        named = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        if response and base64.b32encode(hashlib.sha1(block).digest()).decode() != named:
            raise ValueError(f"payload of the record at byte {at} of {path} doesn't have its digest")
        uri = headers.get("WARC-Target-URI")
        yield (
            _number(headers.get("WARC-Record-ID")), url_key(uri or ""), headers["WARC-Date"], headers["WARC-Type"],
            _number(headers.get("WARC-Refers-To")), named, len(block) if response else int(headers["X-Payload-Length"]), uri, path, at,
        )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            parts, packed = [], content.as_py()
            while packed:  # a file may hold several gzip members
                inflate = zlib.decompressobj(31)
                parts.append(inflate.decompress(packed))
                packed = inflate.unused_data
            found = sorted(_captures(path, b"".join(parts)), key=lambda x: capture_order(x[1], x[2], x[0]))
            if found:
                columns = [*zip(*found), range(len(found))]
                arrays = [pa.array(list(values), field.type) for values, field in zip(columns, _SCHEMA)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


_SCHEMA = pa.schema([
    (name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]) for name, kind in (x.split() for x in INDEX.split(", "))
])


def read_archives(spark, path: str) -> DataFrame:
    """Captures of all archives below ``path``, each archive a sorted run."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(_runs, INDEX)


class LoserTree:
    """K-way merge of sorted lists: each inner node keeps the loser of its match, the root's winner comes out next."""

    def __init__(self, runs: list[list], key) -> None:
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.next = [0] * self.k
        self.head = [self._key(i) for i in range(self.k)]
        self.loser = [-1] * self.k
        for i in range(self.k):
            self._settle(i)

    def _key(self, i: int) -> tuple:
        run = self.runs[i] if i < len(self.runs) else []
        at = self.next[i]
        return (0, self.key(run[at]), i) if at < len(run) else (1, (), i)

    def _settle(self, i: int) -> None:
        """Play leaf i up to the root; a match that has no second player yet waits there."""
        winner, at = i, (i + self.k) // 2
        while at > 0:
            if self.loser[at] < 0:
                self.loser[at] = winner
                return
            if self.head[self.loser[at]] < self.head[winner]:
                winner, self.loser[at] = self.loser[at], winner
            at //= 2
        self.winner = winner

    def __iter__(self) -> Iterator:
        while self.head[self.winner][0] == 0:
            i = self.winner
            yield self.runs[i][self.next[i]]
            self.next[i] += 1
            self.head[i] = self._key(i)
            self._settle(i)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices that all runs have in a range. Only keys and row numbers are merged; the rows stay in Arrow."""
    slices = list(batches)
    if not slices:
        return
    table = pa.Table.from_batches(slices).combine_chunks()
    runs: dict[str, list[tuple]] = {}
    keys = [table[name].to_pylist() for name in ("archive", "url_key", "captured", "page_id")]
    for row, (archive, *key) in enumerate(zip(*keys)):
        runs.setdefault(archive, []).append((capture_order(*key), row))  # rows of a run come in the run's order
    order = [row for _, row in LoserTree([runs[name] for name in sorted(runs)], itemgetter(0))]
    for at in range(0, len(order), 5000):
        yield from table.take(order[at : at + 5000]).combine_chunks().to_batches()


def merged_histories(captures: DataFrame, range_rows: int = 50_000) -> DataFrame:
    """All captures in the order of URL key, time and id: partition by partition, and within each one."""
    stored = materialised(captures, "runs")
    ranges = max(1, -(-stored.count() // range_rows))
    order = ["url_key", "captured", F.col("page_id").isNotNull(), F.coalesce("page_id", F.lit(0))]
    dealt = stored.repartitionByRange(ranges, *order).sortWithinPartitions("archive", "place")
    return dealt.mapInArrow(_merged, INDEX)


def archived(pages: DataFrame, path: str | None = None, **settings) -> DataFrame:
    """Write ``pages`` as archives, read them back, and return the merged capture histories."""
    path = path or new_path(pages.sparkSession, "archives")
    write_archives(pages, path, **settings)
    return merged_histories(read_archives(pages.sparkSession, path))
