"""Web archives: records written as plain WARC files, and a reader that salvages damaged ones.

Writing. Each row becomes a record whose block is an HTTP response with the payload. Of rows with
equal payloads of at least ``least_bytes``, the one with the largest id is the response; the others
are revisits, which hold the response's headers and digest and refer to it. Spark's text writer
writes the files, so they are as safe as any table it writes and can go to any store.

Reading. Every archive is read as a stream by one task, a record in memory at a time; archives that
:func:`write` makes are as large as a partition. A record passes if its version line, headers and
length are right, the block ends in two line ends, and its digests agree. After a failed check the
reader searches for the next version line with which a whole record passes, goes on there, and
reports the bytes between as a quarantined gap. In gzip archives it does so within each member, which
may hold any number of records; what it finds there has the start and end of the member. A member that
is cut off or fails to inflate yields the records before that, and is reported as a gap up to the next
member; if it failed, only records whose digests agree are taken from it, as damage can inflate to
wrong bytes.

Defined cases: null payloads are empty; rows without id are always responses; among rows that share
the largest id of their payload each is a response; repeated rows each give a record; empty tables
give no record; further columns are ignored; control characters in addresses are percent-encoded.
A record's block may have ``MAX_RECORD`` bytes, and so may its headers; more counts as damage.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from typing import Iterator, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from ..sources.files import arrow_location, list_files
from .common import Sink, rows_of

MAX_RECORD = 1 << 30
_CHUNK = 1 << 20
_STEP = 1 << 14
_HELD = 1 << 25
_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_MEMBER = b"\x1f\x8b\x08"

# The profile of revisits by payload, and the alphabet of digests.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hex_column: str) -> Column:
    """Upper-case base32 of a SHA-1 in hex: five hex digits are four letters."""
    number = f"CAST(conv(substring({hex_column}, g * 5 + 1, 5), 16, 10) AS INT)"
    letters = (f"transform(sequence(0, 7), g -> transform(sequence(0, 3), k -> "
               f"substring('{BASE32}', (shiftright({number}, 15 - 5 * k) & 31) + 1, 1)))")
    return F.array_join(F.flatten(F.expr(letters)), "")


def _records(pages: DataFrame, id_column: str, url_column: str, payload_column: str, least_bytes: int,
             date: str) -> DataFrame:
    """One column ``value``: the text of each record but its last line end."""
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page"), F.coalesce(F.col(url_column).cast("string"), F.lit("")).alias("uri"),
        F.coalesce(F.col(payload_column).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("warc_sha1"), F.octet_length("payload").cast("bigint").alias("size"))
    digests = rows.where((F.col("size") >= least_bytes) & F.col("page").isNotNull()).select("page", "warc_sha1", "size")
    first = digests.groupBy("warc_sha1", "size").agg(F.max("page").alias("response"), F.count(F.lit(1)).alias("rows"))
    again = (digests.join(first.where("rows > 1"), ["warc_sha1", "size"]).where("page < response")
             .select("page", "warc_sha1", "response").distinct())
    marked = rows.join(stage(again, "revisits"), ["page", "warc_sha1"], "left")

    digest = _base32("warc_sha1")
    revisit = F.col("response").isNotNull()
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit("-")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit("\r\n\r\n"))
    safe = F.regexp_replace("uri", "[\\x00-\\x20\\x7f]", "%20")
    length = F.length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), safe,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"),
                                 F.col("response").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), length.cast("string"),
        F.lit("\r\n\r\n"), http)
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return marked.select(F.concat(head.cast("binary"), body, F.lit(b"\r\n")).cast("string").alias("value"))


def write(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url",
          payload_column: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record for each row below ``path``."""
    records = _records(pages, id_column, url_column, payload_column, least_bytes, date)
    records.write.option("lineSep", "\r\n").text(path)


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def _headers(raw: bytes) -> dict[str, str] | None:
    """Fields of a header block by lower-case name; None if a line is no field."""
    out: dict[str, list[str]] = {}
    last = ""
    for line in raw.split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and last:
            out[last].append(text.strip())
            continue
        name, colon, value = text.partition(":")
        if not colon or not name or name != name.strip():
            return None
        last = name.lower()
        out.setdefault(last, [value.strip()])
    return {name: " ".join(values) for name, values in out.items()}


def payload_of(record: Record) -> tuple[dict[str, str], bytes]:
    """HTTP headers and body of a record's block; other blocks are all body."""
    if not record.headers.get("content-type", "").startswith("application/http"):
        return {}, record.block
    head, found, body = record.block.partition(b"\r\n\r\n")
    return (_headers(head.partition(b"\r\n")[2]) or {}, body) if found else ({}, record.block)


def _sha1_matches(field: str | None, data: bytes) -> bool:
    algorithm, _, value = (field or "").partition(":")
    return algorithm.lower() != "sha1" or base64.b32encode(hashlib.sha1(data).digest()).decode() == value.upper()


def _failure(record: Record) -> str | None:
    if not _sha1_matches(record.headers.get("warc-block-digest"), record.block):
        return "block digest"
    if record.headers.get("warc-type") in ("response", "resource") and not _sha1_matches(
            record.headers.get("warc-payload-digest"), payload_of(record)[1]):
        return "payload digest"
    return None


def _verified(record: Record) -> bool:
    """Whether a record that passed has a digest which says so."""
    fields = ["warc-block-digest"] + ["warc-payload-digest"] * (record.headers.get("warc-type") in ("response", "resource"))
    return any(record.headers.get(f, "").lower().startswith("sha1:") for f in fields)


class Salvage:
    """Records and gaps of one archive, from a file that can seek."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size

    def read(self) -> Iterator[tuple[int, int, Record | str]]:
        """Start, end, and the record there or the reason of a gap."""
        if self._bytes(0, 3) == _MEMBER:
            yield from self._read_members()
            return
        gap, reason, at = -1, "", 0
        while at < self.size:
            self._forget(at)
            found = self._record(at)
            if isinstance(found, str):
                if gap < 0:
                    gap, reason = at, found
                at = self._next(at + 1, False)
                continue
            if gap >= 0:
                yield gap, at, reason
                gap = -1
            end, record = found
            yield at, end, record
            at = end
        if gap >= 0:
            yield gap, self.size, reason

    def _read_members(self) -> Iterator[tuple[int, int, Record | str]]:
        """As :meth:`read`, for gzip; what lies within a member has the member's start and end."""
        gap, reason, at = -1, "", 0
        while at < self.size:
            self._forget(at)
            member = _Member(self, at)
            inner = Salvage(*member.content())
            failure, good, bad = member.failure, False, ""
            for _, stop, found in inner.read():
                if not isinstance(found, str) and failure == "gzip member" and not _verified(found):
                    found = failure  # damaged bytes can inflate to wrong ones
                if isinstance(found, str):
                    if not good:
                        bad = bad or found
                    elif not (failure and (found == failure or stop == inner.size)):  # else told by the member's gap
                        yield at, member.end, found
                    continue
                if gap >= 0:
                    yield gap, at, reason
                    gap = -1
                if bad and not good and bad != failure:
                    yield at, member.end, bad
                good = True
                yield at, member.end, found
            if failure or bad and not good:
                if gap < 0:
                    gap, reason = at, failure or bad
            elif gap >= 0:
                yield gap, at, reason
                gap = -1
            at = self._next(at + 1, True) if failure else member.end
        if gap >= 0:
            yield gap, self.size, reason

    def _forget(self, at: int) -> None:
        """Nothing before ``at`` will be read again."""
        if isinstance(self.source, _Window):
            self.source.forget(at)

    def _bytes(self, at: int, count: int) -> bytes:
        self.source.seek(at)
        return self.source.read(max(0, min(count, self.size - at)))

    def _next(self, at: int, gzip: bool) -> int:
        """Where the next version line or member begins that is at least spelled right."""
        while at < self.size:
            self._forget(at)
            chunk = self._bytes(at, _CHUNK)
            if gzip:
                found = chunk.find(_MEMBER)
            else:
                match = _VERSION.search(chunk)
                found = match.start() if match else -1
            if found >= 0:
                return at + found
            at += max(1, len(chunk) - 16)
            if at + 16 >= self.size:
                break
        return self.size

    def _record(self, at: int) -> tuple[int, Record] | str:
        head = self._bytes(at, 4096)
        if not _VERSION.match(head):
            return "version line"
        count = len(head)
        while (stop := head.find(b"\r\n\r\n")) < 0:
            if len(head) < count or count >= MAX_RECORD:
                return "header end"
            lines = head[:max(head.rfind(b"\r\n"), 0)].partition(b"\r\n")[2]
            if lines and _headers(lines) is None:
                return "header field"
            count = min(8 * max(count, 4096), MAX_RECORD)
            head = self._bytes(at, count)
        headers = _headers(head[:stop].partition(b"\r\n")[2])
        if headers is None:
            return "header field"
        length = headers.get("content-length", "")
        if not length.isascii() or not length.isdigit() or int(length) > MAX_RECORD:
            return "length"
        begin, end = at + stop + 4, at + stop + 4 + int(length)
        if end + 4 > self.size:
            return "truncated"
        data = self._bytes(begin, int(length) + 4)
        if data[-4:] != b"\r\n\r\n":
            return "record end"
        record = Record(headers, data[:-4])
        return _failure(record) or (end + 4, record)


class _Member:
    """A gzip member, inflated as a stream up to its end or to where it fails."""

    def __init__(self, archive: Salvage, at: int):
        self.archive, self.at, self.end, self.failure = archive, at, at, None

    def content(self) -> tuple:
        """A source of what can be inflated, and its size; long contents are inflated a second time while they are read."""
        kept, size = [], 0
        for piece in self.pieces():
            size += len(piece)
            if size <= _HELD:
                kept.append(piece)
            else:
                kept.clear()
        return (pa.BufferReader(b"".join(kept)) if size <= _HELD else _Window(self.pieces())), size

    def pieces(self) -> Iterator[bytes]:
        inflate, place = zlib.decompressobj(31), self.at
        while True:
            chunk = self.archive._bytes(place, _CHUNK)
            if not chunk:
                self.end, self.failure = place, "truncated"
                return
            for start in range(0, len(chunk), _STEP):
                part = chunk[start:start + _STEP]
                before = inflate.copy()
                try:
                    piece = inflate.decompress(part)
                except zlib.error:
                    yield from self._rest(before, part, place + start)
                    return
                if piece:
                    yield piece
                if inflate.eof:
                    self.end = place + start + len(part) - len(inflate.unused_data)
                    return
            place += len(chunk)

    def _rest(self, inflate, part: bytes, place: int) -> Iterator[bytes]:
        """What comes before the byte at which inflating fails."""
        for k in range(len(part)):
            self.end, self.failure = place + k, "gzip member"
            try:
                piece = inflate.decompress(part[k:k + 1])
            except zlib.error:
                return
            if piece:
                yield piece


class _Window:
    """A source over pieces, which keeps what has not been forgotten."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.first, self.at = pieces, bytearray(), 0, 0

    def forget(self, at: int) -> None:
        self._fill(at)
        del self.held[:at - self.first]
        self.first = max(self.first, at)

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, count: int) -> bytes:
        self._fill(self.at + count)
        return bytes(self.held[self.at - self.first:self.at - self.first + count])

    def _fill(self, end: int) -> None:
        while self.first + len(self.held) < end and (piece := next(self.pieces, None)) is not None:
            self.held += piece


_ROW = pa.schema([("archive", pa.string()), ("first_byte", pa.int64()), ("end_byte", pa.int64()), ("gap", pa.string()),
                  ("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
                  ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                  ("payload", pa.binary())])
_ROW_SQL = ("archive string, first_byte bigint, end_byte bigint, gap string, warc_type string, record_id string, "
            "refers_to string, target_uri string, payload_digest string, payload_bytes bigint, payload binary")


def read(spark: SparkSession, path: str, name_glob: str | None = None, with_payload: bool = True) -> DataFrame:
    """Every record and every gap below ``path``.

    ``gap`` is null for records and else the check that failed. ``payload_digest`` and
    ``payload_bytes`` are those of the payload read; for revisits, of the payload they stand for.
    """
    listed = list_files(spark, path, name_glob)
    if listed is None:
        return spark.createDataFrame([], _ROW_SQL)

    def run(batches):
        sink = Sink(_ROW)
        for (uri,) in rows_of(batches):
            filesystem, name = arrow_location(uri)
            with filesystem.open_input_file(name) as source:
                for first, end, found in Salvage(source, source.size()).read():
                    if isinstance(found, str):
                        row, weight = (uri, first, end, found, *[None] * 7), 64
                    else:
                        row, weight = (uri, first, end, None, *_fields(found, with_payload)), 512
                        weight += len(row[-1] or b"")
                    if sink.add(row, weight):
                        yield sink.flush()
        yield sink.flush()

    return listed.select("path").mapInArrow(run, _ROW_SQL)


def _fields(record: Record, with_payload: bool) -> tuple:
    http, body = payload_of(record)
    h = record.headers
    if h.get("warc-type") == "revisit":
        digest = h.get("warc-payload-digest", "").rpartition(":")[2] or None
        length = http.get("content-length", "")
        size = int(length) if length.isascii() and length.isdigit() else None
    else:
        digest, size = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
    return (h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"), digest, size,
            body if with_payload else None)
