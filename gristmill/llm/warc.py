"""WARC archives: a writer with one gzip member a record, and a reader that salvages what follows damaged bytes."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gristmill.llm.common import durable, shared_path

CHUNK = 1 << 18
#: A new archive begins when one holds so many bytes.
ARCHIVE_BYTES = 128 << 20
#: Larger records, and records of larger heads, are quarantined when archives are read.
RECORD_BYTES, HEAD_BYTES = 1 << 30, 1 << 20
#: Rows of a payload that many pages share are dealt over so many tasks.
SALTS = 16
_VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
_LENGTH = re.compile(rb"[0-9]{1,18}")
_GZIP, _LINE, _BLANK = b"\x1f\x8b\x08", b"\nWARC/", b"\r\n\r\n"
#: A member's head as writers make it: no reserved flags, a known level and system. Only such heads are searched for.
_HEAD = re.compile(rb"\x1f\x8b\x08[\x00-\x1f].{4}[\x00\x02\x04][\x00-\x0d\xff]", re.S)
_SAME_PAYLOAD = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_text(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, is_revisit: bool = False, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record with an HTTP response block; a revisit keeps the HTTP head alone, with the payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_header_text(url)}"] if url is not None else []),
        *([f"WARC-Profile: {_SAME_PAYLOAD}"] if is_revisit else []),
        *([f"WARC-Refers-To: <urn:page:{refers_to}>"] if is_revisit and refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP head, or the block where there is none."""
        if self.block.startswith(b"HTTP/"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


@dataclass
class Gap:
    """Quarantined bytes ``start`` to ``end`` of an archive; within a member of several records, the bytes ``inside`` of
    what it inflates to."""

    start: int
    end: int
    reason: str
    inside: tuple[int, int] | None = None


class BadRecord(ValueError):
    pass


@dataclass
class _Window:
    """A seekable file behind a buffer that holds the bytes from ``start`` on."""

    file: BinaryIO
    start: int = 0
    data: bytearray = field(default_factory=bytearray)
    ended: bool = False
    found: dict[bytes | re.Pattern, tuple[int, int, bool]] = field(default_factory=dict)

    def find(self, what: bytes | re.Pattern, begin: int = 0) -> int:
        """Where ``what`` begins next in the window, or -1. No byte is searched twice."""
        at = self.start + begin
        low, high, hit = self.found.get(what, (0, -1, False))  # the next one is not before ``high``
        if not low <= at <= high:
            low, high, hit = at, at, False
        if not hit:
            if isinstance(what, bytes):
                k, size = self.data.find(what, high - self.start), len(what)
            else:
                m = what.search(self.data, high - self.start)
                k, size = m.start() if m else -1, 10
            hit = k >= 0
            high = self.start + k if hit else max(high, self.start + len(self.data) - size + 1)
        self.found[what] = low, high, hit
        return high - self.start if hit else -1

    def need(self, n: int) -> bool:
        """Whether ``n`` bytes are there, after reading on."""
        while len(self.data) < n and not self.ended:
            more = self.file.read(max(CHUNK, n - len(self.data)) if n - len(self.data) < 1 << 26 else CHUNK)
            self.ended = not more
            self.data += more
        return len(self.data) >= n

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.start += n

    def at(self, place: int, n: int) -> bytes:
        """``n`` bytes from ``place`` on, counted from the window's start, without reading what lies between."""
        if len(self.data) >= place + n or self.ended:
            return bytes(self.data[place : place + n])
        here = self.file.tell()
        self.file.seek(self.start + place)
        found = self.file.read(n)
        self.file.seek(here)
        return found


def parse_record(data: bytes, offset: int = 0) -> Record:
    """The record that ``data`` holds from its first to its last byte, with lengths and digests checked."""
    if not _VERSION.match(data):
        raise BadRecord("no version line")
    head, cut, rest = data.partition(b"\r\n\r\n")
    if not cut:
        raise BadRecord("header without end")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord("broken header line")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not _LENGTH.fullmatch((length := headers.get("content-length", "")).encode("utf-8")):
        raise BadRecord("no content length")
    n = int(length)
    if len(rest) < n:
        raise BadRecord("record cut short")
    if rest[n:] != b"\r\n\r\n":
        raise BadRecord("no end of record")
    record = Record(offset, headers, bytes(rest[:n]))
    check_digests(record)
    return record


def check_digests(record: Record) -> None:
    digest = record.headers.get("warc-block-digest", "")
    if digest.lower().startswith("sha1:") and digest[5:].upper() != base32_sha1(record.block):
        raise BadRecord("block digest differs")
    digest = record.headers.get("warc-payload-digest", "")
    if record.headers.get("warc-type") == "response" and digest.lower().startswith("sha1:") and digest[5:].upper() != base32_sha1(record.payload):
        raise BadRecord("payload digest differs")


def _inflate(unpack, piece: bytes) -> tuple[bytes, bool]:
    """What ``piece`` inflates to, up to the damage if there is any, and whether there is."""
    held = unpack.copy()
    try:
        return unpack.decompress(piece), False
    except zlib.error:
        pass
    out, low, high = [], 0, len(piece)  # bytes before ``low`` are fed, those before ``high`` hold the damage
    while high - low > 1:
        middle, tried = (low + high) // 2, held.copy()
        try:
            out.append(tried.decompress(piece[low:middle]))
            held, low = tried, middle
        except zlib.error:
            high = middle
    return b"".join(out), True


def _member(w: _Window, max_bytes: int) -> tuple[bytes, int, str]:
    """The data of the gzip member at the window's start, the member's length, and why it breaks off (empty: it doesn't).

    What a damaged member has inflated to before the damage is its data."""
    unpack, out, used, n, step = zlib.decompressobj(31), [], 0, 0, 64
    while not unpack.eof:
        if not w.need(used + 1):
            return b"".join(out), used, "member cut short"
        piece = bytes(w.data[used : used + step])
        if used:
            got, damaged = _inflate(unpack, piece)
        else:  # so few bytes hold no record
            try:
                got, damaged = unpack.decompress(piece), False
            except zlib.error:
                return b"", 0, "damaged member"
        out.append(got)
        n += len(got)
        used += len(piece) - len(unpack.unused_data)
        step = min(2 * step, CHUNK)
        if damaged or not n and used > 4096:  # heads of members are short
            return b"".join(out), used, "damaged member"
        if n > max_bytes:
            return b"".join(out), used, "member too large"
    return b"".join(out), used, ""


def _plain(w: _Window, max_bytes: int) -> tuple[Record, int]:
    """The record at the window's start in an archive that isn't compressed, and its length."""
    w.need(32)
    if not _VERSION.match(w.data):
        raise BadRecord("no version line")
    end, seen = -1, 1
    while end < 0:
        if not w.need(seen + 1) or seen > HEAD_BYTES:
            raise BadRecord("header without end")
        end, other = w.find(_BLANK), w.find(_LINE, 1)
        if 0 <= other < (end if end >= 0 else len(w.data)):  # another record begins
            raise BadRecord("header without end")
        seen = len(w.data)
    m = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", bytes(w.data[: end + 2]))
    if not m or not _LENGTH.fullmatch(m[1]):
        raise BadRecord("no content length")
    n = end + 4 + int(m[1]) + 4
    if n > max_bytes:
        raise BadRecord("record too large")
    if w.at(n - 4, 4) != b"\r\n\r\n":  # a false length is found out before so much is read
        raise BadRecord("no end of record")
    if not w.need(n):
        raise BadRecord("record cut short")
    return parse_record(bytes(w.data[:n]), w.start), n


def _resume(w: _Window, packed: bool) -> None:
    """Moves on to the next byte at which a member (where ``packed``) or a version line begins, or to the end."""
    w.drop(min(1, len(w.data)))
    while True:
        w.need(CHUNK)
        if w.data.startswith(b"WARC/"):
            return
        line, head = w.find(_LINE), w.find(_HEAD) if packed else -1
        if line >= 0 and (head < 0 or line < head):
            w.drop(line + 1)
            return
        if head >= 0:
            w.drop(head)
            return
        if w.ended:
            w.drop(len(w.data))
            return
        w.drop(max(0, len(w.data) - 10))


def _inside(data: bytes, at: int, used: int, fault: str) -> Iterator[Record | Gap]:
    """What can be read of a member that isn't one record: its records, at the member's place, and the gaps in its data.

    A record that ends just where a damaged member breaks off goes with the damage."""
    data = data[:-1] if fault else data
    for x in _read(_Window(io.BytesIO(data)), len(data), False):
        if isinstance(x, Record):
            x.offset = at
            yield x
        elif not fault or x.end < len(data):  # the last gap of a damaged member is the damage itself
            yield Gap(at, at + used, x.reason, (x.start, x.end))


def _to_first_record(found: Iterator[Record | Gap]) -> Iterator[Record | Gap]:
    """The gaps that come first, and the first record if there is one."""
    for x in found:
        yield x
        if isinstance(x, Record):
            return


def _read(w: _Window, max_bytes: int, packed: bool) -> Iterator[Record | Gap]:
    bad: tuple[int, str] | None = None
    while w.need(1):
        at, found, fault = w.start, [], ""
        try:
            if packed and w.need(3) and w.data.startswith(_GZIP):
                data, used, fault = _member(w, max_bytes)
                try:
                    if fault:
                        raise BadRecord(fault)
                    found = [parse_record(data, at)]
                except BadRecord as e:
                    inside = _inside(data, at, used, fault)
                    begun = [*_to_first_record(inside)]
                    if not begun or isinstance(begun[-1], Gap):  # gaps count only beside a record
                        raise BadRecord(str(e)) from None
                    found = chain(begun, inside)
            else:
                record, used = _plain(w, max_bytes)
                found = [record]
        except BadRecord as e:
            bad = bad or (at, str(e))
            _resume(w, packed)
            continue
        if bad:
            yield Gap(bad[0], at, bad[1])
            bad = None
        yield from found
        if fault:
            bad = (at, fault)
            _resume(w, packed)
        else:
            w.drop(used)
    if bad:
        yield Gap(bad[0], w.start, bad[1])


def salvage(file: BinaryIO, max_bytes: int = RECORD_BYTES) -> Iterator[Record | Gap]:
    """Records of an archive, compressed by member or as a whole, or plain, and the gaps between them.

    A record that fails a check is quarantined: reading goes on at the next member or version line that holds a valid
    record, and the bytes between are one gap with the first failure as reason, whatever the bytes are. A member of
    several records is read on inside what it inflates to, with gaps there, and a damaged one up to the damage; the
    search then goes on behind its first byte. An empty file gives nothing. A record of over ``max_bytes``, or with a head
    of over HEAD_BYTES where it isn't compressed, is quarantined as well, and of a member no more is inflated; memory is
    bounded by it. ``file`` is seekable.
    """
    yield from _read(_Window(file), max_bytes, True)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and path of a URI (file, hdfs, s3, gs) or of a path of a mounted shared folder."""
    if re.match("[a-z0-9+.-]+://", path):
        return fs.FileSystem.from_uri(path)
    return fs.FileSystem.from_uri("file://" + path.removeprefix("file:"))


MANIFEST = StructType([StructField("path", StringType()), StructField("records", LongType()), StructField("bytes", LongType())])


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with ``first_id``: the smallest page_id among equal payloads of ``min_bytes`` or more.

    A null html is an empty payload. The ids are gathered by digest with map-side combining; a hot digest is one row.
    Only digests of several rows are joined, in SALTS copies each, so that the rows of a hot one go to many tasks.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    firsts = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1").select("digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    return rows.join(firsts, ["digest", "salt"], "left").drop("digest", "salt")


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Writes ``marked`` (page_id, url, payload, first_id) to archives under ``folder``; returns their manifest.

    Every task writes files of its own name and reports them; the manifest, kept in the shared folder, names those of
    the tasks that counted, so a task that runs again after a lost executor leaves no record twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        done, out, path, n, size = [], None, "", 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if out is None:
                        path, n, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(path, compression=None)
                    first = row["first_id"]
                    again = first is not None and row["page_id"] != first
                    member = gzip_member(make_record(row["page_id"], row["url"], row["payload"], first if again else None, again))
                    out.write(member)
                    n, size = n + 1, size + len(member)
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        done.append((path, n, size))
                        out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], MANIFEST.names)

    return durable(marked.select("page_id", "url", "payload", "first_id").mapInArrow(run, MANIFEST))


READ = StructType([
    StructField("page_id", LongType()),
    StructField("payload_bytes", LongType()),
    StructField("payload_digest", StringType()),
    StructField("record_type", StringType()),
    StructField("refers_to", LongType()),
    StructField("path", StringType()),
    StructField("offset", LongType()),
    StructField("gap_end", LongType()),
    StructField("reason", StringType()),
])


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", urn or "")
    return int(m[1]) if m and -(1 << 63) <= int(m[1]) < 1 << 63 else None


def read_archives(manifest: DataFrame, folder: str, strict: bool = False) -> DataFrame:
    """Records of the archives that ``manifest`` names, and one row of record_type ``gap`` for each quarantined range.
    With ``strict``, a gap fails the job.

    The manifest has a partition for each task that wrote, so that archives are read by as many tasks.

    Responses have the length and digest of the payload that was read; revisits those that the record states.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with store.open_input_file(path) as file:
                    for x in salvage(file):
                        if isinstance(x, Gap):
                            if strict:
                                raise ValueError(f"{path}: bytes {x.start} to {x.end}: {x.reason}")
                            rows.append((None, None, None, "gap", None, path, x.start, x.end, x.reason))
                        else:
                            kind = x.headers.get("warc-type", "")
                            stated = re.search(rb"(?i)\r\ncontent-length: *([0-9]{1,18})\r?", x.block.partition(b"\r\n\r\n")[0])
                            n, digest = (len(x.payload), base32_sha1(x.payload)) if kind != "revisit" else (int(stated[1]) if stated else None, x.headers.get("warc-payload-digest", "").partition(":")[2] or None)
                            rows.append((_page(x.headers.get("warc-record-id")), n, digest, kind, _page(x.headers.get("warc-refers-to")), path, x.offset, None, None))
                        if len(rows) >= 5000:
                            yield _rows(rows)
                            rows = []
                yield _rows(rows)

    return manifest.select("path").mapInArrow(run, READ)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], READ.names)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes every row of ``pages`` as a WARC record under the shared folder and reads the archives back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, a row for each row. A null html is an empty
    payload, a null url is left out of the record, a null page_id is written and read as such and revisits nothing
    unless another row has its payload; rows that repeat a response's page_id and payload are responses as well. Very
    long pages are whole records up to RECORD_BYTES; a larger one, or a record that can't be read back, fails the job
    rather than vanish. Other columns are ignored, an empty table gives no rows.
    """
    folder = shared_path(pages.sparkSession, "warc")
    manifest = write_archives(mark_revisits(pages, min_bytes), folder)
    return read_archives(manifest, folder, strict=True).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
