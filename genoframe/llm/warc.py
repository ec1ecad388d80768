"""WARC archives: a writer with revisit records, and a reader that salvages what it can of damaged archives."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.shared import partitions
from genoframe.scratch import own_folder, written

VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes read from an archive, and bytes unpacked, at a time.
CHUNK, UNPACKED = 1 << 16, 1 << 20
#: A record's stated length beyond which its end is looked at before its bytes are held.
PROBED = 1 << 24
#: Most bytes of a record: what a value of a table can hold.
MOST_BYTES = (1 << 31) - (1 << 20)
#: Bytes of archives, about, that a task reads.
TASK_BYTES = 128 << 20
_URN = "urn:genoframe:page:"


def digest_of(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header."""
        return self.block.partition(b"\r\n\r\n")[2]


@dataclass
class Gap:
    """Bytes of an archive that hold no valid record.

    start and length are places in the archive. Where a member goes on after what is lost, they are the member's,
    and inner_start and inner_bytes say which of its unpacked bytes are lost (inner_bytes: None if unknown).
    """

    start: int
    length: int
    reason: str
    inner_start: int | None = None
    inner_bytes: int | None = None


class Damaged(Exception):
    """A check has failed."""


class BadMember(Damaged):
    """A member cannot be unpacked any further, or its checksum differs."""


def record(page_id: int | None, url: str | None, payload: bytes, kind: str = "response", refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A WARC record in bytes. A revisit holds the HTTP header alone, which states the full payload's length."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += payload if kind == "response" else b""
    name = uuid.uuid4().urn if page_id is None else f"{_URN}{page_id}"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"WARC-Block-Digest: sha1:{digest_of(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines.append(f"WARC-Refers-To: <{_URN}{refers_to}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """data as a gzip member of its own."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{_URN}(-?\d+)>", urn or "")
    return int(found[1]) if found else None


class _Plain:
    """Bytes of a file by their places."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def take(self, start: int, n: int) -> bytes:
        """n bytes from start on; fewer at the end."""
        self.file.seek(start)
        return self.file.read(min(n, max(0, self.size - start)))

    def holds(self, end: int) -> bool:
        return end <= self.size

    def forget(self, before: int) -> None:
        """Bytes before that place are not asked for again."""


class _Member:
    """Unpacked bytes of the gzip member that begins at `at`, held from the place that was last said to be needed."""

    def __init__(self, raw: _Plain, at: int, unpack=None):
        self.raw, self.at, self.unpack = raw, at, unpack or zlib.decompressobj(31)
        self.base, self.held, self.broken = 0, bytearray(), None

    def _more(self) -> bool:
        """Unpack some more; False at the member's end."""
        if self.unpack.eof:
            return False
        if self.broken:
            raise self.broken
        data = self.unpack.unconsumed_tail
        if not data:
            data = self.raw.take(self.at, CHUNK)
            self.at += len(data)
        if not data:
            self.broken = BadMember("member is cut off")
            raise self.broken
        before = self.unpack.copy()
        try:
            self.held += self.unpack.decompress(data, UNPACKED)
        except zlib.error as e:
            # What the bytes before the fault unpack to.
            self.broken = BadMember(str(e))
            try:
                for i in range(len(data)):
                    self.held += before.decompress(data[i : i + 1])
            except zlib.error:
                pass
        return True

    def take(self, start: int, n: int) -> bytes:
        """n bytes from start on; fewer where the member ends or cannot be unpacked further, but then at least one."""
        try:
            while self.base + len(self.held) < start + n and self._more():
                pass
        except BadMember:
            if self.base + len(self.held) <= start:
                raise
        return bytes(self.held[start - self.base : start - self.base + n])

    def holds(self, end: int) -> bool:
        """Whether there are bytes up to `end`, without holding them."""
        if self.base + len(self.held) >= end:
            return True
        ahead = _Member(self.raw, self.at, self.unpack.copy())
        ahead.base = self.base + len(self.held)
        try:
            while ahead.base + len(ahead.held) < end:
                ahead.forget(ahead.base + len(ahead.held))
                if not ahead._more():
                    return False
        except BadMember:
            return False
        return True

    def forget(self, before: int) -> None:
        del self.held[: before - self.base]
        self.base = max(self.base, before)

    def end(self) -> int:
        """Where the archive goes on after the member, all of which is unpacked for that and its checksum looked at."""
        while self._more():
            self.forget(self.base + len(self.held))
        return self.at - len(self.unpack.unused_data)


class SalvageReader:
    """Iterates over the valid records of an archive, plain or in gzip members of one or many records; gaps has the rest.

    Where a check fails (version line, header, length, end of record, block digest), what follows is searched for
    the next version line from which a whole valid record can be read: in the archive, or in the unpacked bytes of
    the member, if it goes on. Where a member cannot be unpacked any further, the archive is searched for the next
    member or version line with a valid record. What lies between becomes a gap. Records before a fault count if
    their block digests hold. A record without a digest counts only if its whole member is sound, and a member's
    last record only if the member ends soundly, or goes on with a version line.

    file: anything with seek() and read(). About one record is held in memory at a time; a stated length is
    believed only if there are as many bytes, and a record over MOST_BYTES is a gap.
    """

    def __init__(self, file):
        self.gaps: list[Gap] = []
        self.size = file.seek(0, 2) or file.tell()
        self.raw = _Plain(file, self.size)

    # -- one record ---------------------------------------------------------------------------------------

    def _header(self, source, start: int) -> bytes:
        """The header that begins there, without its blank line, however long it is. Its lines are looked at as they come."""
        n, seen = 1 << 12, 0
        while True:
            head = source.take(start, n)
            if not head.startswith(VERSION):
                raise Damaged("no version line")
            end = head.find(b"\r\n\r\n", max(0, seen - 3))
            lines = head[: end if end >= 0 else len(head)].split(b"\r\n")
            # The last line may go on.
            if re.search(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]", head[: end if end >= 0 else len(head)]):
                raise Damaged("bad header")
            for line in lines[1:] if end >= 0 else lines[1:-1]:
                if b":" not in line and line[:1] not in (b" ", b"\t"):
                    raise Damaged("bad header")
            if len(lines[0]) > 16:
                raise Damaged("no version line")
            if end >= 0:
                return head[:end]
            if len(head) < n:
                raise Damaged("no end of header")
            seen, n = len(head), 4 * n

    def _record(self, source, start: int) -> tuple[Record, int]:
        """The record that begins there, and where it ends."""
        head = self._header(source, start)
        try:
            lines = head.decode().split("\r\n")
            headers: dict[str, str] = {}
            for line in lines[1:]:
                if line[:1] in (" ", "\t") and headers:
                    last = next(reversed(headers))
                    headers[last] = f"{headers[last]} {line.strip()}"
                else:
                    key, _, value = line.partition(":")
                    headers[key.strip().lower()] = value.strip()
            n = int(headers["content-length"])
        except (UnicodeDecodeError, KeyError, ValueError) as e:
            raise Damaged("bad header") from e
        at = start + len(head) + 4
        if n < 0 or n > MOST_BYTES or (n > PROBED and not source.holds(at + n + 4)):
            raise Damaged("bad length")
        data = source.take(at, n + 4)
        if len(data) != n + 4 or data[n:] != b"\r\n\r\n":
            raise Damaged("bad length")
        stated = headers.get("warc-block-digest", "")
        block = data[:n]
        if stated.startswith("sha1:") and stated[5:] != digest_of(block):
            raise Damaged("block digest differs")
        return Record(headers, block), at + n + 4

    # -- members ------------------------------------------------------------------------------------------

    def _sound(self, start: int) -> bool:
        """Whether the member unpacks to its end and its checksum holds."""
        try:
            _Member(self.raw, start).end()
        except Damaged:
            return False
        return True

    def _within(self, start: int) -> Iterator[Record]:
        """The records of the member there; sets self.after, self.inner and self.lost. A fault of the member itself is raised."""
        member, at, held, sound = _Member(self.raw, start), 0, None, None
        self.after, self.inner, self.lost = None, None, []

        def usable(one: Record) -> bool:
            nonlocal sound
            if one.headers.get("warc-block-digest", "").startswith("sha1:"):
                return True
            if sound is None:
                sound = self._sound(start)
            return sound

        while member.take(at, 1):
            try:
                one, end = self._record(member, at)
                if not usable(one):
                    raise Damaged("no digest in a bad member")
            except Damaged as damage:
                if held and member.take(at, len(VERSION)) == VERSION:
                    self.inner = at
                    yield held
                    held = None
                nxt = self._next_inside(member, at + 1)
                self.lost.append((at, nxt - at, str(damage)))
                at = nxt
                continue
            if held:
                self.inner = at
                yield held
            held, at = one, end
            member.forget(at)
        self.after = member.end()
        if held:
            yield held

    def _next_inside(self, member: _Member, at: int) -> int:
        """The next place in the member's unpacked bytes at which a valid record begins, or their end."""
        while data := member.take(at, CHUNK + 8):
            for m in re.finditer(rb"WARC/1\.", data):
                if m.start() < CHUNK:
                    try:
                        self._record(member, at + m.start())
                        return at + m.start()
                    except Damaged:
                        continue
            at += min(CHUNK, len(data))
            member.forget(at)
        return at

    # -- the archive --------------------------------------------------------------------------------------

    def _valid_at(self, start: int) -> bool:
        """Whether a valid record can be read from there on."""
        try:
            if self.raw.take(start, 3) == GZIP:
                return next(self._within(start), None) is not None
            self._record(self.raw, start)
            return True
        except Damaged:
            return False

    def _next(self, start: int) -> int:
        """The next place at which a member or a version line with a valid record begins, or the archive's end."""
        while start < self.size:
            data = self.raw.take(start, CHUNK + 8)
            for m in re.finditer(rb"\x1f\x8b\x08|WARC/1\.", data):
                if m.start() < CHUNK and self._valid_at(start + m.start()):
                    return start + m.start()
            start += CHUNK
        return self.size

    def __iter__(self) -> Iterator[Record]:
        at = 0
        while at < self.size:
            self.inner, self.lost, reason = None, [], None
            try:
                if self.raw.take(at, 3) == GZIP:
                    yield from self._within(at)
                    after = self.after
                else:
                    one, after = self._record(self.raw, at)
                    yield one
            except Damaged as damage:
                reason, inner, lost = str(damage), self.inner, self.lost
                after = self._next(at + 1)
                self.inner, self.lost = inner, lost
            self.gaps += [Gap(at, after - at, why, k, n) for k, n, why in self.lost]
            if reason:
                self.gaps.append(Gap(at, after - at, reason, self.inner))
            at = after


def typed(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, kind, refers_to): of equal payloads of at least min_bytes that with the largest page_id is the response.

    Only digests and ids are grouped. Rows that share the largest id are all responses; a null id counts as
    the smallest. A null html is empty.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha1("payload")), "n": F.octet_length("payload")})
    last = rows.groupBy("digest", "n").agg(F.max("page_id").alias("last")).select(F.col("digest").alias("ld"), F.col("n").alias("ln"), F.xxhash64("digest").alias("lh"), "last")
    rows = rows.withColumn("h", F.xxhash64("digest")).join(last, (F.col("digest") == F.col("ld")) & (F.col("n") == F.col("ln")) & (F.col("h") == F.col("lh")), "left")
    again = (F.col("n") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.select("page_id", "url", "payload", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("last")).alias("refers_to"))


def write(records: DataFrame, folder: str, archive_bytes: int = 32 << 20, compress: bool = True) -> DataFrame:
    """Write (page_id, url, payload, kind, refers_to) as archives into the folder; the manifest: (path, records, bytes).

    A task writes its archives under names of its own and states them when they are whole, so what a lost or
    repeated task leaves behind is in no manifest. folder: any URI that pyarrow.fs opens on every executor.
    """

    def run(batches):
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, done, n, size = None, [], 0, 0
        for batch in batches:
            for page_id, url, payload, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{root}/{uuid.uuid4().hex}.warc{'.gz' if compress else ''}"
                    out, n, size = files.open_output_stream(name, compression=None), 0, 0
                data = record(page_id, url, payload, kind, refers_to)
                data = member(data) if compress else data
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "records", "bytes"])

    return written(records.select("page_id", "url", "payload", "kind", "refers_to").mapInArrow(run, "path string, records long, bytes long")).withColumn("folder", F.lit(folder))


READ_SCHEMA = "path string, page_id long, url string, kind string, payload binary, payload_bytes long, payload_digest string, refers_to long, gap_start long, gap_bytes long, gap_reason string, gap_inner_start long, gap_inner_bytes long"


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of archives(path, folder), and a row with gap_* alone for each gap.

    payload_bytes and payload_digest are of the full payload: taken from the payload itself where the record
    holds it, else as stated by the revisit. payloads: whether to return the payloads themselves.
    """

    def row(path, r: Record):
        kind, payload = r.headers.get("warc-type"), r.payload
        if kind == "revisit":
            n = re.search(rb"(?im)^content-length:\s*(\d+)", r.block)
            size, digest, payload = int(n[1]) if n else None, r.headers.get("warc-payload-digest", "").removeprefix("sha1:"), None
        else:
            size, digest = len(payload), digest_of(payload)
        return path, page_of(r.headers.get("warc-record-id")), r.headers.get("warc-target-uri"), kind, payload if payloads else None, size, digest, page_of(r.headers.get("warc-refers-to")), *[None] * 5

    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = [f.split()[0] for f in READ_SCHEMA.split(", ")]
    table = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    def run(batches):
        for batch in batches:
            for path, folder in zip(*(c.to_pylist() for c in batch.columns)):
                files, _ = pa.fs.FileSystem.from_uri(folder)
                with files.open_input_file(path) as file:
                    reader, rows, held = SalvageReader(file), [], 0
                    for r in reader:
                        rows.append(row(path, r))
                        held += len(r.block) if payloads else 100
                        if held > 8 << 20:
                            yield table(rows)
                            rows, held = [], 0
                    rows += [(path, *[None] * 7, g.start, g.length, g.reason, g.inner_start, g.inner_bytes) for g in reader.gaps]
                    yield table(rows)

    return archives.select("path", "folder").mapInArrow(run, READ_SCHEMA)


def spread(manifest: DataFrame) -> DataFrame:
    """The archives of a manifest dealt evenly over tasks: one for each TASK_BYTES, or as many as the session shuffles
    to, if that is more, but none without an archive. A row of a manifest is small, so its size says nothing of the work."""
    size, archives = manifest.agg(F.sum("bytes"), F.count("*")).first()
    tasks = min(archives, max(partitions(manifest.sparkSession), math.ceil((size or 0) / TASK_BYTES)))
    return manifest.coalesce(1).repartition(max(1, tasks))


def archived(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write a record for each page into a new folder of the shared one and read the archives back.

    Null html: empty payload. Null url: no target URI. A null page_id stays null. An empty table writes no
    archive and returns no rows. Other columns are not looked at.
    """
    return read(spread(write(typed(pages, min_bytes), f"{own_folder(spark)}/warc-{uuid.uuid4().hex}")), payloads=False)


# The digits of base32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: What archived() returns, in SQL: five hexadecimal digits of the SHA-1 are four of base32.
ARCHIVED_SQL = f"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, html, max(page_id) over (partition by html) as last,
  list_transform(range(0, 8), lambda k: cast('0x' || substr(sha1(html), 5 * k + 1, 5) as bigint)) as parts from p)
select page_id, strlen(html) as payload_bytes,
  array_to_string(list_transform(parts, lambda x: substr('{_BASE32}', ((x >> 15) & 31) + 1, 1) || substr('{_BASE32}', ((x >> 10) & 31) + 1, 1) || substr('{_BASE32}', ((x >> 5) & 31) + 1, 1) || substr('{_BASE32}', (x & 31) + 1, 1)), '') as payload_digest,
  case when page_id is distinct from last then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from last then last end as refers_to
from d"""
