"""WARC archives of one gzip member per record, and a reader that splits them by byte ranges."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shared_dir

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a file at most, of a range that one task scans, of one read, and what must show the head of a record.
FILE_BYTES, SPLIT_BYTES, READ_BYTES, PROBE_BYTES = 256 << 20, 4 << 20, 1 << 20, 1024
DATE = "2024-01-01T00:00:00Z"
#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 100


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri.replace("file:/", "file:///", 1))


def record(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, compressed as a gzip member of its own. A revisit keeps the HTTP headers and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    block = http if revisit else http + html
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.translate({13: "%0D", 10: "%0A"}))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def header(data: bytes) -> dict[str, str] | None:
    """The named fields of a record's head (names in lower case), or None where data does not begin with one: a version line and whole fields.

    A head that goes on beyond data counts if what is there is one. Folded lines belong to the field before.
    """
    head, whole, _ = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not re.fullmatch(r"WARC/[0-9]+\.[0-9]+", lines[0]):
        return None
    fields: dict[str, str] = {}
    name = ""
    for line in lines[1:] if whole else lines[1:-1]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9a-z-]+", name):
            return None
        fields[name] = value.strip()
    return fields


def parse(data: bytes) -> list[dict]:
    """The records of a decompressed member: one as a rule, or several that follow each other.

    Records of any type are read: page_id and refers_to are the numbers of the names that record() gives, null for others, and
    record_id is the name itself. A record without a length takes the rest of the member. What is cut short, or goes on as
    no record, gives a row of type `broken`.
    """
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")) else None
    out = []
    while data.strip(b"\r\n") or not out:
        head, found, rest = data.partition(b"\r\n\r\n")
        fields = header(head + found) if found else None
        length = None if fields is None else (int(v) if (v := fields.get("content-length", "").strip()).isdecimal() else len(rest))
        if fields is None or length > len(rest):
            return [*out, broken()]
        block, data = rest[:length], rest[length:].lstrip(b"\r\n")
        kind, payload, full = fields.get("warc-type", "unknown"), block, len(block)
        if "application/http" in fields.get("content-type", "").lower():
            http, _, payload = block.partition(b"\r\n\r\n")
            sizes = (v.strip() for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")) if k.strip().lower() == b"content-length")
            full = next((int(v) for v in sizes if v.isdigit()), 0) if kind == "revisit" else len(payload)
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") if kind == "revisit" else hashlib.sha256(payload).hexdigest()
        out.append({"page_id": number(fields.get("warc-record-id")), "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": number(fields.get("warc-refers-to")), "payload_bytes": full, "payload_digest": digest, "payload": None if kind == "revisit" else payload})
    return out


def broken() -> dict:
    """The row of a member that begins as a record and can't be read whole."""
    return {"page_id": None, "record_id": None, "url": None, "record_type": "broken", "refers_to": None, "payload_bytes": None, "payload_digest": None, "payload": None}


def mark_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html (binary, null as empty), digest, refers_to: the smallest page_id of equal payloads of at least least_bytes, null if it is the row's own.

    Smallest ids are gathered by digest with partial sums and only where a payload repeats; the join goes over digests. Rows that
    repeat the smallest page_id are all responses; a null page_id is never the smallest while another is there.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    digests = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n")).where(F.col("n") >= least_bytes)
    first = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("count")).where("count > 1").select("digest", "first")
    return rows.join(cut(first, "first-pages"), "digest", "left").select("page_id", "url", "html", "digest", F.expr("CASE WHEN first IS NOT NULL AND NOT (page_id <=> first) THEN first END").alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write mark_revisits' rows as .warc.gz files in folder (any URI that pyarrow.fs opens); returns path and bytes of each file.

    A file is written under a name of its own task attempt and then renamed, so a task that runs again replaces its files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, base = filesystem(folder)
        disk.create_dir(base, recursive=True)
        part, out, done, size, temp = TaskContext.get().partitionId(), None, [], 0, ""

        def close() -> None:
            out.close()
            path = f"{base}/part-{part:06d}-{len(done):04d}.warc.gz"
            disk.move(temp, path)
            done.append((path, size))

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                page, url, html, digest, first = (x.as_py() for x in row)
                if out is None:
                    temp, size = f"{base}/_{uuid.uuid4().hex}", 0
                    out = disk.open_output_stream(temp)
                member = record(page, url, html, digest, first, first is not None)
                out.write(member)
                size += len(member)
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([folder.rstrip("/") + "/" + p.rsplit("/", 1)[1] for p, _ in done], pa.string()), pa.array([s for _, s in done], pa.int64())], names=["path", "bytes"])

    return cut(rows.mapInArrow(write, "path string, bytes long"), "archive-files")


class Member:
    """Reads one gzip member at a place of a file, in bounded reads."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size = file, size

    def _inflate(self, at: int, most: int | None) -> tuple[bytes, int] | None:
        unpack, out, pos = zlib.decompressobj(31), [], at
        try:
            while not unpack.eof and pos < self.size:
                self.file.seek(pos)
                data = self.file.read(PROBE_BYTES if most else READ_BYTES)
                pos += len(data)
                out.append(unpack.decompress(data, most) if most else unpack.decompress(data))
                if most and sum(map(len, out)) >= most:
                    break
        except zlib.error:
            return None
        return b"".join(out), pos - len(unpack.unused_data) if unpack.eof else -1

    def starts_record(self, at: int) -> bool:
        """Whether a member begins here and its first PROBE_BYTES decode to the head of a record."""
        got = self._inflate(at, PROBE_BYTES)
        return bool(got) and header(got[0]) is not None

    def read(self, at: int) -> tuple[bytes, int] | None:
        """The decompressed record and the place after it; None for a member that is cut short or broken."""
        got = self._inflate(at, None)
        return got if got and got[1] > 0 else None


def members(file: pa.NativeFile, size: int, start: int, end: int) -> Iterator[tuple[int, int | None, list[dict]]]:
    """(start, end, records) of each member that starts in [start, end). Gzip magic there is a candidate; it counts if it decodes to the head of a record.

    After a whole member the next candidate is where it ended; after a false one the scan goes on at the next byte, as it does after
    one that begins as a record but is broken, which has no end and one row of type `broken`.
    """
    member, at = Member(file, size), start
    while at < end:
        file.seek(at)
        data = file.read(min(READ_BYTES, end - at + len(MAGIC) - 1))
        hit = data.find(MAGIC)
        if hit < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= end:
            return
        begins = member.starts_record(at)
        got = member.read(at) if begins else None
        if got is None:
            if begins:
                yield at, None, [broken()]
            at += 1
            continue
        yield at, got[1], parse(got[0])
        at = got[1]


def records(file: pa.NativeFile, size: int, start: int, end: int, with_broken: bool = False) -> Iterator[dict]:
    """Records of the members that start in [start, end), as this range alone shows them: what lies inside a member that began before counts as well (see read_archives)."""
    for _, _, rows in members(file, size, start, end):
        yield from (r for r in rows if with_broken or r["record_type"] != "broken")


#: Columns of a record that is read.
COLUMNS = {"page_id": pa.int64(), "record_id": pa.string(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}
_PLACE = "path string, range_start long, member_start long, member_end long"
_SCHEMA = "page_id long, record_id string, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """page_id, record_id, url, record_type, refers_to, payload_bytes, payload_digest and payload of every record of files (path, bytes).

    Each file is cut to ranges of split_bytes, which are dealt to tasks. The digest of a response is computed from what was read.
    Archives of others may hold records of any type (see parse); members that can't be read whole are rows of type `broken`, so a
    count of these tells whether the result is whole.

    Deflate stores what it can't compress as it is, so an archive inside an archive shows its own members to a range that starts
    there. What starts before the end of a member of an earlier range is therefore left out: rows are written once, the farthest end
    of each range (one row a range) is carried along its file, and the few members that it covers are taken from the rows. A member
    inside another ends inside it. So every split size gives the same rows.
    """
    ranges = files.select("path", "bytes", F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {split_bytes}L)")).alias("start"))
    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    wanted = [c for c in COLUMNS if payload or c != "payload"]
    types = {"path": pa.string(), "range_start": pa.int64(), "member_start": pa.int64(), "member_end": pa.int64()} | {c: COLUMNS[c] for c in wanted}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lambda rows: pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], t) for c, t in types.items()})
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start")), strict=True):
                disk, name = filesystem(path)
                rows, held = [], 0
                with disk.open_input_file(name) as file:
                    for at, after, found in members(file, size, start, min(size, start + split_bytes)):
                        rows += (r | {"path": path, "range_start": start, "member_start": at, "member_end": after} for r in found)
                        held += sum(500 + (len(r["payload"] or b"") if payload else 0) for r in found)
                        if held >= READ_BYTES * 4:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)

    schema = f"{_PLACE}, {_SCHEMA if payload else _SCHEMA.removesuffix(', payload binary')}"
    rows = cut(ranges.repartition(n, F.xxhash64("path", "start")).mapInArrow(read, schema), "archive-rows")
    earlier = Window.partitionBy("path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    reach = rows.groupBy("path", "range_start").agg(F.max("member_end").alias("reach")).withColumn("covered", F.max("reach").over(earlier))
    inside = rows.select("path", "range_start", "member_start").join(reach, ["path", "range_start"]).where("member_start < covered")
    inside = cut(inside.select("path", "member_start").distinct(), "members-in-members")
    return rows.join(inside, ["path", "member_start"], "left_anti").select(*wanted)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder and read back page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload, a null url has no header, repeated rows are records of their own; an empty table gives no rows.
    """
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    back = read_archives(write_archives(mark_revisits(pages), folder), payload=False)
    kind = F.when(F.col("record_type") == "broken", F.raise_error(F.lit("a member of our own archives is broken"))).otherwise(F.col("record_type"))
    return back.select("page_id", "payload_bytes", "payload_digest", kind.alias("record_type"), "refers_to")
