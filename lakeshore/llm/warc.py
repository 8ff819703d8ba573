"""Operator 2: legacy ARC archives to WARC.

`write_arc` packs pages into ARC archives (URL-record header lines of version
1 or 2, a declared length for each record; if no version is asked for, the
archives of a task take turns, and so do the first ones of neighbouring tasks). `convert` parses them by the rules
of the version that the archive's first record states, and synthesises for
each record a WARC one: a name-based identifier, an ISO timestamp from the
14-digit one, the record type and SHA-1 digests. Of equal payloads the one
with the smallest page id is a `response`; the others are `revisit` records
that refer to it and hold the HTTP header only. `read_warc` parses the result.

Archives are files of gzip members, one for each record, at most
`ARCHIVE_BYTES` of payload or `ARCHIVE_RECORDS` records (one record may be
larger alone), so a task streams through them. They lie in the shared
checkpoint folder. A file's name is new for every attempt of a task, and the
manifest, a Parquet table, names those of the attempts that counted; files of
lost attempts are never read.

Defined results: null html counts as empty, null url as `dns:unknown`; a
record needs a page id, rows whose page_id is null are written and read like
others, with an id that is null again and never the smallest. Rows that repeat
a page_id are records of their own, told apart by archive and offset. Payloads
of any length are one record. An empty table gives no rows; extra columns are
left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from typing import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stage_dir, staged

ARCHIVE_BYTES = 8_000_000
ARCHIVE_RECORDS = 4_000
#: Crawl time of pages, which the table lacks; 14 digits as in ARC files.
CRAWLED = "20260101000000"
MANIFEST = "path string, records bigint, bytes bigint"
SPLIT = 64

#: The version blocks of the ARC format's first record, with the fields of a URL-record line.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
VERSIONS = tuple(ARC_FIELDS)


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- files -----------------------------------------------------------------

class Archive:
    """A new archive file; every record is a gzip member."""

    def __init__(self, folder: str, suffix: str):
        self.fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.path = f"{folder}/{self.name}"
        self.out = self.fs.open_output_stream(f"{root}/{self.name}")
        self.offset = self.records = self.bytes = 0

    def add(self, record: bytes, counted: bool = True) -> None:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = z.compress(record) + z.flush()
        self.out.write(member)
        self.offset += len(member)
        self.records += counted
        self.bytes += len(record)

    @property
    def full(self) -> bool:
        return self.bytes >= ARCHIVE_BYTES or self.records >= ARCHIVE_RECORDS

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def members(path: str) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of a file, streamed."""
    fs, name = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_input_stream(name) as f:
        offset, raw = 0, b""
        while raw or (raw := f.read(1 << 20)):
            z, parts, used = zlib.decompressobj(31), [], 0
            while True:
                parts.append(z.decompress(raw))
                used += len(raw) - len(z.unused_data)
                raw = z.unused_data
                if z.eof:
                    break
                if not (raw := f.read(1 << 20)):
                    raise ValueError(f"{path}: the gzip member at {offset} is cut off")
            yield offset, b"".join(parts)
            offset += used


def _manifest(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["path", "records", "bytes"])


def _spread(manifest: DataFrame) -> DataFrame:
    """Archives dealt evenly over tasks: a row is a whole file's work."""
    n = manifest.count()
    parts = max(1, min(n, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.repartition(parts, "path")


# --- ARC -------------------------------------------------------------------

def arc_first(version: str, name: str) -> bytes:
    body = f"{version} 0 lakeshore\n{ARC_FIELDS[version]}\n\n"
    line = f"filedesc://{name} 0.0.0.0 {CRAWLED} text/plain "
    line += f"200 - - 0 {name} " if version == "2" else ""
    return f"{line}{len(body)}\n{body}".encode()


def arc_record(version: str, name: str, offset: int, page_id: int | None, url: str | None, html: str | None) -> bytes:
    """A URL record: the header line of the version, then the HTTP response of the declared length."""
    payload = (html or "").encode("utf-8", "replace")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
    head += f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    content = f"{head}\r\n".encode() + payload
    where = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "dns:unknown"
    line = f"{where} 0.0.0.0 {CRAWLED} text/html "
    line += f"200 {digest32(content)} - {offset} {name} " if version == "2" else ""
    return f"{line}{len(content)}\n".encode() + content + b"\n"


def parse_arc(path: str) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, header fields, content) of the URL records of an ARC file, by the version that its first record states."""
    fields = None
    for offset, raw in members(path):
        line, _, rest = raw.partition(b"\n")
        parts = line.decode().split(" ")
        if fields is None:
            version = rest.split(b" ", 1)[0].decode()
            if not parts[0].startswith("filedesc://") or version not in ARC_FIELDS:
                raise ValueError(f"{path}: no ARC file of version 1 or 2")
            fields = ARC_FIELDS[version].split(" ")
            continue
        if len(parts) != len(fields):
            raise ValueError(f"{path}: {len(parts)} header fields at {offset}; version {version} has {len(fields)}")
        header = dict(zip(fields, parts))
        size = int(header["Archive-length"])
        if len(rest) < size:
            raise ValueError(f"{path}: the record at {offset} declares {size} bytes and has {len(rest)}")
        yield offset, header, rest[:size]


def write_arc(pages: DataFrame, version: str | None = None) -> DataFrame:
    """Write page_id, url, html as ARC archives of the version, or of either in turn; the manifest of the files."""
    folder = stage_dir(pages.sparkSession, "arc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, task = None, [], TaskContext.get().partitionId()
        for b in batches:
            for i in range(b.num_rows):
                if out is None:
                    kind = version or VERSIONS[(task + len(done)) % 2]
                    out = Archive(folder, ".arc.gz")
                    out.add(arc_first(kind, out.name), counted=False)
                out.add(arc_record(kind, out.name, out.offset, *(b.column(c)[i].as_py() for c in range(3))))
                if out.full:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        yield _manifest(done)

    return staged(pick(pages, "page_id", "url", "html").mapInArrow(run, MANIFEST), "arc-manifest")


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its closing empty line, and payload."""
    at = content.find(b"\r\n\r\n")
    return (content[:at + 4], content[at + 4:]) if at >= 0 else (b"", content)


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name).encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode() if m else None


# --- WARC ------------------------------------------------------------------

def record_id(*of: object) -> str:
    """A name-based identifier: the same record gets the same one in every attempt."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, of)))}>"


def iso_time(arc_date: str) -> str:
    """2026-01-01T00:00:00Z from 20260101000000; shorter dates are filled up (month and day with 1)."""
    d = arc_date if len(arc_date) >= 14 else arc_date + "00000101000000"[len(arc_date):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(header: dict, content: bytes, ident: str, refers: tuple[str, str] | None) -> bytes:
    """The WARC record of an ARC one; refers is (record id, page id) of the response with the same payload."""
    head, payload = split_http(content)
    block = head if refers else content
    fields = [
        ("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", ident), ("WARC-Date", iso_time(header["Archive-date"])),
        ("WARC-Target-URI", header["URL"]), ("WARC-IP-Address", header["IP-address"]),
        ("WARC-Payload-Digest", f"sha1:{digest32(payload)}"), ("WARC-Block-Digest", f"sha1:{digest32(block)}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if refers:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", refers[0]), ("X-Refers-To-Page-Id", refers[1])]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_warc(path: str) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record; the block has the declared length and digest."""
    for offset, raw in members(path):
        head, _, rest = raw.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        block = rest[:int(fields["Content-Length"])]
        if not first.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest32(block)}":
            raise ValueError(f"{path}: the record at {offset} is damaged")
        yield fields, block


def _payloads(manifest: DataFrame) -> DataFrame:
    """(path, at, page_id, sha1, sha256, size) of every ARC record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for offset, _, content in parse_arc(path):
                    head, payload = split_http(content)
                    page = http_field(head, "X-Page-Id")
                    rows.append((path, offset, None if page is None else int(page), hashlib.sha1(payload).digest() + hashlib.sha256(payload).digest(), len(payload)))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["path", "at", "page_id", "payload", "size"])
    return _spread(manifest).mapInArrow(run, "path string, at bigint, page_id bigint, payload binary, size bigint")


def convert(manifest: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Convert the ARC archives of a manifest; the manifest of the WARC ones.

    Which record is the response of its payload is settled on digests alone
    (two of them, and the length); payloads are not shuffled. Per archive the
    referring records' offsets come together, at most ARCHIVE_RECORDS.
    """
    folder = stage_dir(manifest.sparkSession, "warc")
    rows = staged(_payloads(manifest), "warc-payloads").where(F.col("size") >= least_bytes)
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "at")
    first = staged(rows.groupBy("payload", "size").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
                   .where("n > 1").select("payload", "size", "first"), "warc-first")
    refers = (rows.join(first, ["payload", "size"]).where("not (path = first.path and at = first.at)")
              .select("path", F.struct("at", F.col("first.page_id").alias("page_id"), F.col("first.path").alias("in_path"), F.col("first.at").alias("in_at")).alias("to"))
              .groupBy("path").agg(F.collect_list("to").alias("refers")))
    work = _spread(manifest).join(refers, "path", "left").select("path", "refers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, refers in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                to = {r["at"]: r for r in refers or ()}
                out = Archive(folder, ".warc.gz")
                for offset, header, content in parse_arc(path):
                    r = to.get(offset)
                    seen = r and (record_id(r["in_path"].rpartition("/")[2], r["in_at"]), "-" if r["page_id"] is None else str(r["page_id"]))
                    out.add(warc_record(header, content, record_id(path.rpartition("/")[2], offset), seen or None))
                yield _manifest([out.close()])

    return staged(work.mapInArrow(run, MANIFEST), "warc-manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id and url of every record.

    A response's payload is digested anew and must match its header; a
    revisit's length is that of the HTTP header which it keeps.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for fields, block in parse_warc(path):
                    head, payload = split_http(block)
                    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                    size = int(http_field(head, "Content-Length") or len(payload))
                    if kind == "response" and (digest32(payload), len(payload)) != (digest, size):
                        raise ValueError(f"{path}: {fields['WARC-Record-ID']} has another payload than it says")
                    page, to = http_field(head, "X-Page-Id"), fields.get("X-Refers-To-Page-Id", "-")
                    rows.append((None if page is None else int(page), size, digest, kind, None if to == "-" else int(to),
                                 fields["WARC-Record-ID"], fields["WARC-Target-URI"]))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                                 names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url"])
    return _spread(manifest).mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, url string")


def archive_pages(pages: DataFrame, version: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Pages through ARC and WARC archives, and back."""
    return read_warc(convert(write_arc(pages, version), least_bytes))
