"""WARC records in ZIP-packaged archives, written and read back by range.

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` (one gzip member for
each record), ``indexes/index.cdxj`` (offset and length of each record) and
``datapackage.json``.  The reader extracts nothing: it finds the end of the central
directory (ZIP64 too), from it the stored members, reads the index, and then ranges of
records.  Archives lie in the shared folder and are opened through pyarrow's file systems,
so a folder in an object store works as a mounted one does.

Each writer task streams archives of a bounded size under names of its own.  Only the
listing that Spark commits counts, so a lost or repeated task leaves no doubled records.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import focus, staged
from lakekit.session import work_dir

DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
REVISIT_BYTES = 100             # payloads from this size on are stored once
ARCHIVE_BYTES = 64 << 20        # an archive is closed beyond this size
READ_BYTES = 4 << 20            # neighbouring records are read together up to this
WARC_DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------- ZIP

def read_range(f, start: int, size: int) -> bytes:
    f.seek(start)
    data = f.read(size)
    if len(data) != size:
        raise ValueError(f"archive ends within bytes {start} to {start + size}")
    return data


def zip_members(f, size: int) -> dict[str, tuple[int, int, int]]:
    """{name: (offset of the local header, stored size, method)} from the central directory."""
    start = max(0, size - (22 + 0xFFFF))
    tail = read_range(f, start, size - start)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20: at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)   # the signature can stand in the comment
    if at < 0:
        raise ValueError("no end of a central directory")
    entries, length, offset = struct.unpack("<HII", tail[at + 10: at + 20])
    locator = start + at - 20
    if locator >= 0 and (mark := read_range(f, locator, 20))[:4] == b"PK\x06\x07":
        end64 = read_range(f, struct.unpack("<Q", mark[8:16])[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of the central directory where its locator says")
        entries, length, offset = struct.unpack("<QQQ", end64[32:56])
    directory, found, pos = read_range(f, offset, length), {}, 0
    for _ in range(entries):
        if directory[pos: pos + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", directory[pos + 8: pos + 12])
        stored, whole, n_name, n_extra, n_comment = struct.unpack("<IIHHH", directory[pos + 20: pos + 34])
        header = struct.unpack("<I", directory[pos + 42: pos + 46])[0]
        name = directory[pos + 46: pos + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = directory[pos + 46 + n_name: pos + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[k: k + 4])
            if kind == 1:       # ZIP64: only the fields that overflow, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[k + 4: k + 4 + n // 8 * 8]))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                header = next(wide) if header == 0xFFFFFFFF else header
            k += 4 + n
        found[name] = (header, stored, method)
        pos += 46 + n_name + n_extra + n_comment
    return found


def stored_member(f, member: tuple[int, int, int]) -> tuple[int, int]:
    """(offset, size) of a stored member's bytes."""
    header, size, method = member
    if method != zipfile.ZIP_STORED:
        raise ValueError("a compressed member can't be read by range")
    local = read_range(f, header, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("no local header where the directory says")
    return header + 30 + sum(struct.unpack("<HH", local[26:30])), size


# ---------------------------------------------------------------- WARC

def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member.  A revisit has the HTTP header, which says the full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {WARC_DATE}"]
    head.append(f"WARC-Record-ID: <urn:page:{page_id}>" if page_id is not None else f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def parse_record(member: bytes) -> dict:
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda name: (int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} isn't the one its header names")
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": page("WARC-Refers-To"), "payload": payload if kind == "response" else None}


# ---------------------------------------------------------------- archives

def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri if ":" in uri else f"file://{uri}"))


def write_archive(uri: str, records: Iterator[tuple], limit: int) -> tuple[int, int]:
    """Stream records into one archive until it is beyond ``limit`` bytes: (records, bytes)."""
    store, path = _open(uri)
    at, lines = 0, []
    with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(DATA, "w", force_zip64=True) as data:
            for page_id, url, payload, digest, refers_to in records:
                member = warc_record(page_id, url, payload, digest, refers_to)
                data.write(member)
                lines.append(json.dumps({"url": url, "digest": f"sha256:{digest}", "filename": DATA, "offset": at, "length": len(member)}))
                at += len(member)
                if at >= limit:
                    break
        with z.open(INDEX, "w") as index:
            index.write("".join(f"page {WARC_DATE} {line}\n" for line in lines).encode())
        with z.open(PACKAGE, "w") as package:
            package.write(json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}).encode())
    return len(lines), at


def archive_records(uri: str) -> Iterator[dict]:
    """All records of an archive, by its index and ranges of its stored member."""
    store, path = _open(uri)
    with store.open_input_file(path) as f:
        members = zip_members(f, f.size())
        base, size = stored_member(f, members[DATA])
        where, n = stored_member(f, members[INDEX])
        places = [(e["offset"], e["length"]) for e in (json.loads(line.split(" ", 2)[2]) for line in read_range(f, where, n).decode().splitlines())]
        at = 0
        while at < len(places):
            first, stop = places[at][0], at
            while stop < len(places) and (stop == at or places[stop][0] + places[stop][1] - first <= READ_BYTES):
                stop += 1
            end = places[stop - 1][0] + places[stop - 1][1]
            if end > size:
                raise ValueError("the index points beyond the member")
            data = read_range(f, base + first, end - first)
            for offset, length in places[at:stop]:
                yield parse_record(data[offset - first: offset - first + length])
            at = stop


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (bytes; NULL html: empty), digest, refers_to.

    Of equal payloads of at least ``REVISIT_BYTES`` the smallest page_id's is the response
    (rows that share it too, as are all if none has an id); the others refer to it.  The
    table of payloads that come more than once is written first, so that Spark knows its
    size: a small one is broadcast and no page is shuffled, else a hot payload's pages are
    split as a skewed partition.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = (rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return rows.join(staged(shared, "warc-shared"), "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as records into archives in ``folder`` (default: a new shared one) and
    return the listing: path, records, bytes.  Columns page_id, url, html are read."""
    folder = folder or work_dir(pages.sparkSession, "warc")
    store, path = _open(folder)
    store.create_dir(path, recursive=True)

    def write(batches):
        focus()

        def rows():
            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                    yield row

        left = rows()
        row = next(left, None)
        while row is not None:
            uri = f"{folder}/{uuid.uuid4().hex}.wacz"

            n, size = write_archive(uri, chain([row], left), limit)
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])
            row = next(left, None)

    return staged(with_revisits(pages).mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-listing")


FIELDS = {"page_id": ("bigint", pa.int64()), "url": ("string", pa.string()), "payload_bytes": ("bigint", pa.int64()), "payload_digest": ("string", pa.string()),
          "record_type": ("string", pa.string()), "refers_to": ("bigint", pa.int64()), "payload": ("binary", pa.binary())}


def read_archives(listing: DataFrame, fields: tuple[str, ...] = tuple(FIELDS), batch_rows: int = 256) -> DataFrame:
    """Records of the archives listed (column ``path``), one task or more for each archive."""
    def read(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                some = []
                for record in archive_records(uri):
                    some.append(record)
                    if len(some) >= batch_rows:
                        yield rows(some)
                        some = []
                if some:
                    yield rows(some)

    def rows(some):
        return pa.RecordBatch.from_arrays([pa.array([r[f] for r in some], FIELDS[f][1]) for f in fields], names=list(fields))

    paths = listing.select("path")
    spread = paths.repartition(max(1, paths.count()), "path")     # a task for each archive
    return spread.mapInArrow(read, ", ".join(f"{f} {FIELDS[f][0]}" for f in fields))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives and read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, one row per page.

    Repeated rows stay; NULL html is an empty payload; a NULL url or page_id is left out of
    the record; an empty table gives no archive and no rows; other columns are ignored.
    """
    return read_archives(write_archives(pages), ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
