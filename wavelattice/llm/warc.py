"""WARC records in ZIP packages: writer, and a reader that only reads ranges.

A package is a ZIP archive with stored members: WARC files below ``archive/`` (one gzip member per record) and indexes below
``indexes/`` (a line per record that ends in JSON with ``offset``, ``length`` and, where there are several WARC files,
``filename``). The reader finds the end of central directory record, follows the ZIP64 locator where there is one, lists the
stored members from the central directory, reads the indexes and then fetches the records by byte range. Nothing is
extracted. Members may have any names and indexes any order; what no index names is not read. Packages are real files in the shared
folder, opened through ``pyarrow.fs``, so any store with a pyarrow file system works.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavelattice.llm.common import fresh_path, rows_of, settled, table
from wavelattice.operators.skew import join_facts

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 1000
RANGE_BYTES = 4 << 20
#: Tasks of a read-back; ranges beyond share them.
MAX_TASKS = 100_000


# --- ZIP ---------------------------------------------------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    start: int  # of the data in the archive


def _u(fmt: str, data: bytes, at: int) -> tuple:
    return struct.unpack_from("<" + fmt, data, at)


def stored_members(read_at, size: int) -> list[Member]:
    """The stored members of an archive of ``size`` bytes; ``read_at(offset, n)`` reads a range."""
    tail_at = max(0, size - 65_557)
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory record")
    entries, cd_size, cd_at = _u("HII", tail, end + 10)
    if entries == 0xFFFF or cd_size == 0xFFFFFFFF or cd_at == 0xFFFFFFFF:
        loc = read_at(tail_at + end - 20, 20)
        if loc[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        wide = read_at(_u("Q", loc, 8)[0], 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory record")
        entries, cd_size, cd_at = _u("QQQ", wide, 32)
    cd, at, out = read_at(cd_at, cd_size), 0, []
    for _ in range(entries):
        if cd[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, = _u("H", cd, at + 10)
        packed, full = _u("II", cd, at + 20)
        n_name, n_extra, n_note = _u("HHH", cd, at + 28)
        header, = _u("I", cd, at + 42)
        name = cd[at + 46:at + 46 + n_name].decode("utf-8", "replace")
        extra, e = cd[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            kind, n = _u("HH", extra, e)
            if kind == 1:  # the wide values come in this order, each only if its narrow field is full
                f = e + 4
                if full == 0xFFFFFFFF:
                    full, f = _u("Q", extra, f)[0], f + 8
                if packed == 0xFFFFFFFF:
                    packed, f = _u("Q", extra, f)[0], f + 8
                if header == 0xFFFFFFFF:
                    header, f = _u("Q", extra, f)[0], f + 8
            e += 4 + n
        if method == 0:
            local = read_at(header, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError("broken local header")
            out.append(Member(name, method, packed, header + 30 + sum(_u("HH", local, 26))))
        at += 46 + n_name + n_extra + n_note
    return out


def _open(path: str, write: bool = False):
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path) if urlsplit(path).scheme else (fs.LocalFileSystem(), path)
    return where.open_output_stream(inner) if write else where.open_input_file(inner)


# --- WARC --------------------------------------------------------------------------------------------------------

def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a whole response, or a revisit that keeps only the HTTP header."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Target-URI", "".join((url or "").splitlines())), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        head[1:1] = [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (both with lower-case names) and payload of a record."""
    def headers(block: bytes) -> dict[str, str]:
        lines = block.decode("utf-8", "replace").split("\r\n")[1:]
        return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}

    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = headers(head)
    http, _, payload = rest[:int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, headers(http), payload


def _page_of(urn: str | None) -> int | None:
    """The page of a record id of this writer; null for other ids."""
    m = _PAGE.fullmatch(urn or "")
    return int(m[1]) if m else None


_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def with_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, _digest, _refers``: the SHA-1 of every payload and the response that a page repeats.

    Only digests that occur more than once travel on. While they are few they are broadcast, and no page is shuffled;
    else a digest that very many pages share is dealt by salts after their number.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), F.sha1(F.encode(body, "UTF-8")).alias("_digest"),
                        F.octet_length(body).alias("_n"))
    shared = rows.where(F.col("_n") >= min_bytes).groupBy("_digest").agg(
        F.max("page_id").alias("_keep"), F.count(F.lit(1)).alias("_times")).where("_times > 1")
    out = join_facts(rows, shared, "_digest", "_times", "page_id", how="left")
    refers = F.when((F.col("_n") >= min_bytes) & (F.coalesce("page_id", F.lit(-(1 << 63))) != F.col("_keep")), F.col("_keep"))
    return out.select("page_id", "url", "html", "_digest", refers.alias("_refers"))


_MANIFEST = "path string, bytes bigint, records bigint"


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """One package per partition in ``folder``; returns the manifest ``path, bytes, records``.

    A repeated task writes a file of its own name, and only files in the manifest count.
    """
    def run(batches):
        path, index, n, at = f"{folder}/{uuid.uuid4().hex}.wacz", [], 0, 0
        out = archive = data = None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                page_id, url, html, digest, refers = row
                if data is None:
                    out = _open(path, write=True)
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                    data = archive.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
                packed = gzip.compress(_record(page_id, url, html.encode(), digest, refers), 6, mtime=0)
                data.write(packed)
                index.append(json.dumps({"page": page_id, "offset": at, "length": len(packed)}))
                at, n = at + len(packed), n + 1
        if data is not None:
            data.close()
            archive.writestr(zipfile.ZipInfo(INDEX), "\n".join(index))
            archive.close()
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
                                             names=["path", "bytes", "records"])

    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(folder) if urlsplit(folder).scheme else (fs.LocalFileSystem(), folder)
    where.create_dir(inner, recursive=True)
    return settled(pages.select("page_id", "url", "html", "_digest", "_refers").mapInArrow(run, _MANIFEST))


_RANGE = "path string, start bigint, stop bigint, offsets array<bigint>, lengths array<bigint>"
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def indexed_records(members: list[Member], read_at) -> list[tuple[int, int]]:
    """``(start, length)`` in the package of every record that an index names, by start."""
    archives = {m.name.removeprefix("archive/"): m for m in members if m.name.startswith("archive/") and m.size}
    found = set()
    for index in members:
        if not index.name.startswith("indexes/"):
            continue
        text = read_at(index.start, index.size)
        text = gzip.decompress(text) if index.name.endswith(".gz") else text
        for line in text.decode("utf-8", "replace").splitlines():
            at = line.find("{")
            if at < 0:
                continue  # header or blank line
            entry = json.loads(line[at:])
            name = str(entry.get("filename") or next(iter(archives))).rsplit("/", 1)[-1]
            if "filename" not in entry and len(archives) > 1:
                raise ValueError(f"{index.name} does not say which of {len(archives)} archive members it means")
            member = archives[name]
            offset, length = int(entry["offset"]), int(entry["length"])
            if offset + length > member.size:
                raise ValueError(f"{index.name} names bytes beyond the end of {member.name}")
            found.add((member.start + offset, length))
    for m in archives.values():
        if not any(m.start <= at < m.start + m.size for at, _ in found):
            raise ValueError(f"no index names any record of {m.name}")
    return sorted(found)


def record_ranges(records: list[tuple[int, int]], range_bytes: int) -> list[tuple[int, int, list[int], list[int]]]:
    """``start, stop, offsets, lengths`` of byte ranges of about ``range_bytes`` that hold whole records; gaps are not read."""
    out: list[list] = []
    for at, n in records:
        if not out or at > out[-1][1] or at + n - out[-1][0] > range_bytes:
            out.append([at, at, [], []])
        here = out[-1]
        here[1] = at + n
        here[2].append(at - here[0])
        here[3].append(n)
    return [tuple(x) for x in out]


def read_packages(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the packages in ``path, bytes`` that their indexes name.

    The directory and indexes of each package give ranges of about ``range_bytes``; the ranges are dealt to as many tasks
    as the bytes need, so a large package does not stay with one. Responses are hashed anew and must match their digest, if
    they carry one; revisits take length and digest from the headers they keep. Records without a digest are hashed.
    """
    def plan(batches):
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _open(path) as f:
                    def read_at(at, n, f=f):
                        return f.read_at(n, at)

                    ranges = record_ranges(indexed_records(stored_members(read_at, size), read_at), range_bytes)
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                columns = list(zip(*ranges)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(ranges), pa.string()), *map(pa.array, columns, kinds)],
                                                 names=["path", "start", "stop", "offsets", "lengths"])

    def fetch(batches):
        for batch in batches:
            for path, start, stop, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(path) as f:
                    blob = f.read_at(stop - start, start)
                rows = [_read_record(gzip.decompress(blob[at:at + n])) for at, n in zip(offsets, lengths)]
                yield rows_of(_READ, dict(zip(_READ.names, zip(*rows))))

    total = packages.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]  # one row
    tasks = max(1, -(-total // range_bytes))
    ranges = packages.select("path", "bytes").mapInArrow(plan, _RANGE)
    return ranges.repartitionByRange(int(min(tasks, MAX_TASKS)), "path", "start").mapInArrow(
        fetch, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string")


def _read_record(raw: bytes) -> tuple:
    warc, http, payload = parse_record(raw)
    kind, told = warc["warc-type"], warc.get("warc-payload-digest")
    if told is not None and told.startswith("sha1:"):
        told = base64.b32decode(told.removeprefix("sha1:")).hex()
    if kind != "revisit":
        digest = hashlib.sha1(payload).hexdigest()
        if told not in (None, digest):
            raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
        told = digest
    return (_page_of(warc["warc-record-id"]), int(http.get("content-length", 0)) if kind == "revisit" else len(payload), told, kind,
            _page_of(warc.get("warc-refers-to")), warc.get("warc-target-uri"))


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, html`` to packages and read them back.

    Of pages with equal payloads of at least 1000 bytes the one with the largest id is a response and the others revisit
    it. Null html is an empty payload, a null url is empty. Rows that share the largest id are all responses; rows with
    a null id revisit unless all copies have null ids. An empty table writes nothing and gives an empty result. Other
    columns are not written.
    """
    return read_packages(write_packages(with_roles(pages), folder))


def query(spark, sf: str) -> DataFrame:
    read = archive_pages(table(spark, sf, "pages"), fresh_path(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
k AS (SELECT html, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN keep IS NULL OR page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keep IS NULL OR page_id = keep THEN NULL ELSE keep END AS refers_to
FROM p LEFT JOIN k ON p.html = k.html
"""
