"""WARC archives: index first, then coalesced byte-range reads.

Writing gives each page a record of its own gzip member and lists archive, offset, length, URL and digest of every record in
an index table. Reading starts from rows of that index, all or selected: they are sorted by place, neighbouring ranges are
read in one request, and every payload is checked against its digest. Of records with equal payloads from a size on, the one
with the largest page_id holds the payload and the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, durable, new_path, partitions

#: Payloads of fewer bytes are always stored; an archive is closed after so many bytes; ranges with gaps up to GAP are read at once, up to READ bytes.
REVISIT_FROM, ARCHIVE_BYTES, GAP, READ = 1000, 1 << 30, 64 << 10, 8 << 20
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", value)
    if not found:
        raise ValueError(f"not the id of a page's record: {value}")
    return int(found[1]) if found[1] else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A record as a gzip member. A revisit has the response's HTTP header, so the length of its payload, but not the payload. Control characters and spaces in URLs are percent-encoded."""
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else record_id(page_id)[1:-1]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()
    revisit = [] if refers_to is None else [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}", *revisit]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def parsed(member: bytes) -> dict:
    """A record's page_id, url, payload_bytes, payload_digest (bare hex), record_type, refers_to and payload (None in revisits); digests and lengths are checked."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length: (\d+)", http)[1])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload, usedforsecurity=False).hexdigest() != digest):
        raise ValueError("a payload's length or digest is wrong")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def revisits(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload (column html) a page with a larger id holds. Only ids and digests are shuffled."""
    small = pages.select("page_id", "digest").where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).distinct()
    largest = small.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return small.join(largest, "digest").where("page_id <> refers_to")


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes a record for each row into archives under path, which executors must share, and returns the index: archive, offset, length, page_id, url, digest.

    A null payload is empty; a null id is written as none, and such rows are always responses, as are rows that repeat the
    largest id. Each task writes under a name of its attempt and renames when an archive is full, so a task that runs again
    replaces what it wrote.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(path)
        store.create_dir(root, recursive=True)
        part, number, out, at, rows = TaskContext.get().partitionId(), 0, None, 0, []

        def close() -> pa.RecordBatch:
            out.close()
            store.move(temporary, f"{root}/{name}")
            cols = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            return pa.RecordBatch.from_arrays(cols, ["archive", "offset", "length", "page_id", "url", "digest"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, refers_to, digest = (column(batch, c)[i].as_py() for c in ("page_id", "url", "html", "refers_to", "digest"))
                if out is None:
                    name = f"part-{part:06d}-{number:04d}.warc.gz"
                    temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
                    out, at, rows = store.open_output_stream(temporary, compression=None, buffer_size=1 << 20), 0, []
                    number += 1
                member = record(page_id, url, html.encode(), refers_to)
                out.write(member)
                rows.append((name, at, len(member), page_id, url, digest))
                at += len(member)
                if at >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    html = F.coalesce(F.col(payload_col), F.lit(""))
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    known = revisits(pages)
    laid = pages.join(known, ["page_id", "digest"], "left").sortWithinPartitions("page_id", "digest", "url")
    return durable(laid.select("page_id", "url", "html", "refers_to", "digest").mapInArrow(run, "archive string, offset long, length long, page_id long, url string, digest string"), "index")


def read_records(index: DataFrame, path: str, with_payload: bool = False) -> DataFrame:
    """The records that rows of an index name, read from the archives under path: page_id, payload_bytes, payload_digest, record_type, refers_to, and the payload if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(path)
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if with_payload else {})
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(column(batch, c).to_pylist() for c in ("archive", "offset", "length", "digest")), strict=True))
            k = 0
            while k < len(rows):
                archive, start, length, _ = rows[k]
                stop, j = start + length, k + 1
                while j < len(rows) and rows[j][0] == archive and rows[j][1] - stop <= GAP and max(stop, rows[j][1] + rows[j][2]) - start <= READ:
                    stop = max(stop, rows[j][1] + rows[j][2])
                    j += 1
                if archive != name:
                    name, source = archive, store.open_input_file(f"{root}/{archive}")
                raw = source.read_at(stop - start, start)
                found = []
                for _, offset, size, digest in rows[k:j]:
                    got = parsed(raw[offset - start : offset - start + size])
                    if got["payload_digest"] != digest:
                        raise ValueError(f"{archive} at {offset}: the digest isn't the index's")
                    found.append(got)
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in kinds.items()], list(kinds))
                k = j

    sorted_ = index.select("archive", "offset", "length", "digest").repartitionByRange(partitions(index.sparkSession), "archive", "offset").sortWithinPartitions("archive", "offset")
    return sorted_.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if with_payload else ""))


def archive_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """All rows written into archives in the shared folder and read back from them. An empty table gives no rows."""
    path = new_path(df.sparkSession, "warc")
    return read_records(write_archives(df, path, id_col, url_col, payload_col), path)
