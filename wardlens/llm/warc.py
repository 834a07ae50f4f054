"""WARC archives of web pages: writer and sequential reader (operator 3).

Every record is one gzip member. A response record holds an HTTP response
whose body is the page; a revisit record holds only the HTTP header block (its
Content-Length still states the full body) and names the response it repeats.
The reader walks an archive from its first byte with one incremental zlib
decompressor per member, frames records by Content-Length and verifies the
block digest of every record and the payload digest of every response.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, materialize, open_read, open_write, shared_folder

ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 18
DATE = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(url: str | None) -> str:
    """The URL as one header value: control characters and blanks percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "urn:wardlens:no-url")


def _record_id(page_id: int | None) -> str:
    return f"<urn:wardlens:page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.rstrip(">").rpartition(":")[2]
    return int(number) if number else None


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                revisit: bool) -> bytes:
    """One uncompressed WARC/1.1 record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)),
            ("WARC-Date", DATE), ("WARC-Target-URI", _uri(url))]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
             ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def read_members(stream) -> Iterator[bytes]:
    """The content of each gzip member of ``stream``, one after the other."""
    pending = b""
    while True:
        pending = pending or stream.read(CHUNK)
        if not pending:
            return
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if not pending:
                pending = stream.read(CHUNK)
                if not pending:
                    raise ValueError("archive ends inside a gzip member")
            parts.append(member.decompress(pending))
            pending = member.unused_data if member.eof else b""
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record; raises when framing or digest fails."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) < size or rest[size:] != b"\r\n\r\n":
        raise ValueError("record block does not match its Content-Length")
    if fields.get("warc-block-digest", "") != f"sha1:{base32_sha1(block)}":
        raise ValueError("block digest mismatch")
    return fields, block


def read_record(data: bytes) -> dict:
    """One row per record: ids, type, digest, full payload size and, for a response, the payload."""
    fields, block = parse_record(data)
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("payload digest mismatch")
    return {"page_id": _page_of(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": _page_of(fields["warc-refers-to"]) if revisit else None,
            "url": fields["warc-target-uri"], "payload": None if revisit else payload}


def plan_records(pages: DataFrame, min_bytes: int, *, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """Which page is a response and which revisits it: page_id, url, payload, refers_to, revisit.

    Pages of equal payload (SHA-256 and length) of at least ``min_bytes`` form
    a group; its row with the largest id is the response, and of repeated rows
    of that id one with the smallest url (nulls first). A null html is an empty
    payload, a null id counts as the smallest.

    ``pages`` is read once for the groups and once for the records, and a third
    time where rows repeat an id and payload; payloads are not stored in between.
    """
    body = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        body.alias("payload")).withColumn("key", F.unhex(F.sha2("payload", 256)))
    # Both aggregates are combined before their shuffle, so a hot payload costs one row per task and id.
    ids = rows.where(F.length("payload") >= min_bytes).groupBy("key", "page_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("url").isNotNull().alias("given"), "url")).alias("first"))
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "n", "first")
    best = materialize(
        ids.groupBy("key").agg(F.max(rank).alias("best"), F.sum("n").alias("n")).where("n > 1")
        .select("key", F.lit(True).alias("copied"), F.col("best.page_id").alias("refers_to"),
                F.col("best.n").alias("n_best"), F.col("best.first.url").alias("first_url")), "warc-groups")
    met = rows.join(best, "key", "left")
    chosen = F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("url").eqNullSafe(F.col("first_url"))
    revisit = F.col("copied").isNotNull() & ~chosen
    out = ["page_id", "url", "payload", "refers_to"]
    if best.where("n_best > 1").isEmpty():
        return met.select(*out, revisit.alias("revisit"))
    # Rows alike in id, url and payload cannot be told apart: counted, and the first of the count is the response.
    alike = F.coalesce(F.col("n_best") > 1, F.lit(False)) & chosen
    copies = (met.where(alike).groupBy("key", "page_id", "url", "refers_to")
              .agg(F.any_value("payload").alias("payload"), F.count(F.lit(1)).alias("n"))
              .select(*out, F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")))
    return met.where(~alike).select(*out, revisit.alias("revisit")).unionByName(
        copies.select(*out, (F.col("copy") > 1).alias("revisit")))


def write_archives(records: DataFrame, path: str, *, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records as ``.warc.gz`` files under ``path``; returns the manifest (file, n_records).

    Each task writes its own files and starts a new one after ``archive_bytes``.
    Only files named by a committed manifest row are ever read, so repeated
    tasks do no harm.
    """
    bounded_batches(records.sparkSession)
    schema = pa.schema([("file", pa.string()), ("n_records", pa.int64())])

    def write(batches):
        out, file, size, n, done = None, "", 0, 0, []
        try:
            for batch in batches:
                for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        file = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        out, size, n = open_write(f"{path}/{file}"), 0, 0
                    member = gzip_member(make_record(page_id, url, payload, refers_to, revisit))
                    out.write(member)
                    size, n = size + len(member), n + 1
                    if size >= archive_bytes:
                        out.close()
                        done.append((file, n))
                        out = None
            if out is not None:
                done.append((file, n))
        finally:
            if out is not None:
                out.close()
        if done:
            yield batch_of(schema, {"file": [f for f, _ in done], "n_records": [k for _, k in done]})

    return materialize(records.mapInArrow(write, "file string, n_records long"), "warc-manifest")


def read_archives(manifest: DataFrame, path: str) -> DataFrame:
    """One row per record of the archives (see :func:`read_record`), each archive read sequentially."""
    bounded_batches(manifest.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                        ("payload", pa.binary())])

    def read(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with open_read(f"{path}/{file}") as stream:
                    held, size = [], 0
                    for member in read_members(stream):
                        held.append(read_record(member))
                        size += len(member)
                        if len(held) >= 256 or size >= 8 << 20:
                            yield batch_of(schema, {k: [r[k] for r in held] for k in schema.names})
                            held, size = [], 0
                    if held:
                        yield batch_of(schema, {k: [r[k] for r in held] for k in schema.names})

    files = manifest.select("file").repartition(max(1, manifest.count()))
    return files.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                  "refers_to long, url string, payload binary")


def warc_round_trip(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    path = shared_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages, min_bytes), path), path)
