"""Token ids in patched frame-of-reference files (operator 1).

File format (all numbers little-endian)::

    file    = b"PFOR1\\0" u16(block size) segment*
    segment = b"SEGM" u32(body bytes) u32(crc32 of body) body
    body    = u32 documents, u32 blocks, u64 ids
              documents x i64 doc_id, documents x u8 doc_id-is-null, documents x u64 ids of the document
              blocks x u32 payload start   (index of block starts)
              blocks x u32 minimum, blocks x u8 width, blocks x u16 exceptions
              payload (packed offsets), exceptions x u16 position, exceptions x u32 offset

A segment holds whole documents and about ``SEGMENT_IDS`` ids; its ids are cut
into blocks of ``BLOCK``. Of each block the minimum is subtracted, the offsets
are packed at the bit width of one of the percentiles ``PERCENTILES`` (the one
that makes the block smallest), and offsets above that width are stored in the
exception list. The last block is padded with its minimum.

Writing: documents are range-partitioned by id, so each task holds one range
and streams one file; a task that is repeated writes another file, and only
the file named in the committed manifest (one row per task that succeeded) is
read. Starts are file-local sums plus the totals of the files before.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.common import (batch_of, bounded_batches, materialize, open_read, open_write,
                                 shared_folder, text_or_empty)
from wardlens.llm.encoding import share_frequent

BLOCK = 256
KEY_CHARS = 32
SEGMENT_IDS = 1 << 18
PERCENTILES = (0.90, 0.95, 0.98, 1.0)
MAGIC = b"PFOR1\0"
_WORDS = BLOCK // 64


def _pack(off: np.ndarray, width: int) -> np.ndarray:
    """``off`` (blocks x BLOCK, each below 2**width) as blocks x (BLOCK * width / 8) bytes."""
    k = off.shape[0]
    if width == 0:
        return np.zeros((k, 0), np.uint8)
    v = np.ascontiguousarray(off.astype(np.uint64).reshape(k * _WORDS, 64).T)
    out = np.zeros((width, k * _WORDS), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[word] |= v[j] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= v[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8).reshape(k, BLOCK * width // 8)


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    k = raw.shape[0]
    if width == 0:
        return np.zeros((k, BLOCK), np.uint64)
    words = np.ascontiguousarray(np.ascontiguousarray(raw).view("<u8").reshape(k * _WORDS, width).T)
    out = np.empty((64, k * _WORDS), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        x = words[word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[word + 1] << np.uint64(64 - shift))
        out[j] = x & mask
    return np.ascontiguousarray(out.T).reshape(k, BLOCK)


def _bits(v: np.ndarray) -> np.ndarray:
    return np.frexp(v.astype(np.float64))[1].astype(np.int64)


def encode_segment(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One segment (with its frame) for documents and their ids (little-endian u32 bytes)."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    n, blocks = len(flat), -(-len(flat) // BLOCK)
    table = np.empty(blocks * BLOCK, np.uint32)
    table[:n] = flat
    if n:
        table[n:] = flat[(blocks - 1) * BLOCK:].min()
    table = table.reshape(blocks, BLOCK)
    low = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    off = table - low[:, None]
    ranked = np.sort(off, axis=1)
    width, cost = np.zeros(blocks, np.int64), np.full(blocks, np.iinfo(np.int64).max)
    for p in PERCENTILES:
        w = _bits(ranked[:, max(0, int(np.ceil(p * BLOCK)) - 1)]) if blocks else width
        beyond = (off.astype(np.uint64) >> w[:, None].astype(np.uint64) > 0).sum(axis=1)
        c = w * (BLOCK // 8) + 6 * beyond
        width, cost = np.where(c < cost, w, width), np.minimum(c, cost)
    patched = off.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    rows, positions = np.nonzero(patched)
    values = off[rows, positions]
    off = np.where(patched, 0, off)
    sizes = width * (BLOCK // 8)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    payload = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        at = np.nonzero(width == w)[0]
        raw = _pack(off[at], int(w))
        if w:
            payload[(starts[at][:, None] + np.arange(raw.shape[1])[None, :]).ravel()] = raw.ravel()
    body = b"".join([
        struct.pack("<IIQ", len(ids), blocks, n),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.array([len(x) // 4 for x in ids], "<u8").tobytes(),
        starts[:-1].astype("<u4").tobytes(), low.astype("<u4").tobytes(), width.astype("u1").tobytes(),
        np.bincount(rows, minlength=blocks).astype("<u2").tobytes(),
        payload.tobytes(), positions.astype("<u2").tobytes(), values.astype("<u4").tobytes()])
    return b"SEGM" + struct.pack("<II", len(body), zlib.crc32(body)) + body


def decode_segment(body: bytes) -> tuple[list[int | None], list[bytes]]:
    """Documents and their ids (little-endian u32 bytes) of one segment body."""
    docs, blocks, n = struct.unpack_from("<IIQ", body)
    at = 16

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, null, lengths = take("<i8", docs), take("u1", docs), take("<u8", docs)
    starts, low, width, n_exc = take("<u4", blocks), take("<u4", blocks), take("u1", blocks), take("<u2", blocks)
    payload = take("u1", int((width.astype(np.int64) * (BLOCK // 8)).sum()))
    total = int(n_exc.sum())
    positions, values = take("<u2", total), take("<u4", total)
    off = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width):
        rows = np.nonzero(width == w)[0]
        size = int(w) * (BLOCK // 8)
        raw = payload[(starts[rows].astype(np.int64)[:, None] + np.arange(size)[None, :])]
        off[rows] = _unpack(raw, int(w))
    off[np.repeat(np.arange(blocks), n_exc), positions] = values
    raw = (off + low[:, None]).astype("<u4").reshape(-1)[:n].tobytes()
    ends = np.cumsum(lengths.astype(np.int64)) * 4
    return ([None if z else int(d) for d, z in zip(doc_ids, null, strict=True)],
            [raw[e - 4 * int(k):e] for e, k in zip(ends, lengths, strict=True)])


def read_segments(stream) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Segments of one file, one after the other; raises on a damaged one."""
    head = stream.read(len(MAGIC) + 2)
    if head[:len(MAGIC)] != MAGIC or struct.unpack("<H", head[len(MAGIC):])[0] != BLOCK:
        raise ValueError("not a token block file")
    while frame := stream.read(12):
        if len(frame) < 12 or frame[:4] != b"SEGM":
            raise ValueError("damaged token block file")
        size, crc = struct.unpack("<II", frame[4:])
        body = stream.read(size)
        if len(body) < size or zlib.crc32(body) != crc:
            raise ValueError("damaged token block segment")
        yield decode_segment(body)


def write_token_blocks(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None, *,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write the ids under ``path``; returns the manifest.

    Documents are written in ascending ``id_col`` order (null ids first,
    repeated ids by text). A null text counts as empty; with ``end_id`` an
    empty text still holds that one id. Other columns are ignored. The
    manifest has one row per file: ``shard`` (its rank), ``file``, ``n_docs``,
    ``n_ids`` and ``first_id`` (ids in all files before it).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    head = share_frequent(docs, tokenizer_path, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    # Spark samples the range key into the driver: the start of a text orders as the text does.
    ordered = rows.repartitionByRange("id", F.substring("text", 1, KEY_CHARS)).sortWithinPartitions("id", "text")
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(batches):
        from wardlens.llm.encoding import encoder

        enc, shard = encoder(tokenizer_path, head), TaskContext.get().partitionId()
        file, out = f"part-{shard:06d}-{uuid.uuid4().hex}.pfor", None
        held_ids, held, size, n_docs, n_ids = [], [], 0, 0, 0
        try:
            for batch in batches:
                if out is None:
                    out = open_write(f"{path}/{file}")
                    out.write(MAGIC + struct.pack("<H", BLOCK))
                ids = batch.column(0).to_pylist()
                for d, raw in zip(ids, enc.encode(batch.column(1)), strict=True):
                    held_ids.append(d)
                    held.append(raw + end)
                    size += len(held[-1]) // 4
                    if size >= SEGMENT_IDS:
                        out.write(encode_segment(held_ids, held))
                        n_docs, n_ids = n_docs + len(held), n_ids + size
                        held_ids, held, size = [], [], 0
            if held:
                out.write(encode_segment(held_ids, held))
                n_docs, n_ids = n_docs + len(held), n_ids + size
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield batch_of(schema, {"shard": [shard], "file": [file], "n_docs": [n_docs], "n_ids": [n_ids]})

    manifest = materialize(ordered.mapInArrow(write, "shard int, file string, n_docs long, n_ids long"),
                           "token-manifest")
    # One row per file, so the window holds as many rows as there were tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_token_blocks(manifest: DataFrame, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids (little-endian u32 binary)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches):
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_read(f"{path}/{file}") as stream:
                    for doc_ids, ids in read_segments(stream):
                        n = np.array([len(x) // 4 for x in ids], np.int64)
                        starts = first + np.cumsum(n) - n
                        first += int(n.sum())
                        for k in range(0, len(ids), 256):
                            yield batch_of(schema, {"doc_id": doc_ids[k:k + 256], "start": starts[k:k + 256],
                                                    "n_tokens": n[k:k + 256], "ids": ids[k:k + 256]})

    # A file is the unit of reading: deal the files out, whatever their number in a manifest part.
    spread = manifest.select("file", "first_id").repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_blocks_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int | None) -> DataFrame:
    """Write ``docs`` as token block files in the shared folder and read them back."""
    spark: SparkSession = docs.sparkSession
    path = shared_folder(spark, "token-blocks")
    return read_token_blocks(write_token_blocks(docs, path, tokenizer_path, end_id), path)
