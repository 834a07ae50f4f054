"""Substring deduplication by paragraphs (operator 5).

A paragraph is a line, cut before every sentence of at least
``SENTENCE_WORDS`` words, so that a passage pasted into a longer line has
paragraphs of its own. Those of at least ``MIN_WORDS`` words take part. Equal
paragraphs are one item from the start; others meet by MinHash banding of
their five-word shingles, with the bands tuned for recall
(:func:`tune_bands`), are verified by exact Jaccard similarity
(:mod:`wardlens.llm.near_links`) and joined to clusters. In each cluster that
reaches over two documents or more, the first paragraph stays and the others
are removals.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, materialize
from wardlens.llm.near_links import near_components
from wardlens.llm.shingles import SHINGLE, mix, shingle_hashes, shingle_words, text_groups, word_hashes

THRESHOLD, RECALL = 0.8, 0.998
SENTENCE_WORDS, MIN_WORDS = 8, 12
# Text whose paragraphs are sketched together.
GROUP_CHARS = 1 << 16
_SENTENCE = re.compile(r"[^.!?]*[.!?]+(?=\s|$)\s*|.+\Z", re.S)


def tune_bands(threshold: float, recall: float, max_bands: int = 64) -> tuple[int, int]:
    """(bands, rows) with the fewest bands, then the most rows, that find a pair at ``threshold`` with ``recall``.

    A pair is found with probability 1 - (1 - t**rows)**bands.
    """
    for bands in range(1, max_bands + 1):
        for rows in range(8, 0, -1):
            if 1 - (1 - threshold ** rows) ** bands >= recall:
                return bands, rows
    raise ValueError("no banding reaches this recall")


def split_paragraphs(text: str) -> list[tuple[int, int]]:
    """(start, end) of the paragraphs of a text, in code points."""
    out, at = [], 0
    for line in text.split("\n"):
        start, end = at, at
        for m in _SENTENCE.finditer(line):
            s, e = at + m.start(), at + m.end()
            if end > start and len(m.group().split(None, SENTENCE_WORDS)) >= SENTENCE_WORDS:
                out.append((start, end))
                start = s
            end = e
        if end > start:
            out.append((start, end))
        at += len(line) + 1
    return out


def paragraph_sketches(texts: list[str], seeds: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, np.ndarray, list[bytes]]:
    """For paragraphs of MIN_WORDS or more: (text, number, start, end, words), two 64-bit hashes each, min-hashes, shingle sets."""
    spans, lists = [], []
    for at, text in enumerate(texts):
        for k, (s, e) in enumerate(split_paragraphs(text)):
            words = shingle_words(text[s:e].encode())
            if len(words) >= MIN_WORDS:
                spans.append((at, k, s, e, len(words)))
                lists.append(words)
    if not spans:
        return [], np.zeros((0, 2), np.int64), np.zeros((0, len(seeds)), np.uint64), []
    n = np.array([len(w) for w in lists])
    first = np.cumsum(n) - n
    hashes = word_hashes([w for words in lists for w in words])
    place = (np.arange(len(hashes)) - np.repeat(first, n)).astype(np.uint64)
    with np.errstate(over="ignore"):
        one = np.add.reduceat(mix(hashes + (place << np.uint64(32))), first)
        two = np.add.reduceat(mix(hashes * np.uint64(0x9E3779B97F4A7C15) + (place << np.uint64(33)) + np.uint64(7)), first)
    shingles = shingle_hashes(hashes, SHINGLE)
    inside = np.repeat(np.arange(len(n)), n)[:len(shingles)]
    whole = place[:len(shingles)] + np.uint64(SHINGLE) <= np.repeat(n, n)[:len(shingles)].astype(np.uint64)
    shingles, owner = shingles[whole], inside[whole]
    starts = np.searchsorted(owner, np.arange(len(n)))
    low = np.stack([np.minimum.reduceat(mix(shingles ^ s), starts) for s in seeds], axis=1)
    items = (shingles >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((items, owner))
    items, owner = items[order], owner[order]
    keep = np.concatenate([[True], (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])])
    items, owner = items[keep].astype("<u4"), owner[keep]
    cut = np.searchsorted(owner, np.arange(len(n) + 1))
    return spans, np.stack([one, two], axis=1).view(np.int64), low, [items[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """paragraphs x bands keys from paragraphs x (bands * rows) min-hashes."""
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(low), bands)).copy()
    table = low.reshape(len(low), bands, rows)
    with np.errstate(over="ignore"):
        for j in range(rows):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + table[:, :, j])
    return out.view(np.int64)


def repeated_paragraphs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                        threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Paragraphs that repeat across documents: one row per paragraph of such a cluster.

    Columns: cluster, doc_id, doc_hash (xxhash64 of the text), paragraph,
    start, end (code points), n_words, removed. The first paragraph of a
    cluster, by (doc_id, doc_hash, start) with nulls first, stays. A null text
    has no paragraphs; rows that repeat id and text count as one document.
    Documents without repeated paragraphs have no row. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    bands, width = tune_bands(threshold, recall)
    seeds = mix(np.arange(1, bands * width + 1, dtype=np.uint64))
    schema = pa.schema([("doc_id", pa.int64()), ("doc_hash", pa.int64()), ("paragraph", pa.int32()), ("start", pa.int32()),
                        ("end", pa.int32()), ("n_words", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("keys", pa.list_(pa.int64())), ("items", pa.binary())])

    def sketch(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for first, last in text_groups(texts, GROUP_CHARS):
                spans, pair, low, items = paragraph_sketches(texts[first:last], seeds)
                keys = _band_keys(low, bands, width)
                for at in range(0, len(spans), 2048):
                    part = slice(at, at + 2048)
                    owner, number, start, end, words = zip(*spans[part], strict=True)
                    doc = pa.array(first + np.array(owner))
                    yield batch_of(schema, {
                        "doc_id": batch.column(0).take(doc), "doc_hash": batch.column(1).take(doc), "paragraph": number,
                        "start": start, "end": end, "n_words": words, "h1": pair[part, 0], "h2": pair[part, 1],
                        "keys": list(keys[part]), "items": items[part]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("doc_hash"),
                       F.col(text_col).cast("string").alias("text"))
    table = rows.mapInArrow(sketch, "doc_id long, doc_hash long, paragraph int, start int, end int, n_words int, "
                                    "h1 long, h2 long, keys array<long>, items binary")
    table = materialize(table.withColumn("row", F.monotonically_increasing_id()), "paragraph-sketches")
    # Equal paragraphs are one item, named by its first row.
    first = materialize(table.groupBy("h1", "h2").agg(F.min("row").alias("uid"), F.count("*").alias("n")), "paragraph-texts")
    keyed = materialize(table.select(F.col("row").alias("uid"), "keys").join(first.select("uid"), "uid", "left_semi"), "paragraph-keys")
    sets = table.select(F.col("row").alias("uid"), "items", F.unhex(F.lit("")).alias("reps"))
    roots = near_components(keyed, sets, threshold).withColumnRenamed("node", "uid")
    named = first.join(roots, "uid", "left").where("n > 1 or root is not null").select(
        "h1", "h2", F.coalesce("root", "uid").alias("cluster"))
    found = table.drop("keys", "items", "row").join(named, ["h1", "h2"]).drop("h1", "h2")
    found = materialize(found, "paragraph-clusters")
    doc = F.struct("doc_id", "doc_hash")
    ends = (found.groupBy("cluster").agg(F.min(F.struct("doc_id", "doc_hash", "start")).alias("keep"), F.min(doc).alias("lo"),
                                         F.max(doc).alias("hi")).where("lo != hi or (lo.doc_id is null) != (hi.doc_id is null)")
            .select("cluster", "keep"))
    own = F.struct("doc_id", "doc_hash", "start")
    return found.join(ends, "cluster").select("cluster", "doc_id", "doc_hash", "paragraph", "start", "end", "n_words",
                                              (~own.eqNullSafe(F.col("keep"))).alias("removed"))


def without_removed(docs: DataFrame, paragraphs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed paragraphs cut out of their texts; all columns are kept."""
    cuts = (paragraphs.where("removed").groupBy(F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_hash"))
            .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_cuts")))
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    table = docs.toDF(*names)
    joined = table.join(cuts, F.col(names[docs.columns.index(id_col)]).cast("long").eqNullSafe(F.col("_id"))
                        & (F.xxhash64(F.col(text).cast("string")) == F.col("_hash")), "left")
    at = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    walked = F.aggregate("_cuts", at, lambda a, c: F.struct(
        F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, c["start"] - a["at"])).alias("out"), c["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, F.length(text))))
    return joined.select(*[(F.when(F.col("_cuts").isNull(), F.col(text)).otherwise(walked) if n == text else F.col(n)).alias(c)
                           for n, c in zip(names, docs.columns, strict=True)])
