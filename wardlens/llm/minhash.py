"""Near-duplicate documents by ProbMinHash and banding (operator 10).

A document is a weighted set: its runs of five words, with how often each
occurs. Every element sends arrivals of a Poisson process whose rate is its
weight; each arrival falls on one of ``COMPONENTS`` components, and a component
keeps the element that arrived first. An element stops as soon as its next
arrival is later than the last of the components' first arrivals, so most
elements stop after one or two. Two documents agree in a component with a
probability equal to the probability Jaccard similarity of their weights.

Where shingles repeat, a document also has the bands of its plain set (all
weights one, which is the same sketch for a document without repeats): links
count by Jaccard similarity too, which repeated lines leave high while the
probability Jaccard similarity falls.

Components are cut into bands; documents that agree in a band are candidates,
verified on the exact sets (:mod:`wardlens.llm.near_links`) and joined to
classes. Equal texts are one item from the start, whatever their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, materialize
from wardlens.llm.near_links import near_components
from wardlens.llm.shingles import SHINGLE, mix, pack_set, shingle_hashes, shingle_words, word_hashes

THRESHOLD = 0.8
BANDS, ROWS = 20, 5
COMPONENTS = BANDS * ROWS


def _arrivals(elements: np.ndarray, rates: np.ndarray, time: np.ndarray, first: int, count: int,
              m: int) -> tuple[np.ndarray, np.ndarray]:
    """Times and components of arrivals ``first`` to ``first + count - 1`` of each element."""
    k = np.arange(first, first + count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = mix(elements[:, None] + (k[None, :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        c = mix(h ^ np.uint64(0xD6E8FEB86659FD93))
    gap = -np.log1p(-(h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53) / rates[:, None]
    return time[:, None] + np.cumsum(gap, axis=1), (c % np.uint64(m)).astype(np.int64)


def probminhash(elements: np.ndarray, weights: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """The element (64-bit hash) that arrives first at each component; none for an empty set."""
    if not len(elements):
        return np.zeros(0, np.uint64)
    best, owner = np.full(m, np.inf), np.zeros(m, np.uint64)
    rates = weights.astype(np.float64)
    time, done = np.zeros(len(elements)), 0
    while len(elements):
        count = max(1, -(-6 * m // len(elements)) if not done else -(-m // len(elements)))
        t, c = _arrivals(elements, rates, time, done, count, m)
        flat_t, flat_c, flat_e = t.ravel(), c.ravel(), np.repeat(elements, count)
        early = flat_t < best[flat_c]
        flat_t, flat_c, flat_e = flat_t[early], flat_c[early], flat_e[early]
        order = np.argsort(-flat_t, kind="stable")  # the earliest is written last
        best[flat_c[order]], owner[flat_c[order]] = flat_t[order], flat_e[order]
        go_on = t[:, -1] < best.max()
        elements, rates, time, done = elements[go_on], rates[go_on], t[go_on, -1], done + count
    return owner


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band (none for an empty signature)."""
    if not len(signature):
        return np.zeros(0, np.int64)
    out = np.arange(bands, dtype=np.uint64)
    table = signature.reshape(bands, rows)
    with np.errstate(over="ignore"):
        for j in range(rows):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + table[:, j])
    return out.view(np.int64)


def document_keys(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Band keys of the weighted set and, where elements repeat, of the plain set; each key once."""
    keys = band_keys(probminhash(elements, counts))
    if (counts == 1).all():
        return keys
    return np.unique(np.concatenate([keys, band_keys(probminhash(elements, np.ones_like(counts)))]))


def sketches(texts: DataFrame) -> DataFrame:
    """(row, doc_id, digest, text binary) -> row, doc_id, digest, keys, items, reps."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()),
                        ("keys", pa.list_(pa.int64())), ("items", pa.binary()), ("reps", pa.binary())])

    def sketch(batches):
        for batch in batches:
            out = {"row": batch.column(0), "doc_id": batch.column(1), "digest": batch.column(2), "keys": [], "items": [], "reps": []}
            for text in batch.column(3).to_pylist():
                hashes = shingle_hashes(word_hashes(shingle_words(text)), SHINGLE)
                elements, counts = np.unique(hashes, return_counts=True)
                items, reps = pack_set(hashes)
                out["keys"].append(document_keys(elements, counts))
                out["items"].append(items)
                out["reps"].append(reps)
            yield batch_of(schema, out)

    return texts.select("row", "doc_id", "digest", "text").mapInArrow(
        sketch, "row long, doc_id long, digest binary, keys array<long>, items binary, reps binary")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Classes of near-equal documents: one row (doc_id, digest, class) per row of ``docs``.

    ``digest`` is the SHA-256 of the text and ``class`` a number shared by the
    rows of one class. A null text counts as empty; texts without words are
    near only to equal texts. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("row", F.monotonically_increasing_id())
    sketched = materialize(sketches(rows), "near-sketches")
    # Equal texts are one item, named by its first row; the aggregate is combined before its shuffle.
    first = materialize(sketched.groupBy("digest").agg(F.min("row").alias("uid")), "near-texts")
    keyed = materialize(sketched.select(F.col("row").alias("uid"), "keys").join(first.select("uid"), "uid", "left_semi"), "near-keys")
    roots = near_components(keyed, sketched.select(F.col("row").alias("uid"), "items", "reps"), threshold)
    named = first.join(roots.withColumnRenamed("node", "uid"), "uid", "left").select(
        "digest", F.coalesce("root", "uid").alias("class"))
    return sketched.select("doc_id", "digest").join(named, "digest")


def duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_size and kept, one row per row of ``docs``.

    Of each class the row with the least doc_id is kept (a null id is the
    least), of equal ids that with the least digest; repeated rows are equal.
    """
    rows = materialize(near_duplicates(docs, **options), "near-rows")
    best = rows.groupBy("class").agg(F.min(F.struct("doc_id", "digest")).alias("m"), F.count("*").alias("class_size"))
    best = best.select("class", F.col("m.doc_id").alias("class_id"), F.col("m.digest").alias("best"), "class_size")
    return rows.join(best, "class").select(
        "doc_id", "class_id", "class_size", "digest",
        (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("best"))).alias("kept"))


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of near-equal documents; all columns are kept."""
    classes = duplicate_classes(docs, id_col=id_col, text_col=text_col, threshold=threshold)
    kept = classes.where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    names = [f"c{i}" for i in range(len(docs.columns))]
    body = F.coalesce(F.col(names[docs.columns.index(text_col)]).cast("string"), F.lit(""))
    table = docs.toDF(*names).withColumn("_own", F.unhex(F.sha2(body.cast("binary"), 256)))
    own_id = F.col(names[docs.columns.index(id_col)]).cast("long")
    out = materialize(table.join(kept, own_id.eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left_semi")
                      .withColumn("_row", F.monotonically_increasing_id()), "near-kept")
    # Rows that repeat both id and text: the first of them stays.
    first = out.groupBy(names[docs.columns.index(id_col)], "_own").agg(F.min("_row").alias("_row"), F.count("*").alias("n"))
    if not first.where("n > 1").isEmpty():
        out = out.join(first.select("_row"), "_row", "left_semi")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
