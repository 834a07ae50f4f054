"""Benchmark decontamination by a prefix-filtered containment join (operator 7).

A window is a run of ``WINDOW`` consecutive words of a benchmark item (the
whole item when it has fewer). As a set join: a document window holds an item
window only if it holds all its words, so by the prefix principle one word is
a necessary prefix, and the best one is the rarest. Words are ordered by how
often the corpus uses them; each window is filed under its rarest word; each
document word that is such a prefix proposes the windows filed there, at the
one position where they would have to lie (positional bound) if the document
is long enough (length bound); and the words there are compared exactly.

The benchmark is the query set. It is sent to the tasks in blocks of at most
``BLOCK_WORDS`` words; documents are streamed past each block. Usually there
is one block, and then nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, materialize

WINDOW = 10
BLOCK_WORDS = 1_000_000
# Fixed rule: A-Z are lower-cased; words are runs of 0-9, a-z and all characters beyond ASCII.
_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
               for c in range(256))

RESULT = ("n_words long, n_hit long, spans array<struct<start:int,end:int>>, items array<long>")


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; none for a null."""
    return text.translate(_TABLE).split() if text else []


def blocks_of(items: Iterable[tuple[int | None, bytes | None]], block_words: int,
              window: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words; a longer item is cut with an overlap of window - 1."""
    block, size = [], 0
    for item_id, text in items:
        words = words_of(text)
        step = max(1, block_words - window + 1)
        parts = [words] if len(words) <= block_words else [words[k:k + block_words]
                                                           for k in range(0, len(words) - window + 1, step)]
        for part in parts:
            if part and size + len(part) > block_words and block:
                yield block
                block, size = [], 0
            if part:
                block.append((item_id, part))
                size += len(part)
    if block:
        yield block


def windows_of(block: list[tuple[int | None, list[bytes]]], window: int) -> dict[tuple[bytes, ...], set]:
    """Each distinct window with the ids of its items."""
    found: dict[tuple[bytes, ...], set] = {}
    for item_id, words in block:
        for k in range(max(1, len(words) - window + 1)):
            found.setdefault(tuple(words[k:k + window]), set()).add(item_id)
    return found


def file_by_prefix(windows: dict[tuple[bytes, ...], set], rarity: dict[bytes, int]) -> dict[bytes, list]:
    """Rarest word -> (its place in the window, the window as a list, item ids)."""
    filed: dict[bytes, list] = {}
    for words, items in windows.items():
        at = min(range(len(words)), key=lambda k: (rarity.get(words[k], 0), words[k], k))
        filed.setdefault(words[at], []).append((at, list(words), tuple(items)))
    return filed


def find_hits(words: list[bytes], filed: dict[bytes, list]) -> tuple[list[tuple[int, int]], set]:
    """Merged (start, end) word spans covered by windows, and the ids of items with a window there."""
    starts, items, n = [], set(), len(words)
    for i, w in enumerate(words):
        if w in filed:
            for at, window, ids in filed[w]:
                s = i - at
                if s >= 0 and s + len(window) <= n and words[s:s + len(window)] == window:
                    starts.append((s, s + len(window)))
                    items.update(ids)
    spans: list[tuple[int, int]] = []
    for s, e in sorted(starts):
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
        else:
            spans.append((s, e))
    return spans, items


def _rarity(docs: DataFrame, vocabulary: frozenset) -> dict[bytes, int]:
    """How often the corpus uses each benchmark word (at most one row per such word comes back)."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(batches):
        seen, vocab = Counter(), known.value
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(filter(vocab.__contains__, words_of(text)))
        if seen:
            yield batch_of(schema, {"word": list(seen), "n": list(seen.values())})

    rows = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def _scan(filed_b, every_row: bool):
    item = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("spans", pa.list_(item)), ("items", pa.list_(pa.int64()))])

    def scan(batches):
        filed = filed_b.value
        for batch in batches:
            out = []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                spans, items = find_hits(words, filed)
                if every_row or spans:
                    out.append((d, len(words), sum(e - s for s, e in spans),
                                [{"start": s, "end": e} for s, e in spans],
                                sorted(items, key=lambda x: (x is not None, x or 0))))
            if out:
                cols = list(zip(*out, strict=True))
                yield batch_of(schema, dict(zip(schema.names, map(list, cols), strict=True)))

    return scan


def _blocks(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, window: int,
            block_words: int) -> list[list]:
    items = benchmark.select(F.col(item_col).cast("long"), F.col(item_text).cast("string").cast("binary"))
    rows = ((r[0], None if r[1] is None else bytes(r[1])) for r in items.toLocalIterator())
    return blocks_of(rows, block_words, window)


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: id column, n_words, n_hit, spans (merged, in words) and items (distinct ids).

    A null text has no words. Items without words match nothing; repeated
    items count once per id. Other columns of both tables are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    blocks = _blocks(docs, benchmark, item_col, item_text, window, block_words)
    first, second = next(blocks, []), next(blocks, None)
    filed_of = lambda block: _filed(rows, block, window)
    if second is None:
        found = rows.mapInArrow(_scan(spark.sparkContext.broadcast(filed_of(first)), True), f"id long, {RESULT}")
        return found.withColumnRenamed("id", id_col)
    # More blocks: number the rows once, look for each block's hits, merge them per document.
    base = materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "decontamination-docs")
    slim = base.select(F.col("uid").alias("id"), "text")
    hits = None
    for block in _chain(first, second, blocks):
        part = materialize(slim.mapInArrow(_scan(spark.sparkContext.broadcast(_filed(slim, block, window)), False),
                                           f"id long, {RESULT}"), "decontamination-hits")
        hits = part if hits is None else hits.unionByName(part)
    # Per document, at most its own words and the items found in it.
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    merged = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), _merge)
    by_doc = (hits.groupBy("id").agg(merged.alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))
    count = materialize(base.select("uid", F.col("id").alias("doc"), "text").mapInArrow(_count_words, "uid long, doc long, n_words long"),
                        "decontamination-words")
    none_s, none_i = F.array().cast("array<struct<start:int,end:int>>"), F.array().cast("array<long>")
    return count.join(by_doc.withColumnRenamed("id", "uid"), "uid", "left").select(
        F.col("doc").alias(id_col), "n_words",
        F.aggregate(F.coalesce("spans", none_s), F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
        F.coalesce("spans", none_s).alias("spans"), F.array_sort(F.coalesce("items", none_i)).alias("items"))


def _merge(acc, s):
    last = F.try_element_at(acc, F.lit(-1))
    longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
    return F.when((F.size(acc) > 0) & (s["start"] <= last["end"]),
                  F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))
                  ).otherwise(F.concat(acc, F.array(s)))


def _chain(first, second, rest):
    yield first
    yield second
    yield from rest


def _filed(rows: DataFrame, block: list, window: int) -> dict:
    windows = windows_of(block, window)
    vocabulary = frozenset(w for key in windows for w in key)
    return file_by_prefix(windows, _rarity(rows, vocabulary) if vocabulary else {})


def _count_words(batches):
    schema = pa.schema([("uid", pa.int64()), ("doc", pa.int64()), ("n_words", pa.int64())])
    for batch in batches:
        yield batch_of(schema, {"uid": batch.column(0), "doc": batch.column(1),
                                "n_words": [len(words_of(t)) for t in batch.column(2).to_pylist()]})


def contaminated_filter(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", window: int = WINDOW,
                        item_col: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs; all columns are kept."""
    spark = docs.sparkSession
    bounded_batches(spark)
    at, out = docs.columns.index(text_col), docs
    for block in _blocks(docs, benchmark, item_col, item_text, window, block_words):
        filed_b = spark.sparkContext.broadcast(
            _filed(out.select(F.col(text_col).cast("binary").alias("text")), block, window))

        def clean(batches, filed_b=filed_b):
            for batch in batches:
                texts = batch.column(at).to_pylist()
                yield batch.filter(pa.array([not find_hits(words_of(t.encode() if t else None), filed_b.value)[0]
                                             for t in texts], pa.bool_()))

        out = materialize(out.mapInArrow(clean, out.schema), "decontaminated")
    return out
