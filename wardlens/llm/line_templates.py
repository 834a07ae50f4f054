"""Line deduplication by a log-template tree of fixed depth (operator 6).

Every line with a word counts when it recurs as it is. Lines of at least
``MIN_TOKENS`` tokens, ``MIN_CONSTANT`` of them constant, also go down a tree
(the others are compared as they stand, digits and all): first by their
number of tokens, then by their ``DEPTH`` leading tokens, with variable fields
(tokens that hold a digit, an ``@`` or ``://``) replaced by a wildcard. In a
leaf,

* a line that recurs as it is (wildcards apart) is a template;
* the other lines vote: at each position the token most of them have is the
  template's constant, and a line that agrees in at least ``SIMILARITY`` of
  the positions belongs to it, the other positions being variable fields. This
  is repeated on what is left until a round finds no template;
* a leaf may hold many templates, whose votes mix. Where lines are left over,
  all lines of the leaf that agree with one another in ``SIMILARITY`` of the
  positions are linked, by keys of their rarest positions (prefix filter of
  :mod:`wardlens.llm.near_links`, no pair is lost). Lines linked to a template
  belong to it, other components are templates of their own.

A template that recurs in at least ``MIN_DOCS`` documents is dropped from all
of them but the first, so nothing is lost from the corpus altogether. Leaves
are never gathered: lines travel as hashes (16 bits per token for the vote),
votes are combined before their shuffle, and a document meets only the hashes
of its own lines.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.common import batch_of, bounded_batches, materialize
from wardlens.llm.components import connected_components
from wardlens.llm.near_links import SLACK, near_components
from wardlens.llm.shingles import mix, text_groups, word_hashes

DEPTH, MIN_TOKENS, MIN_DOCS = 3, 4, 3
SIMILARITY, MIN_CONSTANT = 0.7, 0.5
WILDCARD = b"<*>"
# Text whose lines are hashed together.
GROUP_BYTES = 1 << 18
_MARKS = b"0123456789@"
# As in shingles.shingle_words.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]")


def _variable(text: bytes) -> bool:
    """Whether a digit, an ``@`` or ``://`` occurs."""
    return len(text.translate(None, _MARKS)) < len(text) or b"://" in text


def masked_tokens(line: bytes) -> list[bytes]:
    """The tokens of a line, variable fields replaced by the wildcard."""
    tokens = line.split()
    if _variable(line):
        return [WILDCARD if _variable(t) else t for t in tokens]
    return tokens


def line_hashes(texts: list[bytes]) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray, list[bytes]]:
    """For the lines with a word: number of the text, line number, 64-bit line hash, leaf hash, 16 bits per token.

    A line with fewer than MIN_TOKENS tokens, or fewer constants than MIN_CONSTANT of them, counts only as it
    is: its hash is that of its tokens without wildcards, and its codes are empty.
    """
    owner, numbers, n, flat, whole_only = [], [], [], [], []
    for at, text in enumerate(texts):
        for k, line in enumerate(text.split(b"\n")):
            if not _WORD.search(line):
                continue
            tokens = masked_tokens(line)
            general = len(tokens) >= MIN_TOKENS and len(tokens) - tokens.count(WILDCARD) >= MIN_CONSTANT * len(tokens)
            owner.append(at)
            numbers.append(k)
            n.append(len(tokens))
            flat += tokens if general else line.split()
            whole_only.append(not general)
    if not numbers:
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64), []
    n = np.array(n)
    first = np.cumsum(n) - n
    hashes = mix(word_hashes(flat))
    place = (np.arange(len(hashes)) - np.repeat(first, n)).astype(np.uint64)
    with np.errstate(over="ignore"):
        whole = mix(np.add.reduceat(mix(hashes + place * np.uint64(0x9E3779B97F4A7C15)), first) + n.astype(np.uint64))
        leaf = n.astype(np.uint64)
        for j in range(DEPTH):
            leaf = mix(leaf * np.uint64(0x9E3779B97F4A7C15) + hashes[first + np.minimum(j, n - 1)])
    codes = (hashes >> np.uint64(48)).astype("<u2").tobytes()
    return np.array(owner), numbers, whole.view(np.int64), leaf.view(np.int64), [
        b"" if w else codes[a:b] for a, b, w in zip((2 * first).tolist(), (2 * (first + n)).tolist(), whole_only, strict=True)]


def _key(docs: DataFrame, id_col: str, text_col: str) -> tuple:
    return F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("doc_hash")


def document_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_hash, line, leaf, codes), one row per document and distinct line with a word."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("doc_hash", pa.int64()), ("line", pa.int64()), ("leaf", pa.int64()), ("codes", pa.binary())])

    def hash_lines(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            for low, high in text_groups(texts, GROUP_BYTES):
                owner, _, line, leaf, codes = line_hashes(texts[low:high])
                order = np.lexsort((line, owner))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(line[order]) != 0) | (np.diff(owner[order]) != 0)
                once = order[new]
                for at in range(0, len(once), 4096):
                    pick = once[at:at + 4096]
                    doc = pa.array(low + owner[pick])
                    yield batch_of(schema, {"doc_id": batch.column(0).take(doc), "doc_hash": batch.column(1).take(doc),
                                            "line": line[pick], "leaf": leaf[pick], "codes": [codes[i] for i in pick.tolist()]})

    rows = docs.select(*_key(docs, id_col, text_col), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(hash_lines, "doc_id long, doc_hash long, line long, leaf long, codes binary")


def _vote(rest: DataFrame) -> DataFrame:
    """(leaf, template): the most frequent code of each position, as a binary like ``codes``."""
    schema = pa.schema([("leaf", pa.int64()), ("place", pa.int32()), ("code", pa.int32())])

    def spread(batches):
        for batch in batches:
            for leaf, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(codes, "<u2").astype(np.int32)
                for at in range(0, len(x), 65536):
                    part = x[at:at + 65536]
                    yield batch_of(schema, {"leaf": np.full(len(part), leaf, np.int64),
                                            "place": np.arange(at, at + len(part), dtype=np.int32), "code": part})

    votes = rest.select("leaf", "codes").mapInArrow(spread, "leaf long, place int, code int")
    best = (votes.groupBy("leaf", "place", "code").agg(F.count("*").alias("n"))
            .groupBy("leaf", "place").agg(F.max(F.struct("n", "code")).alias("m")))
    # Per leaf, one entry per position of its lines.
    return best.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("place", F.col("m.code").alias("code")))).alias("t")).select(
        "leaf", F.transform("t", lambda s: s["code"]).alias("template"))


def _agreeing(rest: DataFrame, templates: DataFrame) -> DataFrame:
    """The rows of ``rest`` that agree with their leaf's template in SIMILARITY of the positions."""
    fields = rest.columns
    joined = rest.join(templates, "leaf").select(*fields, "template")

    def agree(batches):
        for batch in batches:
            mask = []
            for codes, template in zip(batch.column("codes").to_pylist(), batch.column("template").to_pylist(), strict=True):
                x = np.frombuffer(codes, "<u2")
                same = len(x) == len(template) and (x == np.array(template, np.uint16)).sum()
                mask.append(bool(same >= SIMILARITY * len(x)))
            yield batch.filter(pa.array(mask, pa.bool_())).drop_columns(["template"])

    return joined.mapInArrow(agree, T.StructType([rest.schema[c] for c in fields]))


def _linked(every: DataFrame, voted: DataFrame | None, min_docs: int) -> DataFrame:
    """(line, template) of the lines placed by votes or by links between the lines of a leaf.

    In leaves where the votes left lines over, agreeing lines are joined to
    components. Of the templates in a component all become one.
    """
    distinct = every.groupBy("line").agg(F.first("leaf").alias("leaf"), F.first("codes").alias("codes"))
    if voted is None:
        voted = every.sparkSession.createDataFrame([], "line long, template long, leaf long")
    named = distinct.select("line", "leaf").join(voted.select("line", "template"), "line", "left")
    left = named.where("template is null").select("leaf").distinct()
    lone = every.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    # Leaves with lines left over, as sets of (leaf, place, code).
    own = distinct.join(left, "leaf", "left_semi").join(lone, "leaf", "left_semi").select("line", "leaf", "codes")
    schema = pa.schema([("uid", pa.int64()), ("leaf", pa.int64()), ("items", pa.binary())])

    def pack(batches):
        for batch in batches:
            out = []
            for leaf, codes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x = np.frombuffer(codes, "<u2").astype(np.uint64)
                with np.errstate(over="ignore"):
                    x = mix(mix(np.uint64(leaf & 0xFFFFFFFFFFFFFFFF) + (np.arange(len(x), dtype=np.uint64) << np.uint64(16))) + x)
                out.append(np.unique((x >> np.uint64(32)).astype("<u4")).tobytes())
            yield batch_of(schema, {"uid": batch.column(0), "leaf": batch.column(1), "items": out})

    sets = materialize(own.mapInArrow(pack, "uid long, leaf long, items binary"), "template-sets")
    # Lines of a leaf are of one length: they agree in a share s of it when their Jaccard similarity is s / (2 - s).
    roots = near_components(sets.select("uid", F.array("leaf").alias("keys")), sets.select("uid", "items", F.unhex(F.lit("")).alias("reps")),
                            SIMILARITY / (2 - SIMILARITY) - SLACK, lost=1 - SIMILARITY)
    joined = named.join(roots.select(F.col("node").alias("line"), "root"), "line", "left")
    joined = materialize(joined.where("template is not null or root is not null").select("line", "template", "root"), "template-joined")
    # Templates and components are the two sides of a graph; its components are the templates at last.
    ends = joined.where("template is not null and root is not null").select(
        F.xxhash64("template", F.lit("vote")).alias("a"), F.xxhash64("root", F.lit("link")).alias("b")).distinct()
    whole = connected_components(ends)
    at = joined.select("line", F.when(F.col("template").isNotNull(), F.xxhash64("template", F.lit("vote")))
                       .otherwise(F.xxhash64("root", F.lit("link"))).alias("end"))
    return at.join(whole.withColumnRenamed("node", "end"), "end", "left").select("line", F.coalesce("root", "end").alias("template"))


def recurring_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, doc_hash, line, template, dropped) of the lines whose template recurs in ``min_docs`` documents.

    A document is a distinct (id, text). ``dropped`` is false in the first
    document of a template, by (doc_id, doc_hash) with a null id first.
    """
    lines = materialize(document_lines(docs, id_col=id_col, text_col=text_col), "template-lines")
    doc = F.struct("doc_id", "doc_hash")
    slim = lines.select("doc_id", "doc_hash", "line").distinct()
    same = slim.groupBy("line").agg(F.count("*").alias("n"), F.min(doc).alias("first")).where(F.col("n") >= min_docs)
    same = materialize(same.select("line", "first"), "template-same")
    found = slim.join(same, "line").select("doc_id", "doc_hash", "line", F.col("line").alias("template"),
                                           (~doc.eqNullSafe(F.col("first"))).alias("dropped"))
    found = materialize(found, "template-found")
    general = lines.where(F.length("codes") > 0)
    busy = general.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    rest = general.join(busy, "leaf", "left_semi").join(same.select("line"), "line", "left_anti")
    rest = materialize(rest.dropDuplicates(["doc_id", "doc_hash", "line"]).select(*lines.columns), "template-rest")
    # The votes run over distinct lines of documents; ``voted`` names the template of each line they placed.
    every, voted, turn = rest, None, 0
    while True:
        busy = rest.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf")
        rest = rest.join(busy, "leaf", "left_semi").select(*lines.columns)
        members = materialize(_agreeing(rest, _vote(rest)), "template-members")
        # Lines of one document that share the template count once.
        by_leaf = (members.select("leaf", "doc_id", "doc_hash").distinct().groupBy("leaf")
                   .agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf"))
        new = materialize(members.join(by_leaf, "leaf").select("line", F.xxhash64("leaf", F.lit(turn)).alias("template"), "leaf").distinct(),
                          "template-voted")
        if new.isEmpty():
            break
        voted = new if voted is None else voted.unionByName(new)
        # A leaf without a template in this round has none by votes later either; see _linked for those.
        rest = materialize(rest.join(new.select("leaf").distinct(), "leaf", "left_semi")
                           .join(new.select("line"), "line", "left_anti").select(*lines.columns), "template-rest")
        turn += 1
    placed = _linked(every, voted, min_docs)
    rows = every.select("doc_id", "doc_hash", "line").join(placed, "line")
    docs_of = rows.select("template", "doc_id", "doc_hash").distinct().groupBy("template").agg(
        F.count("*").alias("n"), F.min(doc).alias("first")).where(F.col("n") >= min_docs)
    rows = rows.join(docs_of, "template").select("doc_id", "doc_hash", "line", "template", (~doc.eqNullSafe(F.col("first"))).alias("dropped"))
    return found.unionByName(materialize(rows, "template-found"))


def drop_recurring_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                         chars_col: str | None = None, min_docs: int = MIN_DOCS, counts: bool = False) -> DataFrame:
    """``docs`` with recurring lines dropped from their texts; all columns are kept.

    ``chars_col`` names a column to set to the new length in characters. With
    ``counts``, the columns n_lines and n_dropped follow (in place of columns
    of that name). A null text stays null; a text whose lines are all dropped
    becomes empty.
    """
    found = recurring_lines(docs, id_col=id_col, text_col=text_col, min_docs=min_docs)
    drops = (found.where("dropped").groupBy(F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_hash"))
             .agg(F.collect_set("line").alias("_drop")))
    names = [f"c{i}" for i in range(len(docs.columns))]
    at_text = docs.columns.index(text_col)
    text = F.col(names[at_text])
    joined = docs.toDF(*names).join(
        drops, F.col(names[docs.columns.index(id_col)]).cast("long").eqNullSafe(F.col("_id"))
        & (F.xxhash64(text.cast("string")) == F.col("_hash")), "left").select(*names, "_drop")
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)]
                          + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def rewrite(batches):
        for batch in batches:
            texts, drops = batch.column(at_text).to_pylist(), batch.column("_drop").to_pylist()
            lines, dropped = [t.count("\n") + 1 if t else 0 for t in texts], [0] * len(texts)
            changed = [k for k, (t, drop) in enumerate(zip(texts, drops, strict=True)) if t and drop]
            for low, high in text_groups([texts[k] for k in changed], GROUP_BYTES):
                part = changed[low:high]
                owner, numbers, line, _, _ = line_hashes([texts[k].encode() for k in part])
                first = np.searchsorted(owner, np.arange(len(part) + 1)).tolist()
                for k, a, b in zip(part, first, first[1:], strict=False):
                    drop = set(drops[k])
                    gone = {i for i, x in zip(numbers[a:b], line[a:b].tolist(), strict=True) if x in drop}
                    texts[k] = "\n".join(x for i, x in enumerate(texts[k].split("\n")) if i not in gone)
                    dropped[k] = len(gone)
            cols = [pa.array(texts, pa.string()) if i == at_text else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                                             names=[*names, "n_lines", "n_dropped"])

    out = joined.mapInArrow(rewrite, schema)
    fields = [F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)]
    if chars_col is not None and chars_col in docs.columns:
        k = docs.columns.index(chars_col)
        fields[k] = F.length(text).cast(docs.schema.fields[k].dataType).alias(chars_col)
    if counts:
        fields = [f for f, c in zip(fields, docs.columns, strict=True) if c.lower() not in ("n_lines", "n_dropped")]
    return out.select(*fields, *(["n_lines", "n_dropped"] if counts else []))
