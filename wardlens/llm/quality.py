"""Quality rules by distribution divergence from language references (operator 9).

Two histograms of a document are compared with those of its language by the
Jensen-Shannon distance (square root of the divergence to base 2, 0 to 1):

* character classes (``CLASSES``) of all characters that are not white space;
* common words: the words that make up at least ``COMMON_SHARE`` of their
  language (so at most 1 / COMMON_SHARE per language), and one bin for the rest.

The references are sums over the whole corpus, one per value of the language
column (null is a value), from documents that pass the base rules. Those of
languages that hold at least ``LANGUAGE_SHARE`` of all words, at most
1 / LANGUAGE_SHARE of them, are broadcast; the others stay a table keyed by
language that is joined to their documents by a shuffle. Guards: each test
needs a least length, and a language with fewer than ``MIN_REFERENCE_WORDS``
words has no reference, so its documents are not judged by it.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.common import batch_of, bounded_batches, materialize

COMMON_SHARE = 0.002
LANGUAGE_SHARE, MIN_REFERENCE_WORDS = 0.001, 1000
MIN_CHARS, MIN_WORDS = 100, 30
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.25
FLUSH = 300_000

# Fixed rules of the base test.
MIN_BASE_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))

# Character classes, by the first byte of the character.
CLASSES = ("lower", "upper", "digit", "beyond_ascii", "stop", "other_mark", "symbol", "control")


def _class_of(c: int) -> int:
    if c >= 0xC0:
        return 3
    ch = chr(c)
    if c >= 0x80 or c < 0x20 or c == 0x7F or ch == " ":
        return 7
    if ch.islower():
        return 0
    if ch.isupper():
        return 1
    if ch.isdigit():
        return 2
    return 4 if ch in ".,;:?'\"()-" else 5 if ch in "!/@_+=~`^\\[]{}" else 6


_CLASS = bytes(map(_class_of, range(256)))
_LOG_FACTORIAL = np.array([math.lgamma(k + 1) for k in range(91)])


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    word_chars = len(text.translate(None, _CONTINUATION + SPACE))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line.strip(SPACE):
            dup += line in seen
            seen.add(line)
    return word_chars, n_symbols, dup, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words inside a window of REPEAT_WINDOW words that occurs twice or more."""
    k = REPEAT_WINDOW
    grams = list(zip(*(words[i:] for i in range(k)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    count, total, covered = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if count[g] > 1:
            total += i + k - max(i, covered)
            covered = i + k
    return total


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_BASE_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def class_histogram(text: bytes) -> np.ndarray:
    """Characters of each class, without white space and continuation bytes."""
    kinds = text.translate(_CLASS, _CONTINUATION + SPACE)
    return np.array([kinds.count(bytes((k,))) for k in range(len(CLASSES))], np.float64)


def sampling_share(reference: np.ndarray, n: float) -> float:
    """The divergence to expect between a histogram and ``n`` draws from it.

    Per bin the count is Poisson; bins that expect many draws give 1 / (8 n ln 2).
    """
    q = reference[reference > 0] / reference.sum()
    many = n * q > 30
    few = q[~many, None]
    k = np.arange(0, 91)[None, :]
    log_p = k * np.log(n * few) - n * few - _LOG_FACTORIAL[None, :]
    p = k / n
    m = (p + few) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(p > 0, p * np.log2(p / m), 0) + few * np.log2(few / m)
    return float((np.exp(log_p) * gain).sum() / 2 + many.sum() / (8 * np.log(2) * n))


def _usual(reference: np.ndarray, n: float, seen: dict) -> float:
    """:func:`sampling_share` for about ``n`` draws (to one part in twenty), worked out once per length."""
    step = round(math.log(n) / math.log(1.05))
    if step not in seen:
        seen[step] = sampling_share(reference, 1.05 ** step)
    return seen[step]


def js_distance(a: np.ndarray, b: np.ndarray, off: float = 0.0) -> float:
    """Jensen-Shannon distance of two histograms (0 when either is empty), ``off`` taken off the divergence."""
    if not a.sum() or not b.sum():
        return 0.0
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2 - off)))


def _reference(chars: np.ndarray, common: list[tuple[bytes, int]], total: int) -> tuple:
    """(class histogram, {common word: bin}, word histogram, two empty caches)."""
    ranked = sorted(common)
    hist = np.array([n for _, n in ranked] + [total - sum(n for _, n in ranked)], np.float64)
    return chars, {w: i for i, (w, _) in enumerate(ranked)}, hist, {}, {}


def language_references(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text") -> tuple[dict, DataFrame | None]:
    """The references of the large languages by name, and a table (_lang, _total, _rows) of the others.

    The table is None when no other language has enough words. ``_rows`` holds
    (kind, word, n) of the character classes and the common words.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])

    def count(batches):
        words_by, class_by = {}, {}

        def flush():
            for lang, words in words_by.items():
                for at in range(0, len(keys := list(words)), 50_000):
                    part = keys[at:at + 50_000]
                    yield batch_of(schema, {"lang": [lang] * len(part), "kind": [0] * len(part), "word": part,
                                            "n": [words[w] for w in part]})
            words_by.clear()

        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (text or b"").split()
                if base_failed(len(words), repeat_words(words)):
                    continue
                c = words_by.setdefault(lang, Counter())
                before = len(c)
                c.update((text or b"").lower().split())
                size += len(c) - before
                class_by[lang] = class_by.get(lang, 0) + class_histogram(text)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()
        for lang, hist in class_by.items():
            yield batch_of(schema, {"lang": [lang] * len(hist), "kind": list(range(1, len(hist) + 1)),
                                    "word": [b""] * len(hist), "n": hist.astype(np.int64)})

    rows = docs.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string").cast("binary"))
    # One row per language and distinct word, of which only the common ones come back.
    counts = rows.mapInArrow(count, "lang string, kind int, word binary, n long").groupBy("lang", "kind", "word").agg(
        F.sum("n").alias("n"))
    counts = materialize(counts, "quality-counts")
    total = counts.where("kind = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    enough = total.where(F.col("total") >= MIN_REFERENCE_WORDS)
    every = total.agg(F.sum("total")).first()[0] or 0
    large = {r["lang"]: r["total"] for r in enough.where(F.col("total") >= LANGUAGE_SHARE * every).collect()}
    small = enough.where(F.col("total") < LANGUAGE_SHARE * every)
    same_lang = F.col("c.lang").eqNullSafe(F.col("t.lang"))
    common = (F.col("c.kind") > 0) | (F.col("c.n") >= COMMON_SHARE * F.col("t.total"))
    table = None
    if not small.isEmpty():
        rows_of = F.collect_list(F.struct("c.kind", "c.word", "c.n"))
        table = counts.alias("c").join(small.alias("t"), same_lang).where(common).groupBy(F.col("c.lang").alias("_lang")).agg(
            F.first("t.total").alias("_total"), rows_of.alias("_rows"))
        table = materialize(table, "quality-references")
    if not large:
        return {}, table
    shares = spark.createDataFrame([(k, v) for k, v in large.items()], "lang string, total long")
    kept = counts.alias("c").join(F.broadcast(shares).alias("t"), same_lang).where(common).select("c.lang", "kind", "word", "n")
    chars = {k: np.zeros(len(CLASSES)) for k in large}
    words: dict = {k: [] for k in large}
    for r in kept.collect():
        if r["kind"]:
            chars[r["lang"]][r["kind"] - 1] = r["n"]
        else:
            words[r["lang"]].append((bytes(r["word"]), r["n"]))
    return {lang: _reference(chars[lang], words[lang], n) for lang, n in large.items()}, table


class _Joined:
    """References read from the joined rows of the table of small languages, the last one kept."""

    def __init__(self):
        self.lang, self.found = object(), None

    def get(self, lang, total, rows):
        if total is None:
            return None
        if lang != self.lang:
            chars = np.zeros(len(CLASSES))
            for r in rows:
                if r["kind"]:
                    chars[r["kind"] - 1] = r["n"]
            self.lang, self.found = lang, _reference(chars, [(r["word"], r["n"]) for r in rows if not r["kind"]], total)
        return self.found


def _with_references(rows: DataFrame, lang_col: str, large: dict, table: DataFrame | None, run) -> DataFrame:
    """``run`` on the rows of large languages, and on those of the others joined to ``table``."""
    if table is None:
        return run(rows)
    lang = F.col(lang_col).cast("string")
    names = [k for k in large if k is not None]
    is_large = F.coalesce(lang.isin(names), F.lit(False)) if names else F.lit(False)
    if None in large:
        is_large = is_large | lang.isNull()
    joined = rows.where(~is_large).join(table.hint("merge"), lang.eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return run(rows.where(is_large)).unionByName(run(joined))


def divergences(text: bytes, words: list[bytes], reference: tuple | None) -> tuple[float | None, float | None]:
    """Distances of characters and of common words; None where a guard applies."""
    if reference is None:
        return None, None
    chars, bins, hist, seen_chars, seen_words = reference
    own = class_histogram(text)
    char = js_distance(own, chars, _usual(chars, own.sum(), seen_chars)) if own.sum() >= MIN_CHARS and chars.sum() else None
    word = None
    if len(words) >= MIN_WORDS and len(bins):
        count = np.zeros(len(bins) + 1)
        for w in text.lower().split():
            count[bins.get(w, len(bins))] += 1
        word = js_distance(count, hist, _usual(hist, count.sum(), seen_words))
    return char, word


def judged(char: float | None, word: float | None) -> bool:
    """The method's verdict: no distance is above its limit."""
    return (char is None or char <= MAX_CHAR_DISTANCE) and (word is None or word <= MAX_WORD_DISTANCE)


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """One row per document: base counts, base_failed, both distances and kept.

    A null text has no words and fails the base rule. Other columns are ignored.
    """
    large, small = language_references(docs, lang_col=lang_col, text_col=text_col)
    refs = docs.sparkSession.sparkContext.broadcast(large)
    schema = pa.schema([(id_col, pa.int64())] + [(c, pa.int64()) for c in
                       ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                       + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("char_distance", pa.float64()),
                          ("word_distance", pa.float64())])

    def judge(batches):
        table, joined = refs.value, _Joined()
        for batch in batches:
            out = []
            for d, text, lang, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or b""
                words = text.split()
                counts = base_counts(text, words)
                failed = base_failed(len(words), counts[3])
                char, word = divergences(text, words, joined.get(lang, *own) if own else table.get(lang))
                out.append((d, len(words), *counts, failed, not failed and judged(char, word), char, word))
            cols = list(zip(*out, strict=True))
            if cols:
                yield batch_of(schema, dict(zip(schema.names, map(list, cols), strict=True)))

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").cast("binary").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    columns = (f"{id_col} long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "base_failed boolean, kept boolean, char_distance double, word_distance double")
    return _with_references(rows, "lang", large, small, lambda part: part.mapInArrow(judge, columns))


def quality_filter(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the documents that fail the base rules or the verdict; all columns are kept."""
    large, small = language_references(docs, lang_col=lang_col, text_col=text_col)
    refs = docs.sparkSession.sparkContext.broadcast(large)
    at_text, at_lang = docs.columns.index(text_col), docs.columns.index(lang_col)

    names = [f"c{i}" for i in range(len(docs.columns))]

    def keep(batches):
        table, joined = refs.value, _Joined()
        for batch in batches:
            mask = []
            extra = [c.to_pylist() for c in batch.columns[len(names):]]
            for i, (text, lang) in enumerate(zip(batch.column(at_text).to_pylist(), batch.column(at_lang).to_pylist(), strict=True)):
                text = (text or "").encode()
                words = text.split()
                mask.append(not base_failed(len(words), repeat_words(words)) and judged(*divergences(
                    text, words, joined.get(lang, *(c[i] for c in extra)) if extra else table.get(lang))))
            yield pa.RecordBatch.from_arrays(batch.columns[:len(names)], names=names).filter(pa.array(mask, pa.bool_()))

    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)])
    out = _with_references(docs.toDF(*names), names[at_lang], large, small, lambda part: part.mapInArrow(keep, schema))
    return out.toDF(*docs.columns)
