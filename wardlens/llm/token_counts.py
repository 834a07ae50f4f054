"""Token counts by a two-tier lookup of pre-token lengths (operator 13).

A byte-level BPE tokenizer first cuts a text into pre-tokens (a regular
expression), then merges inside each; so a text's count is the sum of its
pre-tokens' lengths, and the length of a pre-token never changes.

* First tier: a table of the ``head`` most frequent pre-tokens of a bounded
  sample and their lengths, broadcast (at most ``HEAD`` entries of at most
  ``MAX_UNIT_CHARS`` characters: a few MB whatever the input). The sample only
  decides which pre-tokens are looked up fast; no result depends on it.
* Second tier: each Python worker encodes what the table lacks with the
  library, once, and keeps the length in a bounded cache.

Texts stay where they were read: nothing is shuffled but the sampled texts.

Texts in which the library cuts otherwise than the pattern (they spell a special token,
or hold a character that the library's Unicode tables class differently, found by asking
it once per character) are counted by the library whole.

Defined results: a null text counts as empty (0 bytes, 0 tokens); null and
repeated ids pass through, one row per input row; an empty table gives no rows;
columns other than the id and the text are not read. A very long text is
counted in pieces cut where a white space follows a word, so the pre-tokens of
only one piece are held.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.common import batch_of, bounded_batches, text_or_empty

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

HEAD = 1 << 16
SAMPLE_TEXTS = 2000
SAMPLE_TASKS = 8
MAX_CACHED = 600_000
MAX_UNIT_CHARS = 48
PIECE_CHARS = 1 << 20
_WORD_END = regex.compile(r"\S(?=\s)")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, each cut between a word and the white space after it."""
    at = 0
    while len(text) - at > size:
        end = _WORD_END.search(text, at + size)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:] if at else text


class LengthTable:
    """Lengths in tokens: ``count(texts)`` gives each text's."""

    def __init__(self, path: str, pattern: str, head: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile(pattern).findall
        self.head = head or {}
        self.known = dict(self.head)
        self.asked: set[str] = set()
        self.odd: set[str] = set()

    def _library(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _classed_alike(self, c: str) -> bool:
        """Whether the library cuts around ``c`` as the pattern does, after a letter, digit, sign and space."""
        probe = f"a{c}1{c}.{c} {c}{c}\n"
        return [probe[i:j] for _, (i, j) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] == self.cut(probe)

    def _whole(self, text: str) -> bool:
        """Whether the library has to see the whole text."""
        if not text.isascii():
            chars = {c for c in set(text) if c > "\x7f"}
            for c in chars - self.asked:
                self.asked.add(c)
                if not self._classed_alike(c):
                    self.odd.add(c)
            if not self.odd.isdisjoint(chars):
                return True
        return any(s in text for s in self.special)

    def _learn(self, units: set[str]) -> None:
        """Second tier: lengths of pre-tokens that are not known yet."""
        if units:
            new = list(units)
            self.known.update(zip(new, self._library(new), strict=True))

    def _forget(self, units: set[str]) -> None:
        """Keep the cache within its bound: back to the broadcast table when full, and no long pre-tokens."""
        if len(self.known) > MAX_CACHED + len(self.head):
            self.known = dict(self.head)
            return
        for u in units:
            if len(u) > MAX_UNIT_CHARS:
                self.known.pop(u, None)

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        short: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            if self._whole(text):
                out[i] = self._library([text])[0]
            elif len(text) > PIECE_CHARS:
                out[i] = sum(self._sum([self.cut(p)])[0] for p in pieces(text))
            else:
                short.append((i, self.cut(text)))
        for (i, _), n in zip(short, self._sum([u for _, u in short]), strict=True):
            out[i] = n
        return out

    def _sum(self, cuts: list[list[str]]) -> list[int]:
        new = set(chain.from_iterable(cuts)).difference(self.known)
        self._learn(new)
        length = self.known.__getitem__
        out = [sum(map(length, units)) for units in cuts]
        self._forget(new)
        return out


_TABLES: dict[str, LengthTable] = {}


def _worker_table(job: str, path: str, pattern: str, head: Broadcast | None = None) -> LengthTable:
    """This worker's table for ``job``; it outlives the task, so later tasks find the cache filled."""
    if job not in _TABLES:
        _TABLES.clear()  # one job's table at a time
        _TABLES[job] = LengthTable(path, pattern, head.value if head is not None else None)
    return _TABLES[job]


def frequent_lengths(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", head: int = HEAD,
                     sample_texts: int = SAMPLE_TEXTS) -> dict[str, int]:
    """The ``head`` most frequent pre-tokens of about ``sample_texts`` texts, with their lengths.

    Each of ``SAMPLE_TASKS`` tasks brings back its ``head`` most frequent
    pre-tokens at most, so the driver merges a bounded number.
    """
    spark, job = docs.sparkSession, uuid.uuid4().hex
    n = docs.count()
    if not n or head < 1:
        return {}
    schema = pa.schema([("unit", pa.string()), ("n", pa.int64()), ("length", pa.int64())])

    def tally(batches):
        table, seen = _worker_table(job, path, pattern), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                if not table._whole(text):
                    for p in pieces(text):
                        seen.update(u for u in table.cut(p) if len(u) <= MAX_UNIT_CHARS)
                if len(seen) > 8 * head:
                    seen = Counter(dict(seen.most_common(head)))
        top = seen.most_common(head)
        yield batch_of(schema, {"unit": [u for u, _ in top], "n": [c for _, c in top],
                                "length": table._library([u for u, _ in top])})

    bounded_batches(spark)
    sampled = docs.select(text_or_empty(text_col).alias("text")).sample(min(1.0, sample_texts / n), 7)
    rows = sampled.repartition(SAMPLE_TASKS).mapInArrow(tally, "unit string, n long, length long").toArrow()
    total: Counter = Counter()
    length: dict[str, int] = {}
    for u, c, k in zip(*(rows.column(c).to_pylist() for c in ("unit", "n", "length")), strict=True):
        total[u] += c
        length[u] = k
    return {u: length[u] for u, _ in total.most_common(head)}


def token_counts(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, head: int = HEAD) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    ``path`` is a byte-level BPE tokenizer file and ``pattern`` its pre-token
    pattern. The count is the library's for the whole text, without added
    special tokens; ``over_limit`` is ``n_tokens > limit``.
    """
    spark, job = docs.sparkSession, uuid.uuid4().hex
    table = frequent_lengths(docs, path, pattern, text_col=text_col, head=head)
    sent = spark.sparkContext.broadcast(table)
    id_type = docs.schema[id_col].dataType
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("n_bytes", T.LongType()),
                        T.StructField("n_tokens", T.LongType())])

    def count(batches):
        lengths = _worker_table(job, path, pattern, sent)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.binary_length(b.column(1)).cast(pa.int64()),
                 pa.array(lengths.count(b.column(1).to_pylist()), pa.int64())], names=out.names)

    bounded_batches(spark)
    counted = docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(count, out)
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
