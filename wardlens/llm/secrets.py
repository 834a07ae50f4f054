"""Secret scan: key patterns and a token-efficiency test (operator 4).

Spans have a kind, a start and an end (code points, end exclusive):

* ``assign``, ``access``, ``hex``: fixed patterns (a named assignment, an
  access key id, a long hexadecimal run).
* ``token``: runs of key characters that mix letter cases or digits and that a
  byte-pair vocabulary needs many tokens for: fewer than ``MAX_RATIO``
  characters per token (``MAX_PLAIN_RATIO`` for letters of one case). Where a
  run as a whole passes, its parts between separators are tested, then the
  stretches of its tokens that stay below the ratio, so that words joined to a
  key do not hide it. Text in any language is made of pieces the vocabulary
  knows; random strings are not. Left out are known digests (hexadecimal runs
  of 32, 40, 56, 64, 96 or 128 characters), UUIDs, and identifiers (words
  joined by ``_`` or ``-`` or by a change of case, dates, plain numbers),
  and runs that overlap a span of a fixed pattern.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import batch_of, bounded_batches, text_or_empty

# The three base patterns, their order and their least lengths.
KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, as [0-9a-f]+ matches it
MIN_ASSIGN, MIN_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
MIN_TOKEN, MAX_RATIO, MAX_PLAIN_RATIO = 16, 2.0, 1.9
MAX_CACHED = 100_000
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
WORD = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]+)\Z")
_SPLIT = re.compile(r"[_+/=-]+|(?<=[a-z])(?=[A-Z])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_SEPARATORS = "_+/=-"
_PART = re.compile(r"[A-Za-z0-9]{16,}")
_STATE: dict[str, tuple] = {}


def tiktoken_encoding(path: str, pattern: str):
    """The byte-pair encoding of a rank file, without special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _vocabulary(path: str, pattern: str) -> tuple:
    if path not in _STATE:
        _STATE[path] = (tiktoken_encoding(path, pattern), {})
    return _STATE[path]


def known_shape(s: str) -> bool:
    """A digest, a UUID, or an identifier made of words and numbers."""
    if DIGEST.match(s) and len(s) in DIGEST_LENGTHS or UUID.match(s):
        return True
    parts = [p for p in _SPLIT.split(s) if p]
    words = sum(len(p) for p in parts if WORD.match(p) and (len(p) >= 3 or p.isdigit()))
    return len(parts) <= 1 + len(s) // 6 and words >= 0.8 * sum(map(len, parts))


def mixed(s: str) -> bool:
    """Holds a digit next to letters, or upper-case letters inside lower-case ones."""
    letters = any(c.isalpha() for c in s)
    return letters and (any(c.isdigit() for c in s) or (s[1:].lower() != s[1:] and s.upper() != s))


def _random(s: str, encode) -> bool:
    """The test of one string: few characters per token, and no known shape."""
    if len(s) < MIN_TOKEN:
        return False
    if s.isalpha() and not mixed(s):
        return len(s) < MAX_PLAIN_RATIO * len(encode(s))
    return mixed(s) and not known_shape(s) and len(s) < MAX_RATIO * len(encode(s))


def _stretches(lengths: list[int]) -> list[tuple[int, int]]:
    """(start, end) in characters of the stretches of tokens with the most tokens beyond characters / MAX_RATIO.

    A stretch ends where the sum has fallen by MIN_TOKEN below its top.
    """
    out, i, at = [], 0, 0
    n = len(lengths)
    while i < n:
        total = top = 0.0
        j, here, end, after = i, at, at, i
        while j < n:
            total += MAX_RATIO - lengths[j]
            here += lengths[j]
            j += 1
            if total > top:
                top, end, after = total, here, j
            if total < 0 or total < top - MIN_TOKEN:
                break
        if after > i:
            out.append((at, end))
            i, at = after, end
        else:
            i, at = j, here
    return out


def token_spans(s: str, encode) -> list[tuple[int, int]]:
    """(start, end) of the random strings in a run of key characters: the run, else its parts, else stretches of it."""
    if _random(s, encode):
        return [(0, len(s))]
    if DIGEST.match(s) and len(s) in DIGEST_LENGTHS or UUID.match(s):
        return []
    out = [(m.start(), m.end()) for m in _PART.finditer(s) if _random(m.group(), encode)]
    single = encode.__self__.decode_single_token_bytes  # of the tiktoken encoding; runs are ASCII
    lengths = [len(single(t)) for t in encode(s)]
    for a, b in _stretches(lengths):
        # Whole parts: a key may begin or end with a piece that looks like a word.
        while a > 0 and s[a - 1] not in _SEPARATORS and s[a] not in _SEPARATORS:
            a -= 1
        while b < len(s) and s[b] not in _SEPARATORS and s[b - 1] not in _SEPARATORS:
            b += 1
        part = s[a:b]
        a, b = a + len(part) - len(part.lstrip(_SEPARATORS)), b - (len(part) - len(part.rstrip(_SEPARATORS)))
        if a < b and not any(x < b and a < y for x, y in out) and _random(s[a:b], encode):
            out.append((a, b))
    return sorted(out)


def scan_text(text: str, encode, cache: dict) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every span, in order of start, then kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(spans)
    for m in CANDIDATE.finditer(text):
        s = m.group()
        flagged = cache.get(s) if len(s) <= 256 else None
        if flagged is None:
            flagged = token_spans(s, encode)
            if len(s) <= 256:
                if len(cache) >= MAX_CACHED:
                    cache.clear()
                cache[s] = flagged
        at = m.start()
        spans += [(at + i, 3, at + j) for i, j in flagged if not any(a < at + j and at + i < b for a, _, b in base)]
    return sorted(spans)


def scan_secrets(docs: DataFrame, vocabulary_path: str, pattern: str, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: the id column and ``spans``, an array of (kind, start, end).

    A null text counts as empty and has no spans. Each text is scanned whole,
    in one pass without a shuffle; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([(id_col, pa.int64()), ("spans", pa.list_(span))])

    def scan(batches):
        enc, cache = _vocabulary(vocabulary_path, pattern)
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan_text(t, enc.encode_ordinary, cache)]
                     for t in batch.column(1).to_pylist()]
            yield batch_of(schema, {id_col: batch.column(0), "spans": found})

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(scan, f"{id_col} long, spans array<struct<kind:string,start:long,end:long>>")


def span_digest(docs_with_spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the fixed kinds, their SHA-256 and all spans as text."""
    said = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "token")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return docs_with_spans.select(
        id_col, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"),
        count("token").alias("n_token"))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
