"""Tokenizer with a bounded cache of already encoded words, kept per Python worker.

Workers start from a shared head: the most frequent units of a bounded sample,
counted and encoded by tasks and broadcast (:func:`share_frequent`; at most ``HEAD``
units of at most ``MAX_UNIT_CHARS`` characters). It saves each worker the warming
of its cache and changes no result. The driver passes the head on as bytes; it
loads no tokenizer and holds no cache.

The byte-pair tokenizers used here never merge across a white-space boundary,
nor between a letter (where the tokenizer normalises, one that stays a letter) and the stops
that end a unit, so a text's ids are the ids
of its white-space separated units in order, and those of a unit like ``word,``
are the ids of ``word`` and of ``,``. The library encodes each distinct such
part once while it stays in the cache (a word of Latin letters by the
tokenizer's model alone, where its normalizer and pre-tokenizer hand such words
on whole); for a tokenizer that ignores case and
white space, ASCII parts that differ only in those share an entry. Texts are cut
into such parts as bytes, many at a time (:func:`cut_parts`). Texts in which this does not hold (they spell a special token, or hold white space
outside space, tab, CR and LF) go to the library whole.
"""

from __future__ import annotations

import os
import re
import string
import struct
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MAX_CACHED = 600_000
MAX_UNIT_CHARS = 48
HEAD = 1 << 17
SAMPLE_TEXTS = 4000
SAMPLE_TASKS = 8
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
# Every character of _ODD_SPACE holds one of these bytes in UTF-8.
_MAYBE_ODD = np.array([b >= 0x80 or b in b"\x0b\x0c\x1c\x1d\x1e\x1f" for b in range(256)])
# A unit is a run of white space with the word that follows it.
_IS_SPACE = np.array([b in b" \n\r\t" for b in range(256)])
# ASCII ones and those of the Latin blocks after them, which no neighbouring letter changes.
_LETTERS = string.ascii_letters + "".join(c for c in map(chr, range(0xC0, 0x250)) if c.isalpha())
# All ASCII punctuation but the apostrophe, which may begin a contraction.
_STOPS = string.punctuation.replace("'", "")
_IS_STOP, _IS_LETTER = (np.array([chr(b) in chars for b in range(256)]) for chars in (_STOPS, string.ascii_letters))
_ENCODERS: dict[tuple, Encoder] = {}


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, head: dict[str, bytes] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.head = head or {}
        self.cache: dict[str, bytes] = dict(self.head)
        ids = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("abXy", " abXy", "\n\tABxY", "abxy")]
        self.folds = all(x == ids[0] for x in ids)
        self.model, self.spelled = self.tokenizer.model, self._spelling()
        letters = "".join(map(chr, self.spelled)).strip(" \n\r\t")
        space = "[ \n\r\t]*" if self.folds else " ?"
        self.plain = re.compile(f"{space}[{letters}]{{1,{MAX_UNIT_CHARS}}}" if letters else "(?!)")

    def _spelling(self) -> dict[int, str]:
        """How the model gets the letters of a word, and the space before it; empty if it gets such words cut or changed."""
        def seen(text):
            text = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
            return [t for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

        if self.tokenizer.pre_tokenizer is None:
            return {}
        out = {}
        for c in _LETTERS:
            got = seen(f"a{c}b")
            if len(got) == 1 and got[0][0] == "a" and got[0][-1] == "b":
                out[ord(c)] = got[0][1:-1]
        known, space = "".join(map(chr, out)), seen(" a")[0][:-1]
        mixed = "".join(map("".join, zip(known, reversed(known), strict=True)))
        words = [text[k:k + n] for text in (known, known[::-1], mixed) for n in (1, 2, 7, MAX_UNIT_CHARS) for k in range(0, len(text), n)]
        if any(out.get(ord(c)) != c for c in string.ascii_lowercase) or any(
                seen(w) != [w.translate(out)] or seen(" " + w) != [space + w.translate(out)] for w in words):
            return {}
        return {**out, ord(" "): space, **({ord(c): "" for c in "\n\r\t"} if self.folds else {})}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of parts: words of letters by the tokenizer's model, which the library hands them to uncut."""
        plain, tokenize, spelled, out, rest = self.plain.fullmatch, self.model.tokenize, self.spelled, {}, []
        for p in parts:
            if plain(p):
                ids = [t.id for t in tokenize(p.replace(" ", spelled[32]) if p.isascii() else p.translate(spelled))]
                out[p] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(p)
        out.update(zip(rest, self._library(rest), strict=True))
        return out

    def _whole(self, text: str) -> bool:
        return bool(_ODD_SPACE.search(text)) or any(s in text for s in self.special)

    def _uncut(self, texts: pa.Array) -> np.ndarray:
        """:meth:`_whole` of each text; only those with a byte that odd white space may hold are searched for it."""
        found = np.zeros(len(texts), bool)
        for s in self.special:
            found |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        data, at = _bytes_of(texts)
        odd = _MAYBE_ODD[data]
        if odd.any():
            before = np.concatenate([[0], np.cumsum(odd)])
            for k in np.flatnonzero((before[at[1:]] > before[at[:-1]]) & ~found):
                found[k] = bool(_ODD_SPACE.search(texts[k].as_py()))
        return found

    def _parts(self, unit: str) -> tuple[str, str]:
        """The word of a unit and the stops after it (none where they may not be cut off)."""
        word = unit.rstrip(_STOPS)
        # A folding tokenizer may end a letter in a mark (U+0130, U+0958), which it joins with the stop;
        # those that the model gets as letters alone do not.
        if not word or not word[-1].isalpha() or (self.folds and not word[-1].isascii() and ord(word[-1]) not in self.spelled):
            word = unit
        stops = unit[len(word):]
        return (word.strip(" \n\r\t").lower() or word if self.folds and word.isascii() else word), stops

    def _add(self, missing: list[str]) -> None:
        """Put parts of :func:`cut_parts` into the cache; only those that end in a stop may be cut further."""
        ends_in_stop = [u for u in missing if u[-1] in _STOPS]
        if ends_in_stop:
            self.add_units(ends_in_stop)
            missing = [u for u in missing if u[-1] not in _STOPS]
        self.cache.update(self._encode_parts(missing))

    def add_units(self, missing: list[str]) -> None:
        """Put units into the cache, asking the library for parts that are new."""
        cache = self.cache
        parts = list(map(self._parts, missing))
        cache.update(self._encode_parts(list({p for pair in parts for p in pair if p and p not in cache})))
        for u, (word, stops) in zip(missing, parts, strict=True):
            if u != word:
                cache[u] = cache[word] + cache[stops] if stops else cache[word]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        uncut = self._uncut(texts)
        parts, index, first = cut_parts(texts.filter(pa.array(~uncut)) if uncut.any() else texts, self.folds)
        cache = self.cache
        known = list(map(cache.get, parts))
        missing = [u for u, ids in zip(parts, known, strict=True) if ids is None]
        if missing:
            self._add(missing)
            new = map(cache.__getitem__, missing)
            known = [next(new) if ids is None else ids for ids in known]
        ids = pa.array(known, pa.large_binary()).take(pa.array(index))
        raw, at = _bytes_of(ids)
        raw, ends = raw.tobytes(), at[first].tolist()
        joined = iter([raw[a:b] for a, b in zip(ends, ends[1:])])
        out = [self._library([texts[k].as_py()])[0] if u else next(joined) for k, u in enumerate(uncut)]
        if len(cache) > MAX_CACHED + len(self.head):
            cache.clear()
            cache.update(self.head)
        for u in missing:
            if len(u) > MAX_UNIT_CHARS:
                cache.pop(u, None)
                cache.pop(self._parts(u)[0], None)
        return out


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large string or binary array's values, one after the other, and where each begins (with the end)."""
    _, offsets, data = values.buffers()
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, len(values) + 1, 8 * values.offset)
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def _unit_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each byte of texts that begin at ``at``, whether a unit begins there."""
    space = _IS_SPACE[data]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[at[:-1][at[:-1] < at[1:]]] = True
    return begins


def _different(data: np.ndarray, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The different strings that begin at ``starts`` (each ends where the next begins), and which of them each is."""
    found = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()


def cut_units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The units of texts (a large string array without nulls), cut at the bytes of the white space.

    Returns the different units, which of them each unit is, and the first unit of each text (with the end).
    """
    data, at = _bytes_of(texts)
    starts = np.flatnonzero(_unit_starts(data, at))
    return *_different(data, starts), np.searchsorted(starts, at)


def _owner(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of the parts that begin at ``starts`` each byte belongs to; ``places`` are positions or a mask."""
    return np.searchsorted(starts, np.flatnonzero(places) if places.dtype == bool else places, "right") - 1


def cut_parts(texts: pa.Array, folds: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """As :func:`cut_units`, with the stops after an ASCII letter cut off as parts of their own.

    With ``folds``, ASCII parts are lower-cased and lose the white space before them (all but those of white space only).
    """
    data, at = _bytes_of(texts)
    if not len(data):
        return [], np.zeros(0, np.int32), np.zeros(len(at), np.int64)
    begins = _unit_starts(data, at)
    stop = _IS_STOP[data]
    ends = np.append(np.flatnonzero(begins)[1:], len(data))
    ends = ends[stop[ends - 1]]
    stop[1:] &= ~stop[:-1]
    runs = np.flatnonzero(stop)
    # The run of stops that closes a unit; where it began in the text before, that text's end is marked already.
    runs = runs[np.searchsorted(runs, ends) - 1]
    runs = runs[runs > 0]
    begins[runs[_IS_LETTER[data[runs - 1]]]] = True
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, at)
    if folds:
        space = _IS_SPACE[data]
        ascii_part = np.ones(len(starts), bool)
        ascii_part[_owner(starts, data >= 0x80)] = False
        # A part is white space alone where its last byte is.
        strip = ascii_part & space[starts] & ~space[np.append(starts[1:], len(data)) - 1]
        upper = np.flatnonzero((data >= 65) & (data <= 90))
        upper = upper[ascii_part[_owner(starts, upper)]]
        data = data.copy()
        data[upper] += 32
        n_drop, drop = strip.astype(np.int64), np.zeros(len(data), bool)
        drop[starts[strip]] = True
        more = np.flatnonzero(space & ~begins)  # white space after white space
        owner = _owner(starts, more)
        drop[more[strip[owner]]] = True
        n_drop += np.bincount(owner[strip[owner]], minlength=len(starts))
        data = data[~drop]
        starts = starts - (np.cumsum(n_drop) - n_drop)
    return *_different(data, starts), first


class SentUnits:
    """Units and their ids, broadcast as one run of bytes; ``value`` is their dictionary."""

    def __init__(self, spark: SparkSession, units: pa.Table):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, units.schema) as out:
            out.write_table(units)
        self.packed = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())

    @property
    def value(self) -> dict[str, bytes]:
        t = pa.ipc.open_stream(self.packed.value).read_all()
        return dict(zip(t.column("unit").to_pylist(), t.column("ids").to_pylist(), strict=True))


class SharedHead:
    """A broadcast head under a name of its own, so a worker keeps one encoder per job."""

    def __init__(self, spark: SparkSession, units: pa.Table):
        self.name, self.sent = uuid.uuid4().hex, SentUnits(spark, units)


_TALLY = pa.schema([("unit", pa.string()), ("n", pa.int64())])
_HEAD = pa.schema([("unit", pa.string()), ("ids", pa.binary())])


def encoded_units(path: str, units: list[str]) -> dict[str, bytes]:
    """The ids of units and of the parts that they were encoded from."""
    own = Encoder(path)
    own.add_units(units)
    return own.cache


def share_frequent(docs: DataFrame, path: str, text_col: str = "text", *, head: int = HEAD,
                   sample_texts: int = SAMPLE_TEXTS) -> SharedHead:
    """The encoded units that are most frequent in about ``sample_texts`` texts of ``docs``.

    Each of ``SAMPLE_TASKS`` tasks counts at most ``head`` units at last, and one encodes the ``head`` most
    frequent of all.
    """
    spark = docs.sparkSession
    n = docs.count()
    if not n:
        return SharedHead(spark, _HEAD.empty_table())

    def tally(batches):
        enc, seen = encoder(path), Counter()
        for b in batches:
            texts = b.column(0).cast(pa.large_string())
            units, index, _ = cut_units(texts.filter(pa.array(~enc._uncut(texts))))
            seen.update({u: int(n) for u, n in zip(units, np.bincount(index, minlength=len(units)), strict=True)
                         if len(u) <= MAX_UNIT_CHARS})
            if len(seen) > 4 * head:
                seen = Counter(dict(seen.most_common(head)))
        top = seen.most_common(head)
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top], pa.string()),
                                          pa.array([c for _, c in top], pa.int64())], schema=_TALLY)

    def encode(batches):
        units = [u for b in batches for u in b.column(0).to_pylist()]
        if units:
            cache = encoded_units(path, units)
            yield pa.RecordBatch.from_arrays([pa.array(cache.keys(), pa.string()), pa.array(cache.values(), pa.binary())],
                                             schema=_HEAD)

    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = texts.sample(min(1.0, sample_texts / n), 7).repartition(SAMPLE_TASKS).mapInArrow(tally, "unit string, n long")
    top = found.groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(head)
    return SharedHead(spark, top.select("unit").coalesce(1).mapInArrow(encode, "unit string, ids binary").toArrow())


def encoder(path: str, shared: SharedHead | None = None) -> Encoder:
    """This worker's encoder for the tokenizer file ``path``, begun with ``shared``."""
    key = (path, shared.name if shared else None)
    if key not in _ENCODERS:
        for old in [k for k in _ENCODERS if k[0] == path]:  # one job's cache at a time
            del _ENCODERS[old]
        _ENCODERS[key] = Encoder(path, shared.sent.value if shared else None)
    return _ENCODERS[key]
