"""Word shingles as hashes."""

from __future__ import annotations

import zlib

import numpy as np

SHINGLE = 5
# Words: A-Z lower-cased, runs of digits, letters a-z and characters beyond ASCII.
_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
               for c in range(256))


def shingle_words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), element by element."""
    x = np.array(x, np.uint64)  # a copy, changed in place
    y = x >> np.uint64(30)
    with np.errstate(over="ignore"):
        x ^= y
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.right_shift(x, np.uint64(27), out=y)
        x ^= y
        x *= np.uint64(0x94D049BB133111EB)
        np.right_shift(x, np.uint64(31), out=y)
        x ^= y
    return x


def text_groups(texts: list, size: int):
    """(first, end) of runs of texts that hold about ``size`` characters or bytes (more where one text does).

    Arrays over a run are long enough for numpy and short enough for the processor's caches.
    """
    at = held = 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the runs of ``k`` words (of the whole, when there are fewer; none when there is no word)."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    out = np.full(n - k + 1, k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:n - k + 1 + j] + np.uint64(1))
    return out


def pack_set(hashes: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted distinct 32-bit hashes, and their counts (empty when every count is one)."""
    items, counts = np.unique((hashes >> np.uint64(32)).astype(np.uint32), return_counts=True)
    return items.astype("<u4").tobytes(), b"" if (counts == 1).all() else counts.astype("<u4").tobytes()
