"""Word shingles of whole texts and their MinHash signatures, as numpy arrays in the workers."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
KEEP_WORDS = 500_000
_STEP = 512               # shingles hashed at once: the block of 512 x 128 numbers stays in cache

_rng = np.random.Generator(np.random.PCG64(20240229))
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_PLACE = np.asarray([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(SHINGLE + 1)], np.uint64)
_words: dict[bytes, int] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: five words in a row, after lower-casing A-Z; all of a shorter
    text's words as one; none for a text without words."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()      # bytes: only A-Z, only ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    known = _words
    try:
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > KEEP_WORDS:
            known.clear()
    k = min(SHINGLE, len(words))
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64) * _PLACE[SHINGLE]
    for i in range(k):
        total += h[i:i + n] * _PLACE[i]
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> bytes:
    """The least of each hash function over the set, 32 bits each."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), _STEP):
        low = np.minimum(low, (shingles[a:a + _STEP, None] * _A + _B).min(axis=0))
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())
