"""Counts over one whole text, shared by the quality operators.

Words are runs of anything but the six ASCII white-space characters; lines are cut at line feeds.
A null text counts as one without words.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
WINDOW = 8                # words of the window whose repeats are counted
STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_unique", "n_adjacent"]
_POWERS = np.asarray([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WINDOW)], np.uint64)


def _pair_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs, exactly."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


def repeated_words(ids: np.ndarray) -> int:
    """Words inside a window of eight that is found twice or more, its first place included."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        h = ids.astype(np.uint64)
        h = sum(h[k:k + n] * _POWERS[k] for k in range(WINDOW))
    h.sort()
    if not (h[1:] == h[:-1]).any():      # equal windows have equal hashes, so there is none
        return 0
    two = _pair_ids(ids[:-1], ids[1:])
    four = _pair_ids(two[:-2], two[2:])
    eight = _pair_ids(four[:-4], four[4:])
    again = np.bincount(eight)[eight] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:n] += again
    edges[WINDOW:WINDOW + n] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``STATS``."""
    if not text:
        return (0,) * len(STATS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    space = len(data) - sum(map(len, words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    add = seen.setdefault
    ids = np.fromiter((add(w, len(seen)) for w in words), np.int64, len(words))
    adjacent = int((ids[1:] == ids[:-1]).sum()) if len(ids) > 1 else 0
    return (len(words), len(text) - space, sum(map(data.count, (SYMBOLS[i:i + 1] for i in range(len(SYMBOLS))))),
            len(lines), len(lines) - len(set(lines)), repeated_words(ids), len(seen), adjacent)


#: further features of the classifier, after those made from STATS
def char_features(text: str | None) -> tuple[float, ...]:
    """Shares of the text's bytes by kind, and the entropy of its bytes."""
    if not text:
        return (0.0,) * 7
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = np.bincount(data, minlength=256)
    total = len(data)
    share = n[n > 0] / total
    return (n[48:58].sum() / total, n[65:91].sum() / total, n[97:123].sum() / total, n[128:].sum() / total,
            (n[44] + n[46]) / total, n[10] / total, float(-(share * np.log2(share)).sum()))
