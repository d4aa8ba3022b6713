"""Numpy kernels over the words of many texts at once.

A word is a maximal run of bytes other than blank, tab and the line breaks 0x0A to 0x0D; A-Z count as a-z. Texts come
as one byte array with offsets, so the cost per word is a few vector operations and no Python object is made.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


#: Folds ASCII case and turns ASCII other than letters into blanks; other bytes stay.
FOLD = np.full(256, 32, np.uint8)
FOLD[65:91] = FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
#: The same with digits kept.
FOLD_ALNUM = FOLD.copy()
FOLD_ALNUM[48:58] = np.arange(48, 58)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_lower = np.arange(256)
_lower[65:91] += 32
_LUT = mix(_lower.astype(U64) + U64(1))
#: Multipliers of the places within a combination of words.
PLACES = mix(np.arange(1, 129, dtype=U64) * U64(_BASE)) | U64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _grown(name: str, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        step = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            arr = np.full(max(n, 1 << 16), U64(step))
            arr[0] = 1
            _powers[name] = np.cumprod(arr, dtype=U64)
    return _powers[name]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text index and 64-bit hash of every word, in order."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    total = np.zeros(n + 1, U64)
    np.cumsum(_LUT[data] * _grown("up", n)[:n], out=total[1:])
    h = (total[end] - total[start]) * _grown("down", n)[start]
    return start, end, doc, mix(h + (end - start).astype(U64) * U64(_BASE))


def combined(h: np.ndarray, shifts) -> np.ndarray:
    """Hash of the words at ``i + shift`` for every ``i`` where all of them exist."""
    reach = max(shifts)
    n = max(0, len(h) - reach)
    out = np.zeros(n, U64)
    for place, s in enumerate(shifts):
        out += h[s:s + n] * PLACES[place]
    return mix(out)


def shingles(doc: np.ndarray, h: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles as (text index, hash), sorted; a shorter text counts as one shingle of all its words."""
    sh = combined(h, range(k))
    at = doc[:len(sh)]
    whole = at == doc[k - 1:] if len(sh) else np.zeros(0, bool)
    sh, at = sh[whole], at[whole]
    n_words = np.bincount(doc, minlength=n_docs)
    first = np.searchsorted(doc, np.arange(n_docs))
    for n in range(1, k):
        short = np.flatnonzero(n_words == n)
        if len(short):
            x = sum((h[first[short] + j] * PLACES[j] for j in range(n)), np.zeros(len(short), U64))
            sh, at = np.concatenate([sh, mix(x + U64(n * _BASE & (1 << 64) - 1))]), np.concatenate([at, short])
    order = np.lexsort((sh, at))
    sh, at = sh[order], at[order]
    keep = np.ones(len(sh), bool)
    keep[1:] = (sh[1:] != sh[:-1]) | (at[1:] != at[:-1])
    return at[keep], sh[keep]
