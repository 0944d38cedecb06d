"""Small helpers of the operators: words of byte strings as 64-bit hashes, computed by array operations.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Texts are handled in slices of about ``SLICE``
bytes, so a task's memory follows one slice, or one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SLICE = 1 << 20
_U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 20)) * _U(_ODD))


_BYTES = stream(1, 256)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIERS = stream(2, 64) | _U(1)
_powers = np.ones(1, _U)
_inverse = np.ones(1, _U)


def _grow(n: int) -> None:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, SLICE * 2)
        for name, base in (("_powers", _ODD), ("_inverse", pow(_ODD, -1, 1 << 64))):
            steps = np.full(n, base, _U)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=_U)


def slices(texts: Iterable[bytes], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts that together hold about ``limit`` bytes."""
    lo = size = hi = 0
    for hi, text in enumerate(texts, 1):
        size += len(text)
        if size >= limit:
            yield lo, hi
            lo, size = hi, 0
    if lo < hi:
        yield lo, hi


def word_spans(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in order, where they start and end in the joined texts, and for each text (and the
    end) the number of words before it."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    if not len(buf):
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), none, none, np.zeros(len(texts) + 1, np.int64)
    if lower:
        buf = _LOWER[buf]
    inside = ~_BREAK[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[edges] = True
    starts = np.flatnonzero(inside & (first[:-1] | np.concatenate(([True], ~inside[:-1]))))
    ends = np.flatnonzero(inside & (first[1:] | np.concatenate((~inside[1:], [True])))) + 1
    _grow(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTES[buf] * _powers[:len(buf)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _inverse[starts]
    return mix(hashes + (ends - starts).astype(_U)), starts, ends, np.searchsorted(starts, edges)


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text (and the end) the number of words before it."""
    hashes, _, _, edges = word_spans(texts, lower)
    return hashes, edges


def shingle_sets(texts: list[bytes], n: int, lower: bool = True) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its n-word shingles.

    A text of fewer words has one shingle, the whole sequence; a text without words has none.
    """
    words, edges = word_hashes(texts, lower)
    total = max(0, len(words) - n + 1)
    rolled = np.zeros(total, _U)
    for i in range(n):
        rolled += words[i:i + total] * _MULTIPLIERS[i]
    rolled = mix(rolled)
    out = []
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if hi - lo >= n:
            out.append(np.unique(rolled[lo:hi - n + 1]))
        elif hi > lo:
            short = (words[lo:hi] * _MULTIPLIERS[:hi - lo]).sum(dtype=_U) + _U(hi - lo)
            out.append(mix(np.array([short], _U)))
        else:
            out.append(np.zeros(0, _U))
    return out
