"""Words of texts as 64-bit hashes, many texts at a time.

The bytes of a batch are looked up in a table that is zero for separators, and
a word's hash is a difference of running sums of ``table[byte] * P**position``
(modulo 2**64), moved to position 0 by the inverse power and mixed.  Texts are
taken in pieces of about a megabyte cut at separators, so memory does not grow
with a text (only with its longest word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
PIECE = 1 << 20
_RANDOM = np.random.RandomState(20240229)


def _odd(n: int) -> np.ndarray:
    return (_RANDOM.randint(0, 1 << 32, n, dtype=np.uint64) << U(32) | _RANDOM.randint(0, 1 << 32, n, dtype=np.uint64)) | U(1)


_BYTE, _BASE, GRAM, _LENGTH = _odd(256), int(_odd(1)[0]), _odd(32), _odd(64)
_BACK = pow(_BASE, -1, 1 << 64)


def table(separators: set[int]) -> np.ndarray:
    """Value of each byte, A-Z as a-z; 0 for separators."""
    out = _BYTE.copy()
    out[65:91] = out[97:123]
    out[sorted(separators)] = 0
    return out


#: Words are runs of anything but ASCII white space.
BY_SPACE = table({0x20, *range(0x09, 0x0E)})
#: Words are runs of digits, letters a-z and anything beyond ASCII.
BY_LETTER = table({*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)} - {*range(0x41, 0x5B)})

_powers = {"p": np.ones(1, U), "q": np.ones(1, U)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["p"]) < n:
        if n > 4 * PIECE:  # a giant word: not kept
            return tuple(np.cumprod(np.r_[U(1), np.full(n - 1, b, U)]) for b in (_BASE, _BACK))
        n = max(n, PIECE + PIECE // 4)
        for k, b in (("p", _BASE), ("q", _BACK)):
            _powers[k] = np.cumprod(np.r_[U(1), np.full(n - 1, b, U)])
    return _powers["p"], _powers["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def _buffer(data: bytes, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a buffer."""
    v = values[np.frombuffer(data, np.uint8)]
    inside = np.zeros(len(v) + 2, np.int8)
    inside[1:-1] = v != 0
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    p, q = _power(len(v) + 1)
    sums = np.zeros(len(v) + 1, U)
    np.cumsum(v * p[:len(v)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * q[starts]), starts


def _pieces(data: bytes, values: np.ndarray) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE:
        end = at + PIECE
        while end < len(data) and values[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def hash_words(texts: list[str | None], values: np.ndarray) -> Iterator[np.ndarray]:
    """For each text the hashes of its words, in order; none for null."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode()
        if size and size + len(data) > PIECE:
            yield from _group(group, values)
            group, size = [], 0
        if len(data) > PIECE:
            yield np.concatenate([_buffer(x, values)[0] for x in _pieces(data, values)])
        else:
            group.append(data)
            size += len(data) + 1
    yield from _group(group, values)


def _group(group: list[bytes], values: np.ndarray) -> Iterator[np.ndarray]:
    if group:
        found, starts = _buffer(b"\n".join(group) + b"\n", values)
        ends = np.cumsum([len(x) + 1 for x in group])
        yield from np.split(found, np.searchsorted(starts, ends[:-1]))


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; no runs if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U)
    out = words[:n] * GRAM[0]
    for i in range(1, k):
        out += words[i:i + n] * GRAM[i % len(GRAM)]
    return mix(out + _LENGTH[k % len(_LENGTH)])
