"""Words between white space and their 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words a worker remembers before it forgets all of them; bounds its memory, not its results.
MOST_WORDS = 1_000_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def words_of(text: str) -> list[bytes]:
    """Runs without blank and U+0009 to U+000D, A to Z lower-cased: bytes methods know ASCII only."""
    return text.encode().lower().split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MOST_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([_hashes[w] for w in words], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of unsigned 64-bit integers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: Bytes that are hashed at a time; a piece ends between words and is longer only if one word is.
PIECE = 1 << 16
_FACTOR = 0x9E3779B97F4A7C15
#: Bytes of the longest word hashed as a polynomial: modulo a power of two, long words of a regular build have equal ones.
LONGEST = 48
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * SPREAD)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_up, _down = _powers(_FACTOR, 2 * PIECE), _powers(pow(_FACTOR, -1, 1 << 64), 2 * PIECE)


def _hash_piece(raw: np.ndarray) -> np.ndarray:
    """A word is the polynomial of its byte values; differences of prefix sums give it for all words at once. Long words are hashed singly."""
    n = len(raw)
    up, down = (_up, _down) if n <= len(_up) else (_powers(_FACTOR, n), _powers(pow(_FACTOR, -1, 1 << 64), n))
    outside = np.ones(n + 2, bool)
    outside[1:-1] = _IS_WHITE[raw]
    edges = np.flatnonzero(outside[1:] != outside[:-1])
    first, stop = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[raw] * up[:n], out=sums[1:])
    found = mix((sums[stop] - sums[first]) * down[first] + (stop - first).astype(np.uint64))
    for i in np.flatnonzero(stop - first > LONGEST):
        found[i] = xxhash.xxh3_64_intdigest(raw[first[i] : stop[i]].tobytes().lower())
    return found


def hashed_words(text: str) -> np.ndarray:
    """64-bit hashes of a text's words, A to Z lower-cased, in order."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) <= 2 * PIECE:
        return _hash_piece(raw)
    gaps = np.flatnonzero(_IS_WHITE[raw])
    cuts = np.unique(gaps[np.searchsorted(gaps, np.arange(PIECE, len(raw), PIECE)).clip(max=len(gaps) - 1)]) if len(gaps) else gaps
    return np.concatenate([_hash_piece(piece) for piece in np.split(raw, cuts)])
