"""Word and window hashing shared by the operators that compare texts.

Words are runs of characters other than ASCII whitespace. All hashes are
64-bit values in numpy arrays and depend on the content alone, so equal word
sequences hash alike in every task, partition and run.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np

_MIX1 = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_MIX3 = np.uint64(0x94D049BB133111EB)
_S27, _S30, _S31, _S17, _S47 = (np.uint64(n) for n in (27, 30, 31, 17, 47))
MEMO_LIMIT = 300_000


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; none for null. ``bytes.split`` separates at
    space and U+0009 to U+000D, and at nothing else."""
    return text.split() if text else []


class WordHashes(dict):
    """Memo of 64-bit word hashes, emptied when it has ``MEMO_LIMIT`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_runs(texts: list[bytes | None], memo: WordHashes, limit: int = 200_000):
    """Word hashes of consecutive texts in a row, about ``limit`` words at a
    time (or one text): yields the place of the first text, the number of words
    of each, and the hashes."""
    first, counts, parts, total = 0, [], [], 0
    for k, text in enumerate(texts):
        hashes = memo.of(words_of(text))
        counts.append(len(hashes))
        parts.append(hashes)
        total += len(hashes)
        if total >= limit:
            yield first, np.array(counts, np.int64), np.concatenate(parts)
            first, counts, parts, total = k + 1, [], [], 0
    if counts:
        yield first, np.array(counts, np.int64), np.concatenate(parts)


_PLACES, _SLICE = 64, 1 << 18
_GAP = re.compile(rb"[\t-\r ]")
_IN_WORD = np.array([not _GAP.match(bytes([b])) for b in range(256)])


def _place_values(keys: np.ndarray) -> np.ndarray:
    return mix(mix(keys.astype(np.uint64) + _MIX1))


def _hash_slice(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    at = np.flatnonzero(inside)
    keys = ((at - np.repeat(starts, lengths)) << 8) | data[at]
    far = np.flatnonzero(keys >= _PLACES << 8)
    values = _VALUES[np.minimum(keys, (_PLACES << 8) - 1)]
    values[far] = _place_values(keys[far])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(lengths)
    return starts, mix(sums[ends] - sums[ends - lengths])


def hash_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word: a sum of one random value for each
    byte at its place in the word, without a Python object per word. Long
    texts are hashed in slices that end between words."""
    data, starts, hashes, at = np.frombuffer(text, np.uint8), [], [], 0
    while at < len(text):
        gap = _GAP.search(text, at + _SLICE)
        end = gap.start() if gap else len(text)
        first, values = _hash_slice(data[at:end])
        starts.append(first + at)
        hashes.append(values)
        at = end
    return (np.concatenate([np.empty(0, np.int64), *starts]),
            np.concatenate([np.empty(0, np.uint64), *hashes]))


def hashed_runs(texts: list[bytes | None], limit: int = _SLICE):
    """What ``word_runs`` yields, about ``limit`` bytes at a time, with the
    hashes of ``hash_words``."""

    def hashed(parts):
        ends = np.cumsum([0] + [len(p) + 1 for p in parts])
        starts, hashes = hash_words(b" ".join(parts))
        return np.diff(np.searchsorted(starts, ends)), hashes

    first, parts, size = 0, [], 0
    for k, text in enumerate(texts):
        parts.append(text or b"")
        size += len(parts[-1])
        if size >= limit:
            yield first, *hashed(parts)
            first, parts, size = k + 1, [], 0
    if parts:
        yield first, *hashed(parts)


def whole_windows(counts: np.ndarray, n: int) -> np.ndarray:
    """Mask over the starts of windows of ``n`` words in a run of texts: those
    that end inside the text in which they start."""
    ends = np.repeat(np.cumsum(counts), counts)
    size = max(0, len(ends) - n + 1)
    return np.arange(n, n + size) <= ends[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the output."""
    x = (x ^ (x >> _S30)) * _MIX2
    x = (x ^ (x >> _S27)) * _MIX3
    return x ^ (x >> _S31)


_VALUES = _place_values(np.arange(_PLACES << 8))


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hashes."""
    x = left * _MIX1 + ((right << _S17) | (right >> _S47))
    return (x ^ (x >> _S30)) * _MIX2 ^ right


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` consecutive word hashes, by start.

    Windows are joined from windows of powers of two, so the cost is
    logarithmic in ``n``. Empty if there are fewer than ``n`` words.
    """
    if len(words) < n:
        return np.empty(0, np.uint64)
    result, covered, power, level = None, 0, 1, words
    while True:
        if n & power:
            if result is None:
                result = level
            else:
                size = len(words) - covered - power + 1
                result = _pair(result[:size], level[covered:covered + size])
            covered += power
        if covered == n:
            return result
        level = _pair(level[:-power], level[power:])
        power *= 2


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive values, by start."""
    if len(x) < n:
        return x[:0]
    span = 1
    while 2 * span <= n:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = n - span
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def covered_words(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask over ``total`` words of those inside a window of ``n`` words that
    begins at one of ``starts``."""
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + n, total), -1)
    return np.cumsum(edges[:total]) > 0
