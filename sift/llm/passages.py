"""Passages of a text and what they look like, as numbers."""

from __future__ import annotations

from collections import Counter

import numpy as np

PASSAGE_WORDS = 128

# Classes of ASCII characters counted per passage.
_CLASSES = tuple(s.encode() for s in (
    "#*$%&|<>~^_=+\\{}[]@", "!?", ".,;:", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
    "\"'`()/-"))
_ASCII = bytes(range(128))
FEATURES = len(_CLASSES) + 12


def passage_features(text: bytes | None) -> np.ndarray:
    """One row of ``FEATURES`` numbers per passage of ``PASSAGE_WORDS`` words;
    one row of zeros for a text without a word. Shares are of the passage; the
    last columns describe the whole text."""
    words = text.split() if text else []
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    rows, seen = [], set()
    lines = text.count(b"\n")
    whole = [np.log1p(len(words)), lines / len(words),
             1 - len(set(text.split(b"\n"))) / (lines + 1)]
    for at in range(0, len(words), PASSAGE_WORDS):
        part = words[at:at + PASSAGE_WORDS]
        n = len(part)
        joined = b"".join(part)
        size = len(joined)
        counts = Counter(part)
        triples = set(zip(part, part[1:], part[2:]))
        again = len(triples & seen) / max(1, len(triples))
        seen |= triples
        lengths = list(map(len, part))
        rows.append([(size - len(joined.translate(None, c))) / size for c in _CLASSES] + [
            len(joined.translate(None, _ASCII)) / size, size / n / 10, len(counts) / n,
            max(counts.values()) / n, 1 - len(triples) / max(1, n - 2) if n > 2 else 0.0, again,
            sum(k <= 3 for k in lengths) / n, sum(k >= 12 for k in lengths) / n,
            lengths.count(1) / n] + whole)
    return np.array(rows, np.float32)
