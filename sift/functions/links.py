"""Exact markdown-link fixed point (F5), the one per-row Python helper.

This module is pickled by value, so executors run it without having the
package installed (only pandas and ``re`` are needed there).
"""

from __future__ import annotations

import re
import sys
from collections import deque

import pandas as pd
from pyspark import cloudpickle

_CLOSE = "](http"
_STOP = re.compile("[ )]")


class _Kept:
    """The kept text so far, as a linked list of ranges of the input, so that a
    bracket can be taken out, and the end cut, at once."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends, self.before, self.after = text, [], [], [], []
        self.last = -1

    def add(self, start: int, end: int) -> int:
        node = len(self.starts)
        self.starts.append(start)
        self.ends.append(end)
        self.before.append(self.last)
        self.after.append(-1)
        if self.last >= 0:
            self.after[self.last] = node
        self.last = node
        return node

    def remove(self, node: int) -> None:
        before, after = self.before[node], self.after[node]
        if before >= 0:
            self.after[before] = after
        if after >= 0:
            self.before[after] = before
        else:
            self.last = before
        self.ends[node] = self.starts[node]

    def cut(self, count: int) -> None:
        """Drop the last ``count`` characters."""
        while count:
            size = min(count, self.ends[self.last] - self.starts[self.last])
            self.ends[self.last] -= size
            count -= size
            if self.ends[self.last] == self.starts[self.last]:
                self.remove(self.last)

    def tail(self, count: int) -> str:
        parts, node = [], self.last
        while node >= 0 and count:
            start = max(self.starts[node], self.ends[node] - count)
            parts.append(self.text[start:self.ends[node]])
            count -= self.ends[node] - start
            node = self.before[node]
        return "".join(reversed(parts))

    def whole(self) -> str:
        return "".join(self.text[a:b] for a, b in zip(self.starts, self.ends))


def strip_links_exact(text: str) -> str:
    """Replace ``[label](http...)`` by ``label`` until none is left.

    A link is a "[" whose first following "](http" starts an address that
    reaches ")" before any space; the leftmost link is rewritten first. In one
    pass from left to right: a "](http" whose address ends well takes the
    leftmost open "[" since the last one that did not (which stays, and stops
    every "[" before it). What a rewrite leaves may form a "](http" with the
    text behind it, so the seam is looked at again. Every character is read a
    bounded number of times.
    """
    if _CLOSE not in text:
        return text
    kept, opened = _Kept(text), deque()  # open: brackets that no "](http" has stopped
    at, stop, seam = 0, -1, False

    def take(start: int, end: int) -> None:
        while start < end:
            bracket = text.find("[", start, end)
            if bracket < 0:
                kept.add(start, end)
                return
            if bracket > start:
                kept.add(start, bracket)
            opened.append(kept.add(bracket, bracket + 1))
            start = bracket + 1

    while True:
        tail = kept.tail(len(_CLOSE) - 1) if seam else ""
        split = (tail + text[at:at + len(_CLOSE) - 1]).find(_CLOSE) if seam else -1
        seam = False
        if split >= 0:  # part of it is kept already
            inside, close = len(tail) - split, at
            address = at + len(_CLOSE) - inside
        else:
            inside, close = 0, text.find(_CLOSE, at)
            if close < 0:
                take(at, len(text))
                return kept.whole()
            take(at, close)
            address = close + len(_CLOSE)
        if opened:
            if stop < address:
                found = _STOP.search(text, address)
                stop = found.start() if found else len(text)
            if stop < len(text) and text[stop] == ")":
                kept.cut(inside)
                kept.remove(opened.popleft())
                at, seam = stop + 1, True
                continue
        opened.clear()
        take(close, address)
        at = address


def strip_links_series(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else strip_links_exact(t))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
