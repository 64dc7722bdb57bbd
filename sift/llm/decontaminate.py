"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items are put into one suffix automaton over words.
Training words are streamed through it; after each word the automaton's state
and length give the longest benchmark passage that ends there. A document word
is *hit* if it lies inside an occurrence of a window: ``window`` consecutive
item words, or a whole item with fewer words than that. Spans of hit words are
removed; a document whose share of hit words exceeds ``max_coverage`` goes.

The benchmark is packed into automata of at most ``max_tokens`` words each
(one, unless the benchmark is huge), so what a task holds is bounded. Each
automaton is one map over the documents: nothing is shuffled, and documents of
any length are streamed.

Defined results: null and empty texts have no words, hits or items and are
kept; null and empty items have no windows; equal items (repeated rows or
equal texts) each count as an item with their own id, repeated ids once; a
null item id is not listed; empty tables give no rows or no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded, field_of, packed, with_field

# Bytes of normalised words: A-Z become a-z, and all but digits, a-z and
# non-ASCII characters separate.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
                else 32 for b in range(256))
_WORD = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over integer words, built item by item."""

    def __init__(self, window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[list[str]] = []   # ids of the items, by place
        self.short: dict[int, list[tuple[int, int]]] = {}  # state -> (words, item) of short items
        self.ends: list[tuple[int, int]] = []  # (state of a prefix, item)
        self.places: dict[tuple, int] = {}
        self.min_words = window

    def add(self, item_id: str, words: list[bytes]) -> None:
        ids = tuple(self.vocab.setdefault(w, len(self.vocab)) for w in words)
        if ids in self.places:
            self.items[self.places[ids]].append(item_id)
            return
        place = self.places[ids] = len(self.items)
        self.items.append([item_id])
        last = 0
        for word in ids:
            last = self._extend(last, word)
            self.ends.append((last, place))
        if len(ids) < self.window:
            self.min_words = min(self.min_words, len(ids))

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        cur = self._state(length[last] + 1, {})
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][word]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return cur

    def _state(self, length: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def finish(self) -> SuffixAutomaton:
        """Mark the states of whole short items and gather the items below
        each state that can stand for a full window."""
        for ids, place in self.places.items():
            if len(ids) < self.window:
                state = 0
                for word in ids:
                    state = self.next[state][word]
                self.short.setdefault(state, []).append((len(ids), place))
        self.below: list[set[int]] = [set() for _ in self.next]
        for state, place in self.ends:
            while self.length[state] >= self.window and place not in self.below[state]:
                self.below[state].add(place)
                state = self.link[state]
        # Short items that end wherever a state ends, through its suffix links.
        self.shorts: list[tuple] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.shorts[state] = self.shorts[self.link[state]] + tuple(self.short.get(state, ()))
        self.any_short = any(self.shorts)
        return self

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans (start, end) of window occurrences in words, and the places
        of the items with occurring windows."""
        ids = list(map(self.vocab.get, words))
        spans, found = [], set()
        known = np.fromiter((i is not None for i in ids), np.bool_, len(ids))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).view(np.int8)))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.min_words:  # a window lies within known words
                self._scan(ids, start, end, spans, found)
        return spans, found

    def _scan(self, ids, start, end, spans, found) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = size = 0
        for i in range(start, end):
            word = ids[i]
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            if size >= window:
                spans.append((i + 1 - window, i + 1))
                full = state
                while length[link[full]] >= window:
                    full = link[full]
                found |= self.below[full]
            if self.any_short:
                for words, place in self.shorts[state]:
                    if words <= size:
                        spans.append((i + 1 - words, i + 1))
                        found.add(place)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` and what stands between them;
    what surrounds a span is joined by one space."""
    if not spans:
        return text
    at = [m.span() for m in _WORD.finditer(text)]
    pieces, pos = [], 0
    for start, end in spans:
        pieces.append(text[pos:at[start][0]].rstrip())
        pos = at[end - 1][1]
    pieces.append(text[pos:].lstrip())
    return " ".join(p for p in (x.strip(" ") for x in pieces) if p)


def automata(benchmark: DataFrame, *, window: int = 10, max_tokens: int = 2_000_000,
             id_col: str = "item_id", text_col: str = "text") -> Iterator[SuffixAutomaton]:
    """Automata over the items, each of at most ``max_tokens`` words (or one
    item), read through the driver item by item."""
    current, tokens = SuffixAutomaton(window), 0
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).where(
        F.col(text_col).isNotNull())
    for item_id, text in rows.toLocalIterator():
        words = normal_words(text.encode("utf-8", "surrogatepass"))
        if not words:
            continue
        if tokens and tokens + len(words) > max_tokens:
            yield current.finish()
            current, tokens = SuffixAutomaton(window), 0
        current.add(item_id, words)
        tokens += len(words)
    yield current.finish()


_OUT = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def find_hits(docs: DataFrame, benchmark: DataFrame, *, window: int = 10,
              max_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text",
              keep_columns: bool = False, **item_cols) -> DataFrame:
    """Per row of ``docs``: its words, the merged spans of hit words (by word,
    end exclusive) and the ids of the items with occurring windows. With
    ``keep_columns`` all columns of ``docs`` come first, in a struct ``doc``."""
    kept = [packed(docs)] if keep_columns else [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    df = bounded(docs).select(*kept, F.lit(0).cast("long").alias("n_words"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
                     F.array().cast("array<string>").alias("items"))
    for automaton in automata(benchmark, window=window, max_tokens=max_tokens, **item_cols):
        df = df.mapInArrow(_scanner(automaton, text_col if keep_columns else None), df.schema)
    return df


def _scanner(sam: SuffixAutomaton, packed_text: str | None):
    def run(batches):
        for batch in batches:
            n_words, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            column = field_of(batch.column("doc"), packed_text) if packed_text else batch.column("text")
            texts = column.cast(pa.binary()).to_pylist()
            for text, (old_spans, old_items) in zip(texts, before):
                words = normal_words(text)
                got, found = sam.hits(words)
                n_words.append(len(words))
                got += [(s["start"], s["end"]) for s in old_spans]
                spans.append([{"start": s, "end": e} for s, e in merged(got)])
                ids = {i for place in found for i in sam.items[place] if i is not None}
                items.append(sorted(ids.union(old_items)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(n_words, pa.int64()), pa.array(spans, _SPANS),
                 pa.array(items, pa.list_(pa.string()))],
                names=batch.schema.names)
    return run


def hit_count() -> F.Column:
    """Words inside the merged spans."""
    return F.coalesce(F.aggregate("spans", F.lit(0).cast("long"),
                                  lambda n, s: n + (s["end"] - s["start"])), F.lit(0).cast("long"))


def _cutter(text_col: str):
    def run(batches):
        for batch in batches:
            doc, spans = batch.column("doc"), batch.column("spans")
            if len(spans.values):
                texts = field_of(doc, text_col)
                cut = [t if not s else without_spans(t, [(x["start"], x["end"]) for x in s])
                       for t, s in zip(texts.to_pylist(), spans.to_pylist())]
                doc = with_field(doc, text_col, pa.array(cut, texts.type))
            yield pa.RecordBatch.from_arrays([doc], names=["doc"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 10,
                  max_coverage: float = 0.8, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the hit spans cut out of the text, without the documents
    whose hit share exceeds ``max_coverage``. Other columns stay as they are."""
    hits = find_hits(docs, benchmark, window=window, text_col=text_col, keep_columns=True, **options)
    kept = hits.where(hit_count() <= max_coverage * F.col("n_words")).select("doc", "spans")
    return kept.mapInArrow(_cutter(text_col), kept.select("doc").schema).select("doc.*")
