"""Personal data: high-recall generators propose overlapping spans, boosted
trees score them by format and context, calibrated thresholds select.

The base spans of each kind (a fixed pattern and check, leftmost and not
overlapping) are always redacted. The generators propose more: numbers inside
longer runs, phone numbers without a country code, written-out e-mail
addresses, network addresses in runs, and key-like tokens. The trees learn
from every candidate of all texts, counted by their description; a candidate
is a true example if its own characters pass the format and check
of its kind (for tokens: if it has the form of a known key or is assigned to a
key name; for phone numbers without a country code: if the area code stands in
brackets or a phone word stands in the 32 characters before, so that there the
context decides; for e-mail, network addresses and cards the format decides
alone). One part in five of the texts is kept back to set, per kind, the lowest
threshold that reaches the wanted precision there, by steps of 1 / ``STEPS``.

Base spans are found in linear time in texts of any length: numbers within
runs of digits and separators, addresses around each ``@``.

Spans count code points, end exclusive. Defined results: null texts are empty;
repeated rows and ids are scanned row by row; without any candidate only the
base spans are selected; other columns are not read, or kept by ``redact``.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded, field_of, packed, with_field
from sift.llm.boosting import (Cells, Trees, binned, boost_cells, calibrated_threshold, edges_between, quantile_edges,
                               quantile_ranks)
from sift.llm.components import written

KINDS = ("email", "ip", "card", "phone", "secret")  # in the order in which they are listed
EMAIL, IP, CARD, PHONE, SECRET = range(5)

# Words that stand before personal data, by kind; forms of keys.
CONTEXT = (
    ("mail", "e-mail", "email", "contact", "write to", "address"),
    ("ip", "host", "server", "address", "client", "node"),
    ("card", "visa", "mastercard", "credit", "debit", "account", "iban"),
    ("phone", "tel", "call", "fax", "mobile", "cell", "whatsapp"),
    ("token", "key", "secret", "password", "passwd", "api", "auth", "bearer"),
)
PHONE_WORD = re.compile(rf"(?<![a-z])(?:tele|cell)?(?:{'|'.join(CONTEXT[PHONE])})(?:s|e?d|ing)?(?![a-z])", re.I)
KEY_FORM = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|sk-[0-9A-Za-z]{20,}"
                      r"|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ZONE = re.compile(r"[0-9](?:[0-9 ().-]*[0-9])?")  # a run of digits and separators
# Tried only at the first digit of a run, as a match never starts elsewhere.
_DOTTED = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_SPACED = re.compile(r"[0-9](?:[ -]?[0-9])++")
_DIGITS = re.compile(r"[0-9]+")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_WRITTEN = re.compile(r"([A-Za-z0-9._%+-]{1,64}) ?[\[(](?:at|AT)[\])] ?([A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]{1,63}){1,8})")
_TOKEN = re.compile(r"[A-Za-z0-9_+/.-]{16,}+={0,2}")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _ip_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _card_ok(text: str) -> bool:
    digits = re.sub("[ -]", "", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(text: str) -> bool:
    return 10 <= sum(c in "0123456789" for c in text) <= 15


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, not overlapping: each ``@`` with the run of address characters
    before it, back to the end of the match before."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            last = m.end()
        elif start < at:
            last = max(last, start)
        at = text.find("@", max(at + 1, last))
    return out


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of the base spans, and of further candidates."""
    base, more = [], []
    if "@" in text:
        base += [(EMAIL, s, e) for s, e in _emails(text)]
    for zone in _ZONE.finditer(text):
        first, size = zone.start(), zone.end() - zone.start()
        if size < 7:
            continue
        run = zone.group()
        if "." in run:
            for m in _DOTTED.finditer(run):
                span = (IP, first + m.start(), first + m.end())
                (base if _ip_ok(m.group()) else more).append(span)
        if first and text[first - 1] == "+":
            if _phone_ok(run):
                base.append((PHONE, first - 1, zone.end()))
            else:
                more += [(PHONE, first - 1, first + e) for s, e in _parts(run, 10, 15) if s == 0]
        for m in _SPACED.finditer(run):
            span = (CARD, first + m.start(), first + m.end())
            if _card_ok(m.group()):
                base.append(span)
            else:
                more += [(CARD, span[1] + s, span[1] + e) for s, e in _parts(m.group(), 13, 19)]
        for m in _LOCAL_PHONE.finditer(text, first - (first > 0 and text[first - 1] == "("), zone.end()):
            more.append((PHONE, m.start(), m.end()))
    if "at)" in text or "at]" in text or "AT)" in text or "AT]" in text:
        more += [(EMAIL, m.start(), m.end()) for m in _WRITTEN.finditer(text)]
    at = 0
    for word in text.split():
        if len(word) >= 16:
            at = text.index(word, at)
            more += [(SECRET, at + m.start(), at + m.end()) for m in _TOKEN.finditer(word)
                     if _mixed(m.group())]
            at += len(word)
    return base, more


def _mixed(token: str) -> bool:
    return (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)
            and sum(map(token.count, ".-/=")) <= 4)


def _parts(run: str, least: int, most: int) -> list[tuple[int, int]]:
    """Spans of so many digits made of whole groups of a longer run."""
    groups = [m.span() for m in _DIGITS.finditer(run)]
    out = []
    for i, (start, _) in enumerate(groups):
        digits = 0
        for s, e in groups[i:]:
            digits += e - s
            if digits > most:
                break
            if digits >= least:
                out.append((start, e))
    return out


def is_true(kind: int, text: str, before: str) -> bool:
    """Whether a candidate passes the format and check of its kind."""
    if kind == EMAIL:
        plain = re.sub(r" ?[\[(](?:at|AT)[\])] ?", "@", re.sub(r" ?[\[(]dot[\])] ?", ".", text))
        return _emails(plain) == [(0, len(plain))]
    if kind == IP:
        return _ip_ok(text)
    if kind == CARD:
        return _card_ok(text)
    if kind == PHONE:
        digits = sum(c.isdigit() for c in text)
        if text[0] == "+":
            return 10 <= digits <= 15
        return digits == 10 and text[0] == "(" or _called(before)
    return bool(KEY_FORM.fullmatch(text)) or bool(
        re.search(r"(?:token|key|secret|password|passwd)['\"]? ?[=:] ?['\"]?$", before, re.I))


def _called(before: str) -> bool:
    """Whether a number after this text has a phone word before it and is not
    the end of a longer one."""
    return not before[-1:].isdigit() and PHONE_WORD.search(before) is not None


FEATURES = 31


def describe(kind: int, text: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate as ``FEATURES`` numbers."""
    span = text[start:end]
    before, after = text[max(0, start - 32):start], text[end:end + 8]
    digits = [c for c in span if c in "0123456789"]
    lowered = before.lower()
    n = len(span)
    parts = _DIGITS.findall(span)
    left, right = before[-1:], after[:1]
    row = [float(kind == k) for k in range(5)]
    row += [n, len(digits), len(digits) / n, len(parts), max(map(len, parts), default=0),
            sum(span.count(c) for c in " -"), span.count("."), float(span[0] == "+"), float("(" in span),
            float("@" in span), len(set(span)) / n, sum(c in "abcdefABCDEF0123456789" for c in span) / n,
            sum(c.isupper() for c in span) / n,
            float(13 <= len(digits) <= 19 and luhn("".join(digits))),
            float(max((int(p[-6:]) for p in parts), default=0) <= 255 and max(map(len, parts), default=0) <= 3),
            float(left.isspace() or not left), float(left.isalnum()), float(left in "\"'="),
            float(right.isspace() or not right), float(right.isalnum()), float("=" in before[-4:])]
    row += [float(any(w in lowered for w in CONTEXT[kind])), float(any(w in lowered for w in CONTEXT[SECRET])),
            float(bool(KEY_FORM.fullmatch(span))), float(span.rpartition(".")[2].isalpha()),
            float(kind == PHONE and _called(before))]
    return row


@dataclass
class PiiModel:
    trees: Trees | None
    thresholds: tuple[float, ...]

    def select(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """The base spans, and the candidates above their threshold that do
        not overlap a span of their kind; better ones first."""
        base, more = find(text)
        taken = list(base)
        if more and self.trees is not None:
            scores = self.trees.predict(np.array([describe(k, text, s, e) for k, s, e in more]))
            by_kind: dict[int, list] = {}
            for kind, s, e in sorted(base):
                by_kind.setdefault(kind, []).append((s, e))
            for at in np.argsort(-scores, kind="stable").tolist():
                kind, start, end = more[at]
                if scores[at] < self.thresholds[kind]:
                    continue
                # Spans of a kind do not overlap, so their ends are in order as their starts are.
                spans = by_kind.setdefault(kind, [])
                place = bisect_left(spans, (end,))
                if place == 0 or spans[place - 1][1] <= start:
                    insort(spans, (start, end))
                    taken.append(more[at])
        order = lambda x: (x[1], x[0], x[2])
        return sorted(base, key=order), sorted(taken, key=order)


def _candidates(batches):
    """Per candidate of a text: whether the text is kept back, kind, label and
    the description."""
    for batch in batches:
        held, kinds, labels, rows = [], [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            base, more = find(text or "")
            for kind, s, e in base + more:
                held.append(key % 5 == 0)
                kinds.append(kind)
                labels.append(int(is_true(kind, text[s:e], text[max(0, s - 32):s])))
                rows.append(np.array(describe(kind, text, s, e), np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.bool_()), pa.array(kinds, pa.int32()), pa.array(labels, pa.int32()),
             pa.array(rows, pa.binary())], names=["held", "kind", "label", "row"])


def _described(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), FEATURES)


def _values(batches):
    """(feature, bits of a value, n) of rows (row, n). No value is negative, so
    their bits are in order."""
    for batch in batches:
        bits, n = _described(batch.column(0)).view(np.int32), batch.column(1).to_numpy()
        for f in range(FEATURES):
            values, at = np.unique(bits[:, f], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), f), pa.int32()), pa.array(values, pa.int32()),
                 pa.array(np.bincount(at, n, len(values)).astype(np.int64))], names=["feature", "bits", "n"])


VALUES = 200_000
STEPS = 65_536


def _edges(rows: DataFrame) -> list[np.ndarray]:
    """The edges of the bins of each feature, from all rows (row, n): exact
    quantiles. Up to ``VALUES`` distinct values come to the driver; of more,
    only the values at the ranks that the quantiles lie between."""
    counted = written(rows.select("row", "n").mapInArrow(_values, "feature int, bits int, n long")
                      .groupBy("feature", "bits").agg(F.sum("n").alias("n")), "values")
    if counted.count() > VALUES:
        return _edges_by_rank(counted)
    table = counted.toArrow()
    feature, bits, n = (table[c].to_numpy() for c in ("feature", "bits", "n"))
    order = np.argsort(bits, kind="stable")
    feature, values, n = feature[order], bits[order].astype(np.int32).view(np.float32), n[order]
    return [quantile_edges(values[feature == f], n[feature == f]) for f in range(FEATURES)]


SHIFT, STEP = 20, 6  # bits of a value that are open after the first pass, and found by each later one


def _edges_by_rank(counted: DataFrame) -> list[np.ndarray]:
    """The values (feature, bits, n) at the wanted ranks, bit by bit: a pass
    counts the values by their upper bits, from the second on only those that
    begin as a wanted one does. A pass gives the driver at most 2,048 rows a
    feature, or 64 for each value wanted."""
    total = dict(counted.groupBy("feature").agg(F.sum("n")).collect())
    wanted = {f: quantile_ranks(int(n)) for f, n in total.items()}
    # (feature, rank): the upper bits of its value, and how many values come before these
    at = {(f, int(k)): (0, 0) for f, (low, high, _) in wanted.items() for k in (*low, *high)}
    shift = 31
    while shift:
        known, shift = shift, SHIFT if shift == 31 else max(0, shift - STEP)
        begun = counted.sparkSession.createDataFrame(
            sorted({(f, head) for (f, _), (head, _) in at.items()}), "feature int, head int")
        table = (counted.withColumn("head", F.shiftright("bits", known) if known < 31 else F.lit(0))
                 .join(F.broadcast(begun), ["feature", "head"])
                 .groupBy("feature", "head", F.shiftright("bits", shift).alias("next")).agg(F.sum("n").alias("n"))
                 .toArrow().sort_by([(c, "ascending") for c in ("feature", "head", "next")]))
        parts: dict[tuple[int, int], tuple[list, list]] = {}
        for f, head, after, n in zip(*(table[c].to_pylist() for c in ("feature", "head", "next", "n"))):
            heads, counts = parts.setdefault((f, head), ([], []))
            heads.append(after)
            counts.append(n)
        ends = {k: np.cumsum(counts) for k, (_, counts) in parts.items()}
        for (f, k), (head, before) in at.items():
            place = int(np.searchsorted(ends[f, head], k - before, "right"))
            at[f, k] = parts[f, head][0][place], before + (int(ends[f, head][place - 1]) if place else 0)

    def values(f: int, ranks: np.ndarray) -> np.ndarray:
        return np.array([at[f, int(k)][0] for k in ranks], np.int32).view(np.float32).astype(np.float64)

    return [edges_between(values(f, wanted[f][0]), values(f, wanted[f][1]), wanted[f][2]) if f in wanted
            else np.empty(0) for f in range(FEATURES)]


def _binner(edges: list[np.ndarray]):
    def run(batches):
        for batch in batches:
            bins = binned(_described(batch.column(2)), edges)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([b.tobytes() for b in bins], pa.binary()),
                 batch.column(3), batch.column(4)], names=["held", "kind", "bins", "n", "hits"])

    return run


def _scorer(trees: Trees):
    def run(batches):
        for batch in batches:
            step = np.floor(Cells.of(batch).scores(trees) * STEPS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(step.astype(np.int32)), batch.column(2), batch.column(3)],
                names=["kind", "step", "n", "hits"])

    return run


def _counts() -> list:
    return [F.sum("n").alias("n"), F.sum("hits").alias("hits")]


def learn(docs: DataFrame, *, text_col: str = "text", precision: float = 0.98, least: float = 0.5,
          **options) -> PiiModel:
    """Train and calibrate on all candidates; what reaches the driver is
    bounded (see ``_edges``, ``boost_cells``, ``STEPS``)."""
    texts = bounded(docs).where(F.col(text_col).isNotNull()).select(
        F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = written(texts.mapInArrow(_candidates, "held boolean, kind int, label int, row binary")
                   .groupBy("held", "kind", "row").agg(F.count("*").alias("n"), F.sum("label").alias("hits")),
                   "candidates")

    def sides(rows):
        return {r["held"]: r for r in rows.groupBy("held").agg(*_counts()).collect()}

    parts = sides(rows)
    if not parts:
        return PiiModel(None, (2.0,) * len(KINDS))
    if len(parts) == 1:
        rows = rows.withColumn("held", F.pmod(F.xxhash64("kind", "row"), F.lit(5)) == 0)
        parts = sides(rows)

    def side(table, held):  # all rows, if they cannot be divided
        return table.where(F.col("held") == held) if held in parts else table

    edges = _edges(side(rows, False))
    cells = written(rows.select("held", "kind", "row", "n", "hits")
                    .mapInArrow(_binner(edges), "held boolean, kind int, bins binary, n long, hits long")
                    .groupBy("held", "kind", "bins").agg(*_counts()), "cells")
    most = parts.get(False) or parts[True]
    trees = boost_cells(side(cells, False), most["hits"] / most["n"], edges, **options)
    scored = (side(cells, True).select("kind", "bins", "n", "hits")
              .mapInArrow(_scorer(trees), "kind int, step int, n long, hits long")
              .groupBy("kind", "step").agg(*_counts()).toArrow())
    kind, step, n, hits = (scored[c].to_numpy() for c in ("kind", "step", "n", "hits"))
    return PiiModel(trees.on_values(edges), tuple(
        calibrated_threshold(step[kind == k] / STEPS, hits[kind == k], precision, least, n[kind == k])
        for k in range(len(KINDS))))


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the names of its
    kinds in brackets."""
    pieces, pos, at = [], 0, 0
    while at < len(spans):
        kind, start, end = spans[at]
        kinds = {kind}
        at += 1
        while at < len(spans) and spans[at][1] < end:
            kinds.add(spans[at][0])
            end = max(end, spans[at][2])
            at += 1
        pieces += [text[pos:start], "[" + "/".join(KINDS[k].upper() for k in sorted(kinds)) + "]"]
        pos = end
    return "".join(pieces) + text[pos:]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_SPANS_SQL = "array<struct<kind:string,start:int,end:int>>"


def _named(spans):
    return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]


def scan(docs: DataFrame, model: PiiModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``base_spans`` and ``spans`` (both by
    start, then kind as listed) and ``redacted_text``."""

    def run(batches):
        for batch in batches:
            base, taken, out = [], [], []
            for text in batch.column(1).to_pylist():
                fixed, spans = model.select(text or "")
                base.append(_named(fixed))
                taken.append(_named(spans))
                out.append(redacted(text, spans) if spans else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, _SPANS), pa.array(taken, _SPANS), pa.array(out, pa.string())],
                names=["doc_id", "base_spans", "spans", "redacted_text"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return bounded(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, base_spans {_SPANS_SQL}, spans {_SPANS_SQL}, redacted_text string")


def redact(docs: DataFrame, model: PiiModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the selected spans replaced in the text."""

    def run(batches):
        for batch in batches:
            texts = field_of(batch.column(0), text_col)
            out = [t and redacted(t, model.select(t)[1]) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [with_field(batch.column(0), text_col, pa.array(out, texts.type))], names=["doc"])

    rows = bounded(docs).select(packed(docs))
    return rows.mapInArrow(run, rows.schema).select("doc.*")
