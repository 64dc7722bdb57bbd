"""Line-first quality rules: judge every line, drop the lines that fail, then
reject documents that lost too much of their text.

Line rules (a line without a word is layout and is never judged):

* punctuation: the line has at least ``min_line_words`` words, does not end in
  closing punctuation (quotes and brackets after it are allowed) and has no
  sentence end per ``max_sentence_words`` words either, so prose that breaks
  off in its last sentence passes;
* navigation: at least ``min_separators`` words are menu separators;
* boilerplate: the line holds a phrase of ``BOILERPLATE``, or at least
  ``max_symbol_share`` of its characters are of ``SYMBOLS``.

Document rules: fewer than ``min_words`` words, or more than
``max_repeat_share`` of the words in three-word windows found twice, reject at
once; otherwise the document goes if the failed lines hold more than
``max_lost_share`` of its words.

Defined results: null and empty texts have no words and are rejected; repeated
rows and ids are judged row by row; a null id stays null; other columns of the
input are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded

# Fixed values.
SYMBOLS = "#*$%&|<>"
CLOSING = ".!?:;…。！？"
AFTER_CLOSING = "\"'”’»)]*_"
SEPARATORS = tuple(s.encode() for s in ("|", "»", "›", "•", "·", "/", ">"))
BOILERPLATE = (
    "all rights reserved", "cookie policy", "enable javascript", "javascript is disabled",
    "lorem ipsum", "privacy policy", "terms of use", "terms of service", "sign up for our newsletter",
    "click here to", "skip to content", "share on facebook",
)
BLANK = " \t\n\x0b\x0c\r"

_SENTENCE_END = re.compile("[.!?…。！？][ \t\x0b\x0c\r]")

SCHEMA = ("doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, n_lines_failed long, n_words_lost long, "
          "kept boolean, cleaned_text string")


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line and document rules."""

    min_line_words: int = 3
    max_sentence_words: int = 60
    min_separators: int = 3
    max_symbol_share: float = 0.2
    min_words: int = 50
    max_repeat_share: float = 0.5
    max_lost_share: float = 0.5

    def line_fails(self, line: str, words: list[bytes]) -> bool:
        ends = line.rstrip(BLANK).rstrip(AFTER_CLOSING)
        if (len(words) >= self.min_line_words and not ends.endswith(tuple(CLOSING))
                and len(_SENTENCE_END.findall(line)) * self.max_sentence_words < len(words)):
            return True
        if sum(map(words.count, SEPARATORS)) >= self.min_separators:
            return True
        if sum(map(line.count, SYMBOLS)) >= self.max_symbol_share * len(line):
            return True
        lowered = line.lower()
        return any(phrase in lowered for phrase in BOILERPLATE)


def repeated_window_words(words: list[bytes]) -> int:
    """Words in three-word windows that the text has twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0  # end: first word after the last covered one
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def judge(text: str | None, rules: LineRules) -> tuple:
    """The columns of ``SCHEMA`` after the id, for one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, BLANK))
    n_symbols = sum(map(text.count, SYMBOLS))
    n_repeat = repeated_window_words(words)
    base_failed = n_words < rules.min_words or n_repeat > rules.max_repeat_share * n_words
    seen, n_dup, kept_lines, failed, lost = set(), 0, [], 0, 0
    for line in text.split("\n"):
        line_words = line.encode("utf-8", "surrogatepass").split()
        if line_words:
            n_dup += line in seen
            seen.add(line)
            if rules.line_fails(line, line_words):
                failed += 1
                lost += len(line_words)
                continue
        kept_lines.append(line)
    kept = not base_failed and lost <= rules.max_lost_share * n_words
    return (n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, failed, lost, kept,
            "\n".join(kept_lines))


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), *, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the counts, the verdict and the text
    without the failed lines. A map over the scan: nothing is shuffled."""

    def run(batches):
        for batch in batches:
            judged = [judge(t, rules) for t in batch.column(1).to_pylist()]
            columns = list(zip(*judged)) or [()] * (len(out) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, f.type) for c, f in zip(columns, out[1:])],
                names=[f.name for f in out])

    id_type = docs.schema[id_col].dataType.simpleString()
    long, flag = pa.int64(), pa.bool_()
    types = [None, long, long, long, long, long, flag, long, long, flag, pa.string()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    out = [pa.field(n, t or pa.null()) for n, t in zip(names, types)]
    return (bounded(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, SCHEMA.format(id=id_type)))
