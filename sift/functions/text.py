"""Text functions as Column expressions.

Everything here returns a ``Column`` built from Spark's own functions, so it
runs inside the JVM and stays in whole-stage code generation (higher-order
array functions are interpreted but still JVM-side). The one exception is the
markdown-link fixed point, whose exact semantics need a loop; a small pandas
helper handles it, and only texts that contain ``](http`` are shipped to it.

Cleaning semantics (lower-case, links, URLs, allowed characters, trailing
punctuation, pure-punctuation words, n-grams joined by ``_``) follow the
reference's comment cleaner; query tokenisation follows its search box.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import links

# --- fixed values (must equal the reference's for identical results) -------
# Punctuation kept by the comment cleaner; every other non-space character
# outside A-Z, a-z, 0-9 is deleted.
KEPT_PUNCTUATION = "!?.-,';:"
# Query tokens are split on runs of these three characters (not tab).
QUERY_SPLIT = "[ \\n\\r]+"
# Markdown link that the cleaner reduces to its label: the first "](http"
# after a "[" closes the label, and the URL runs to the first ")" with no
# space before it.
LINK_MARK = "](http"
# ---------------------------------------------------------------------------

# Python's str whitespace is Unicode-aware and also counts U+001C..U+001F;
# Java's (?U)\s is Unicode White_Space, which lacks those four.
_WS = r"\s\x1c-\x1f"
_P = r"!?.\-,';:"  # KEPT_PUNCTUATION, escaped for a character class

# URLs (``http`` up to whitespace) and characters outside letters, digits,
# whitespace and the kept punctuation are both deleted, in one pass: a URL
# never starts with a deleted character, so deleting URLs first and
# characters second gives the same text.
_RE_URL_OR_DISALLOWED = rf"(?U)http[^{_WS}]*|[^{_WS}A-Za-z0-9{_P}]"
# Word separator that also swallows a word's trailing punctuation run.
_RE_WORD_END = rf"(?U)[{_P}]*+(?:[{_WS}]+|$)"

# The wrapped function lives in ``links``, which is pickled by value.
_strip_links_batch = F.pandas_udf(links.strip_links_series, StringType())


def strip_links(text: Column) -> Column:
    """markdown links to their label, to a fixed point.

    Texts without ``](http`` cannot contain a link and never leave the JVM;
    for the rest only that text is sent to the Arrow-batched helper.
    """
    has_link = F.instr(text, LINK_MARK) > 0
    return F.coalesce(_strip_links_batch(F.when(has_link, text)), text)


def _clean_chars(text: Column) -> Column:
    """lower-case, links, bare URLs, disallowed characters."""
    t = strip_links(F.lower(text))
    return F.regexp_replace(t, _RE_URL_OR_DISALLOWED, "")


def clean_words(text: Column) -> Column:
    """The cleaned unigram array of a text.

    Splitting trailing punctuation off a word and then dropping
    pure-punctuation words is the same as cutting each word's trailing run
    of kept punctuation and dropping empty words; the split pattern does the
    cut, so the whole text is scanned twice (deletions, split).
    """
    return F.array_remove(F.split(_clean_chars(text), _RE_WORD_END), "")


def clean_text(text: Column) -> Column:
    """The parsed text. Every word is followed by its trailing run of
    kept punctuation as a word of its own, and all are joined by one space."""
    words = F.split(_clean_chars(text), rf"(?U)[{_WS}]+")

    def halves(word: Column) -> Column:
        body = F.rtrim(word, F.lit(KEPT_PUNCTUATION))
        return F.array(body, F.substr(word, F.length(body) + 1))

    return F.array_join(F.array_remove(F.flatten(F.transform(words, halves)), ""), " ")


def ngrams(words: Column, n: int) -> Column:
    """consecutive n-grams joined by ``_``; empty if too short."""
    if n == 1:
        return words
    size = F.size(words)
    grams = F.transform(
        F.sequence(F.lit(0), size - n),
        lambda i: F.concat_ws("_", *[F.get(words, i + k) for k in range(n)]),
    )
    # sequence(0, -1) counts down, so guard by size.
    return F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))


def ngram_features(words: Column) -> Column:
    """unigrams ++ bigrams ++ trigrams, duplicates kept."""
    return F.concat(words, ngrams(words, 2), ngrams(words, 3))


def with_features(df, text_col: str, words_col: str = "words",
                  features_col: str = "features"):
    """Add the cleaner's outputs: the word array and the n-gram feature array.

    Two projections, because the link helper is a pandas UDF and may not sit
    inside the n-gram lambdas."""
    return (df.withColumn(words_col, clean_words(F.col(text_col)))
            .withColumn(features_col, ngram_features(F.col(words_col))))


def explode_terms(df, array_col: Column, name: str, *keep: str):
    """One row per array element, as ``explode`` would give.

    ``explode`` makes the optimizer infer ``size(array) > 0`` and push it
    below joins and projections, where the whole cleaning expression is
    evaluated again (and, under the n-gram lambdas, once per element).
    ``explode_outer`` infers nothing; its null row for an empty array is
    dropped right after, and cleaned arrays never hold nulls."""
    return (df.select(*keep, F.explode_outer(array_col).alias(name))
            .where(F.col(name).isNotNull()))


def query_tokens(query: Column) -> Column:
    """F1, F2, P10: split on space/LF/CR, strip ASCII punctuation from both
    ends (Java's ``\\p{Punct}`` is the same 32 characters as Python's
    ``string.punctuation``), drop empty tokens."""
    parts = F.split(query, QUERY_SPLIT)
    stripped = F.transform(
        parts, lambda t: F.regexp_replace(t, "^\\p{Punct}+|\\p{Punct}+$", ""))
    return F.array_remove(stripped, "")


def is_sarcasm_or_quote(body: Column) -> Column:
    """P12 on the raw body: a quote (leading ``&gt;``) or a ``/s`` word."""
    return F.startswith(body, F.lit("&gt;")) | body.rlike("(^|\\s)/s(\\s|$)")
