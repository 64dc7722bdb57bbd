"""Cleaning, n-grams and query tokens against hand-derived fixtures and texts
generated together with their answers."""

import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sift.functions import text as T


def _words(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", T.clean_words(F.col("t")).alias("w")).orderBy("i").collect()
    return [list(r["w"]) for r in rows]


# Hand-derived expectations (FIXTURES.md, "Inline rows: cleaning").
CLEANING = [
    ("Hello, world!", ["hello", "world"]),
    ("see [my site](http://a.b/c) now", ["see", "my", "site", "now"]),
    ("[[a](http://x)](http://y)", ["a"]),
    ("[a] [b](http://x)", ["a", "b"]),
    ("[a](http://x y) [b](http://z)", ["a", "y", "b"]),
    ("... what?! he'd todo-list 'tis --foo", ["what", "he'd", "todo-list", "'tis", "--foo"]),
    ("a b c\u001cd", ["a", "b", "c", "d"]),
    ("café it’s", ["caf", "its"]),
    ("", []),
    ("!!!", []),
    ("/s &gt; quoted", ["s", "gt", "quoted"]),
]


def test_cleaning_fixtures(spark):
    got = _words(spark, [t for t, _ in CLEANING])
    for (text, want), have in zip(CLEANING, got):
        assert have == want, text


def test_ngrams(spark):
    df = spark.createDataFrame([("a b c",), ("one",), ("",)], "t string")
    out = T.with_features(df, "t").select("features").collect()
    assert list(out[0][0]) == ["a", "b", "c", "a_b", "b_c", "a_b_c"]
    assert list(out[1][0]) == ["one"]
    assert list(out[2][0]) == []


def test_sarcasm_quote_filter(spark):
    df = spark.createDataFrame([("&gt; quote",), ("sure /s",), ("a/s b",), ("fine",)], "b string")
    kept = [r[0] for r in df.where(~T.is_sarcasm_or_quote(F.col("b"))).collect()]
    assert kept == ["a/s b", "fine"]


# --- texts built from pieces whose cleaned words are known beforehand --------

_KEEP = set(string.ascii_letters + string.digits + T.KEPT_PUNCTUATION)


def _words_of(piece):
    """Cleaned words of a piece without links or addresses: per character."""
    kept = "".join(c if c.isspace() else c if c in _KEEP else "" for c in piece.lower())
    bare = [w.rstrip(T.KEPT_PUNCTUATION) for w in kept.split()]
    return [w for w in bare if w]


_PLAIN = st.text(alphabet=st.sampled_from(list("ab xyZ0.!?-,';:/&\n\t \u001c\u001féh")), max_size=12)
_LABEL = st.text(alphabet=st.sampled_from(list("ab Z0.,é")), max_size=6)
_ADDRESS = st.sampled_from(["http://q", "https://e.f/g?h=1", "http", "http://x.y/(z"])
# (text, words): plain text; a link, nested up to three deep; an address.
_PIECES = st.one_of(
    _PLAIN.map(lambda t: (t, _words_of(t))),
    st.tuples(_LABEL, st.integers(1, 3)).map(lambda x: (
        "[" * x[1] + x[0] + "](http://u)" * x[1], _words_of(x[0]))),
    _ADDRESS.map(lambda a: (a, [])))


@settings(max_examples=60, deadline=None)
@given(st.lists(_PIECES, max_size=8))
def test_cleaning_matches_the_pieces(spark, pieces):
    text = " ".join(t for t, _ in pieces)
    assert _words(spark, [text])[0] == [w for _, words in pieces for w in words]


def test_clean_text_splits_trailing_punctuation(spark):
    cases = {"Hello, world!!  ok": "hello , world !! ok", "... a-b? 'c'": "... a-b ? 'c '", "": "", " \n": "",
             "x.,;": "x .,;", "a\tb\u001cc.": "a b c .", "don't #stop": "don't stop"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r[0]: r[1] for r in df.select("t", T.clean_text(F.col("t"))).collect()}
    assert got == cases


def test_whitespace_classes_agree_with_python(spark):
    # Every BMP code point: Spark's split must treat exactly Python's
    # whitespace characters as separators.
    chars = [chr(c) for c in range(0x10000) if not (0xD800 <= c <= 0xDFFF)]
    text = "".join("a" + c for c in chars)
    assert _words(spark, [text])[0] == _words_of(text)


def test_strip_links_exact_deep_nesting(spark):
    deep = "[" * 6 + "x" + "".join(f"](http://{i})" for i in range(6))
    df = spark.createDataFrame([(deep,), ("no link [here]",)], "t string")
    out = [r[0] for r in df.select(T.strip_links(F.col("t"))).collect()]
    assert out == ["x", "no link [here]"]


@pytest.mark.parametrize("query,want", [
    ("?? !!", []),
    ("love love", ["love", "love"]),
    ("don't", ["don't"]),
    # Tabs do not split query tokens; punctuation goes from both ends only.
    ("  (hello),\tworld\n\r'x'", ["hello),\tworld", "x"]),
])
def test_query_tokens(spark, query, want):
    df = spark.createDataFrame([(query,)], "q string")
    assert list(df.select(T.query_tokens(F.col("q"))).first()[0]) == want
