from collections import Counter

import pytest

from sift.llm.quality_rules import clean_lines
from tests.llm.brute import words

SCHEMA = "doc_id long, text string, kept string"  # kept: a clashing extra column


def _counts(text):
    w = words(text)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(wins)
    covered = {p for i, x in enumerate(wins) if c[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(x) for x in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_counts_and_verdicts(spark):
    prose = " ".join(" ".join(f"Word{i}x{j}" for j in range(10)) + "." for i in range(6))
    texts = [None, "", " \n\t ", "one", "a b c a b c", prose, prose + "\n" + prose, "é\x1fà b\x0bc\n\nb",
             prose + "\nHome | About | News | Contact\nAll rights reserved.",
             "\n".join(f"w{i} | x{i} | y{i} | z{i} | q{i}" for i in range(30)),
             " ".join(f"word{i}" for i in range(400)), prose.replace(" ", "&&& ") + "&&&"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(5, prose, "x"), (None, prose, None)]
    got = clean_lines(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert len(got) == len(rows)
    for (doc_id, text, _), r in zip(rows, got):
        assert r.doc_id == doc_id
        n, chars, symbols, dup, rep = _counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (r.base_failed and r.kept)
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].kept and by_id[None].kept and by_id[8].kept
    assert by_id[5].cleaned_text == prose
    assert by_id[8].cleaned_text == prose and by_id[8].n_lines_failed == 2
    assert not by_id[9].kept and not by_id[10].kept and not by_id[11].kept


@pytest.mark.parametrize("text,words_in", [("x " * 200_000, 200_000), ("x" * 300_000, 1)])
def test_very_long_texts(spark, text, words_in):
    r = clean_lines(spark.createDataFrame([(1, text, "")], SCHEMA)).first()
    assert r.n_words == words_in and not r.kept


def test_empty_table(spark):
    assert clean_lines(spark.createDataFrame([], SCHEMA)).collect() == []
