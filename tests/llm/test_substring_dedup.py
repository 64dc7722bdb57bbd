import random

import numpy as np
import pytest

from sift.llm import shingles
from sift.llm.substring_dedup import _distinct, _later, dedup_substrings
from tests.llm.brute import substring_dedup

SCHEMA = "doc_id long, text string, n_words string"  # n_words: a clashing extra column


def _rows(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "\x1fx", "a b"]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randint(5, 40))] for _ in range(6)]
    rows = []
    for k in range(60):
        text = []
        for _ in range(rnd.randint(0, 5)):
            text += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocab) for _ in range(rnd.randint(1, 30))]
        rows.append((rnd.randint(0, 50), rnd.choice([" ", "\n", "\t "]).join(text), "x"))
    rows += rows[:5] + [(7, None, "x"), (8, "", "x"), (None, rows[3][1], "x"), (99, rows[3][1], None)]
    rows.append((100, " ".join(passages[0] * 30), "x"))  # repeats within one text
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 1000), (2, 3), (3, 1)])
def test_matches_brute_force(spark, seed, hot):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in dedup_substrings(df, window=10, hot_texts=hot).collect()]
    want = substring_dedup([r[:2] for r in rows], 10)
    order = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert any(r[2] for r in got)


def test_full_table_lets_more_through_with_the_same_result(spark):
    rows = _rows(4)
    df = spark.createDataFrame(rows, SCHEMA)
    a = dedup_substrings(df, window=10).collect()
    b = dedup_substrings(df, window=10, max_cells=1 << 15).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


@pytest.mark.parametrize("hot", [2, 1000])
def test_a_passage_repeated_ten_thousand_times_is_one_row_per_text(spark, hot):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, passage, "x"), (2, " ".join([passage] * 10_000), "x"), (3, " ".join(["one"] * 120_000), "x"),
            (4, "one " * 30 + "end", "x"), (5, f"before {passage} after", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in dedup_substrings(df, window=10, hot_texts=hot).collect()}
    # Of document 2, windows inside one copy of the passage repeat document 1;
    # they cover every word. Those across copies are in no other text.
    assert got == {1: (12, 0), 2: (120_000, 120_000), 3: (120_000, 0), 4: (31, 30), 5: (14, 12)}


def test_repeated_windows_of_a_text_leave_a_task_once():
    one, two = np.array([5, 5, 7, 5, 5], np.uint64), np.array([1, 1, 1, 2, 1], np.uint64)
    order, heads = _distinct(one, two, np.array([0, 0, 0, 0, 1]))
    assert order[heads].tolist() == [0, 3, 2, 4]
    later = _later(np.array([10, 11, 12, 13, 0])[order], heads)
    assert [np.frombuffer(x, np.int32).tolist() if x else None for x in later] == [[11], None, None, None]


def test_empty_table(spark):
    assert dedup_substrings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_words_hashed_without_objects(monkeypatch):
    monkeypatch.setattr(shingles, "_SLICE", 50)  # texts are cut into several slices
    rnd = random.Random(4)
    vocab = [b"ab", b"ba", b"a", b"\x1f", b"\xc2\x85x", "é".encode(), b"z" * 200, b"z" * 199 + b"y", b"z" * 199]
    texts = [rnd.choice([b" ", b"\t\n"]).join(rnd.choices(vocab, k=rnd.randint(0, 40))) for _ in range(50)]
    texts += [None, b"", b" \x0b\x0c\r ", b" a ab\n"]
    of_word, texts_seen = {}, 0
    for first, counts, hashes in shingles.hashed_runs(texts, 300):
        assert first == texts_seen
        texts_seen += len(counts)
        ends = np.cumsum(counts)
        for k, (end, n) in enumerate(zip(ends, counts)):
            words = shingles.words_of(texts[first + k])
            assert len(words) == n
            for word, h in zip(words, hashes[end - n:end].tolist()):
                assert of_word.setdefault(word, h) == h
    assert texts_seen == len(texts) and len(set(of_word.values())) == len(of_word) == len(vocab)
