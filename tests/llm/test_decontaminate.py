import random
import re

import pytest

from sift.llm.decontaminate import SuffixAutomaton, decontaminate, find_hits, merged

DOCS = "doc_id long, text string, spans string"  # spans: a clashing extra column
ITEMS = "item_id string, text string, doc_id long"


def _brute(items, doc, window):
    hit, found = set(), set()
    for item_id, it in items:
        wins = [it] if len(it) < window else [it[i:i + window] for i in range(len(it) - window + 1)]
        for w in wins:
            for i in range(len(doc) - len(w) + 1):
                if w and doc[i:i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    found.add(item_id)
    return hit, found


def test_automaton_matches_brute_force():
    rnd = random.Random(1)
    for _ in range(1500):
        window = rnd.choice([1, 3, 4])
        items = [(str(k), [rnd.choice("abcd") for _ in range(rnd.randint(1, 8))])
                 for k in range(rnd.randint(1, 5))]
        sam = SuffixAutomaton(window)
        for item_id, it in items:
            sam.add(item_id, [w.encode() for w in it])
        sam.finish()
        doc = [rnd.choice("abcde") for _ in range(rnd.randint(0, 40))]
        spans, found = sam.hits([w.encode() for w in doc])
        want = _brute(items, doc, window)
        assert {x for s, e in merged(spans) for x in range(s, e)} == want[0]
        assert {i for p in found for i in sam.items[p]} == want[1]


def _tables(spark, seed=2):
    rnd = random.Random(seed)
    vocab = ["alpha", "beta", "Gamma", "é", "x1", "delta"]
    items = [(f"i{k}", " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 14))), k) for k in range(12)]
    items += [("i3", items[3][1], 0), ("dup", items[4][1], 0), (None, items[5][1], 1), ("null", None, 2),
              ("empty", "...", 3), ("ÿ,", "only here", 4)]
    docs = []
    for k in range(40):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            parts.append(rnd.choice(items[:12])[1] if rnd.random() < 0.5 else
                         " ".join(rnd.choice(vocab + ["zeta"]) for _ in range(rnd.randint(1, 9))))
        docs.append((k, rnd.choice([", ", "\n", " - "]).join(parts), "x"))
    docs += [(50, None, "x"), (51, "", "x"), (None, docs[1][1], None), docs[1], (52, "zeta " * 50_000, "x")]
    return docs, items, spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)


@pytest.mark.parametrize("max_tokens", [2_000_000, 20])
def test_hits_match_brute_force(spark, max_tokens):
    docs, items, df, bench = _tables(spark)
    normal = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    plain = [(i, normal(t)) for i, t, _ in items]
    want = sorted((d is None, d or 0, len(normal(t)), len(h), sorted(x for x in f if x is not None))
                  for d, t, _ in docs for h, f in [_brute(plain, normal(t), 10)])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, sum(s.end - s.start for s in r["spans"]), r["items"])
                 for r in find_hits(df, bench, max_tokens=max_tokens).collect())
    assert got == want
    assert any(x[3] for x in want)


def test_spans_are_cut_and_covered_documents_go(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([("a", passage, 1)], ITEMS)
    own = " ".join(f"own{i}" for i in range(30))
    docs = [(1, f"{own}. {passage.upper()}! End {own}", "x"), (2, passage, "x"), (3, own, None), (4, None, "x"),
            (5, "", "x")]
    out = {r.doc_id: r for r in decontaminate(spark.createDataFrame(docs, DOCS), bench).collect()}
    assert sorted(out) == [1, 3, 4, 5]
    assert out[1].text == f"{own}.! End {own}" or out[1].text == f"{own}. ! End {own}"
    assert out[3].text == own and out[1].spans == "x"


def test_empty_tables(spark):
    _, _, df, bench = _tables(spark)
    assert find_hits(df.limit(0), bench).collect() == []
    assert all(not r["spans"] for r in find_hits(df, bench.limit(0)).collect())
    assert decontaminate(df, bench.limit(0)).count() == df.count()
