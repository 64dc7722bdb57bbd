import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sift.llm import prefix_trie as trie
from tests.llm.brute import words

SCHEMA = "conv_id long, turn long, role string, text string, depth string, p1 string"  # clashing extra columns
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def _conversations(rows):
    """conv_id: turns (role, text) in order."""
    out = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            out[conv_id].append((turn is not None, turn or 0, _digest(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in out.items()}


def _rebuilt(conversations):
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = conversations.get(c - c % 20, [])[:h] + own[h:]
    return out


def _plain(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        own = (len(members[node]) - 1) * len(words(node[-1][1])) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
    out = []
    for node, ids in members.items():
        ends = sorted(c for c in ids if len(conversations[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def _rows(seed, convs=120):
    rnd = random.Random(seed)
    turns = [(rnd.choice(["user", "assistant", "system", None]), rnd.choice(["a b", "c", "", None, "d e f", "g\th"]))
             for _ in range(7)]
    rows = []
    for c in rnd.sample(range(300), convs):
        for t in range(rnd.randint(1, 6)):
            rows.append((c, t, *(("user", "hot turn") if t == 0 and rnd.random() < 0.5 else rnd.choice(turns)), "x", "y"))
    rows += [(20, None, "user", "null first", None, "x"), (20, 1, "user", "tie", "x", None), (None, 1, "user", "x", "", "")]
    rows += [r for r in rows if r[0] == rows[0][0]]  # repeated rows
    return rows


def _got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("seed,hot,shard", [(1, 1000, 50_000), (2, 20, 30), (3, 1, 1)])
def test_matches_brute_force(spark, seed, hot, shard):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    shared, conversations = trie.with_shared_heads(trie.positions(df))
    got = _got(trie.nodes(shared, conversations, hot_turns=hot, shard_turns=shard))
    assert got == _plain(_rebuilt(_conversations(rows)))


def test_conversations_as_they_are(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 2)  # prefixes over several blocks
    monkeypatch.setattr(trie, "PACK", 3)
    rows = _rows(4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert _got(trie.prefix_trie(df, hot_turns=50)) == _plain(_conversations(rows))


def test_many_copies_and_long_conversations(spark):
    long = [(0, t, "user", f"turn {t % 7}", "", "") for t in range(5000)]
    rows = long + [(1, t, "user", text, "", "") for (_, t, _, text, _, _) in long[:4990]]
    rows += [(c, t, "user", "copy", "", "") for c in range(2, 400) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = _got(trie.prefix_trie(df))
    assert len(got) == 5003 and got[0][3:7] == (400, 2, 2, sum(2 for t in range(4990)) + 397 * 2)
    ends = hashlib.sha256(",".join(map(str, range(2, 400))).encode()).hexdigest()
    assert [r for r in got if r[:2] == (2, 2)] == [(2, 2, 2, 398, 0, 1, 397, ends)]


def test_turnless_conversations_and_empty_tables(spark):
    rows = [(8, 0, "user", "own", "", "")]  # h of 8 is 3: nothing is left, and there is no conversation 0
    assert zlib.crc32(b"8") % 4 == 3
    df = spark.createDataFrame(rows, SCHEMA)
    got = _got(trie.nodes(*trie.with_shared_heads(trie.positions(df))))
    assert got == [(8, 0, None, 1, 0, 1, 0, hashlib.sha256(b"8").hexdigest())]
    assert _got(trie.nodes(*trie.with_shared_heads(trie.positions(df.limit(0))))) == []


def test_double_array_holds_exactly_its_sequences():
    rnd = random.Random(3)
    sequences = [np.array([rnd.randrange(30) for _ in range(rnd.randint(0, 6))], np.int64) for _ in range(300)]
    array = trie.DoubleArray(sequences)
    prefixes = {tuple(s[:k].tolist()) for s in sequences for k in range(len(s) + 1)}
    assert array.states == len(prefixes) and (array.check >= 0).sum() == len(prefixes)

    def walk(ids):
        state = np.zeros(1, np.int64)
        for t in ids:
            state = array.step(state, np.array([t]))
            if state[0] < 0:
                return False
        return True

    assert all(map(walk, prefixes))
    for _ in range(2000):
        ids = tuple(rnd.randrange(32) for _ in range(rnd.randint(1, 4)))
        assert walk(ids) == (ids in prefixes)
