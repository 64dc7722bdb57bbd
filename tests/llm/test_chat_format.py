import random

from pyspark.sql import functions as F

from sift.llm.chat_format import Template, format_conversations, loss_text, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, rows string"  # rows: a clashing extra column


def _read(spark, rows):
    done = format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4))
    return {r.conv_id: r for r in done.select(
        "*", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")).collect()}


def test_round_trip_of_hostile_texts(spark):
    rnd = random.Random(1)
    bits = [*Template().control, "\\", "\\e", "\\b", "<", "|im_end|>", "\n", "é", "[", "/INST]", "<<", " a "]
    rows = []
    for conv in range(150):
        for turn in range(rnd.randint(1, 6)):
            text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))
            role = rnd.choice(["user", "assistant", "system", "to\nol", "</s>", "<|im_sep|>x\\e"])
            rows.append((conv, turn, role, text, "x"))
    got = _read(spark, rows)
    for conv in range(150):
        mine = sorted((t, r, x) for c, t, r, x, _ in rows if c == conv)
        assert [(t.role, t.text) for t in got[conv].turns] == [(r, x) for _, r, x in mine]
        assert got[conv].loss == "".join(x for _, r, x in mine if r == "assistant")
        assert got[conv].formatted == "".join(s.text for s in got[conv].segments)


def test_machine(spark):
    orders = {1: "sua", 2: "ua", 3: "uau", 4: "au", 5: "uu", 6: "us", 7: "s", 8: "x"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    got = _read(spark, [(c, k, names[r], "t", None) for c, o in orders.items() for k, r in enumerate(o)])
    assert {c: (r.valid, r.bad_turn) for c, r in got.items()} == {
        1: (True, None), 2: (True, None), 3: (True, None), 4: (False, 0), 5: (False, 1), 6: (False, 1),
        7: (False, None), 8: (False, 0)}


def test_nulls_ties_and_long_texts(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, None, "t", "x"), (1, 1, None, "t", "x"), (1, None, "system", "s", "x"),
            (None, 0, "user", "x" * 300_000, None)]
    got = _read(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [("system", "s"), ("user", ""), ("", "t"), ("", "t")]
    assert len(got[None].turns[0].text) == 300_000
    assert got[1].loss == ""


def test_empty_table(spark):
    assert format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
