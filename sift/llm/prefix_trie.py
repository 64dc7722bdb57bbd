"""Prefix tries of conversations, as sharded double arrays.

A node is a distinct sequence of the first turns (role, text) of a
conversation; its members are the conversations that start with it. A turn is
known by a digest, a prefix by the exclusive or of two 64-bit hashes of
(digest, place) of its turns, so prefixes are hashed by running aggregates, in
blocks of ``BLOCK`` turns: no conversation is collected as a whole.

Equal conversations are one sequence with a count, so copies never meet in one
task. A prefix is shared if the distinct sequences below it have more than
``hot_turns`` turns; every other node lies below one prefix that is the first
on its path not shared (a shard root). All turns below a shard root go to one
task, which packs runs of about ``shard_turns`` turns into one double array:
turns get dense ids, and the child of state s by the turn with id t is the
state BASE[s] + t, valid if CHECK of it is s. The array is traversed level by
level to count members and words, and back to sum them over subtrees.

Shared prefixes are merged over all shards by grouped sums, which Spark
combines per task. For sums over subtrees, every shared node and shard root is
counted once, by the smallest sequence through it: what a sequence owns is
summed from its end upwards, and the sums of all sequences through a node are
added.

The ids of the conversations that end at a node are packed to strings of at
most ``PACK`` ids in sorted ranges and then hashed in order, so a large group
passes through one task as a stream only.

Defined results: null roles and texts are empty; rows with a null conversation
id are left out; turns come by turn number, null first, equal numbers by the
digest of role and text (so repeated rows are turns that follow each other);
other columns are not read; conversations without turns are members of the
root. An empty table has no node. Words are runs of characters other than
ASCII whitespace, in whole texts of any length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sift.llm.batches import bounded
from sift.llm.components import written
from sift.operators.ranking import rank_within

BLOCK = 4096
PACK = 8192


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def positions(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """Per turn: ``conv_id``, ``place`` (from 0), ``digest`` of role and text,
    and ``words`` of the text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        _words(text).alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    ranked = rank_within(rows.withColumn("row", F.monotonically_increasing_id()), "conv_id",
                         [*order, F.col("row")], rank_col="place")
    return ranked.select("conv_id", (F.col("place") - 1).alias("place"), "digest", "words")


def _hashes(digest: str, depth: str) -> list[Column]:
    return [F.xxhash64(digest, depth), F.xxhash64(F.lit("second"), digest, depth)]


def _prefixes(rows: DataFrame) -> DataFrame:
    """``p1``, ``p2`` of every row (conv_id, depth, digest, words)."""
    h1, h2 = _hashes("digest", "depth")
    rows = rows.withColumn("block", F.expr(f"(depth - 1) div {BLOCK}")).withColumn("h1", h1).withColumn("h2", h2)
    run = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = written(rows.select("conv_id", "depth", "digest", "words", "block", "h1", "h2",
                                 F.bit_xor("h1").over(run).alias("p1"), F.bit_xor("h2").over(run).alias("p2")),
                     "prefixes")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = inside.where("block > 0")
    blocks = (inside.join(later.select("conv_id").distinct(), "conv_id", "left_semi")
              .groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2")))
    before = blocks.select("conv_id", "block", F.bit_xor("b1").over(earlier).alias("b1"),
                           F.bit_xor("b2").over(earlier).alias("b2"))
    columns = ["conv_id", "depth", "digest", "words"]
    first = inside.where("block = 0").select(*columns, "p1", "p2")
    rest = later.join(before, ["conv_id", "block"]).select(
        *columns, *[F.col(f"p{k}").bitwiseXOR(F.col(f"b{k}")).alias(f"p{k}") for k in (1, 2)])
    return first.unionByName(rest)


class DoubleArray:
    """A trie over sequences of dense ids: the child of state s by id t is
    ``base[s] + t`` if ``check`` of it is s. State 0 is the top."""

    def __init__(self, sequences: list[np.ndarray]):
        order = sorted(range(len(sequences)), key=lambda k: sequences[k].tolist())
        size = sum(map(len, sequences)) + 1
        ids = max((int(s.max()) + 1 for s in sequences if len(s)), default=1)
        self.base = np.zeros(size + ids, np.int64)
        self.check = np.full(size + ids, -1, np.int64)
        self.check[0] = 0
        self._free, self.states = 1, 1
        waiting = [(0, 0, order)]
        while waiting:
            state, depth, members = waiting.pop()
            children: dict[int, list[int]] = {}
            for k in members:
                if len(sequences[k]) > depth:
                    children.setdefault(int(sequences[k][depth]), []).append(k)
            if children:
                base = self._place(state, sorted(children))
                waiting += [(base + t, depth + 1, below) for t, below in children.items()]
        used = np.flatnonzero(self.check >= 0)[-1] + 1
        self.base, self.check = self.base[:used], self.check[:used]

    def _place(self, state: int, ids: list[int]) -> int:
        """The first base at which all children fall on free states."""
        ids_at, slot = np.array(ids), self._free
        while True:
            while slot < len(self.check) and self.check[slot] >= 0:
                slot += 1
            base = slot - ids[0]
            if base + ids[-1] >= len(self.check):
                more = base + ids[-1] + len(self.check)
                self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
                self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            if len(ids) == 1 or (self.check[base + ids_at] < 0).all():
                break
            slot += 1
        self.base[state], self.check[base + ids_at] = base, state
        self.states += len(ids)
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        return base

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The children of the states by the ids; -1 where there is none."""
        to = self.base[states] + ids
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


_LIGHT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, end_id long, q1 long, q2 long")


def _traverse(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Nodes of a run of rows (r1, r2, seq, depth, ...), sorted so."""
    seq, depth, n = rows["seq"], rows["depth"], rows["n"]
    new = np.ones(len(seq), bool)
    new[1:] = (seq[1:] != seq[:-1]) | (rows["r1"][1:] != rows["r1"][:-1]) | (rows["r2"][1:] != rows["r2"][:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(seq)))
    roots: dict[tuple, int] = {}
    for r in zip(rows["r1"][starts].tolist(), rows["r2"][starts].tolist()):
        roots.setdefault(r, len(roots))
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(k, len(roots) + len(ids)) for k in rows["digest"]], np.int64)
    codes[starts] = [roots[r] for r in zip(rows["r1"][starts].tolist(), rows["r2"][starts].tolist())]
    trie = DoubleArray([codes[a:a + k] for a, k in zip(starts, lengths)])

    size = len(trie.check)
    n_convs, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    end, level_of, words = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    first, levels = np.zeros(size, np.int64), []
    state, alive = np.zeros(len(starts), np.int64), np.arange(len(starts))
    step = 0
    while len(alive):
        at = starts[alive] + step
        state[alive] = trie.step(state[alive], codes[at])
        here = state[alive]
        np.add.at(n_convs, here, n[at])
        np.minimum.at(conv, here, seq[at])
        level_of[here], words[here], first[here] = depth[at], rows["words"][at], at
        levels.append(np.unique(here))
        done = lengths[alive] == step + 1
        end[here[done]] = alive[done]
        alive, step = alive[~done], step + 1
    children, leaves = np.zeros(size, np.int64), np.zeros(size, np.int64)
    saved = (n_convs - 1) * words
    for level in reversed(levels):
        parent = trie.check[level]
        leaves[level] += children[level] == 0
        np.add.at(children, parent, 1)
        np.add.at(leaves, parent, leaves[level])
        np.add.at(saved, parent, saved[level])
    nodes = np.concatenate(levels)
    top = trie.check[nodes] == 0
    at, ended = first[nodes], end[nodes]
    ends = pa.array(seq[starts[np.maximum(ended, 0)]], mask=ended < 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(conv[nodes]), pa.array(level_of[nodes]), pa.array(conv[trie.check[nodes]], mask=top),
         pa.array(n_convs[nodes]), pa.array(children[nodes]), pa.array(leaves[nodes]), pa.array(saved[nodes]), ends,
         pa.array(rows["q1"][at], mask=~top), pa.array(rows["q2"][at], mask=~top)],
        names=[c.split()[0] for c in _LIGHT.split(", ")])


def _shard_nodes(shard_turns: int):
    """Nodes of a task's shard roots, whose rows follow each other, in runs."""
    numbers = ["r1", "r2", "seq", "depth", "words", "n", "q1", "q2"]

    def run(batches):
        held, count, last = [], 0, None

        def taken():
            out = {c: np.concatenate([h[c] for h in held]) for c in numbers}
            out["digest"] = [k for h in held for k in h["digest"]]
            return out

        for batch in batches:
            part = {c: batch.column(c).to_numpy() for c in numbers}
            part["digest"] = batch.column("digest").to_pylist()
            if count >= shard_turns and len(part["r1"]):
                other = (part["r1"] != last[0]) | (part["r2"] != last[1])
                if other.any():
                    cut = int(other.argmax())
                    held.append({c: v[:cut] for c, v in part.items()})
                    yield _traverse(taken())
                    held, count, part = [], 0, {c: v[cut:] for c, v in part.items()}
            if len(part["r1"]):
                held.append(part)
                count += len(part["r1"])
                last = part["r1"][-1], part["r2"][-1]
        if held:
            yield _traverse(taken())

    return run


def _packed_ids(batches):
    """Ids of one end that follow each other, comma-joined, at most ``PACK``."""
    now, ids = None, []

    def batch(rows):
        seqs, firsts, texts = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(seqs, pa.int64()), pa.array(firsts, pa.int64()),
                                           pa.array(texts, pa.string())], names=["seq", "first", "ids"])

    for part in batches:
        out = []
        for seq, conv in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if ids and (seq != now or len(ids) >= PACK):
                out.append((now, ids[0], ",".join(map(str, ids))))
                ids = []
            now = seq
            ids.append(conv)
        yield batch(out)
    yield batch([(now, ids[0], ",".join(map(str, ids)))] if ids else [])


def _digests(batches):
    """SHA-256 of the packed ids of each end, which follow each other."""
    now, state, out = None, None, []

    def batch(rows):
        seqs, digests = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(seqs, pa.int64()), pa.array(digests, pa.string())],
                                          names=["end_id", "ends_sha256"])

    for part in batches:
        for seq, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if state is None or seq != now:
                if state is not None:
                    out.append((now, state.hexdigest()))
                now, state = seq, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield batch(out)
        out = []
    yield batch([(now, state.hexdigest())] if state is not None else [])


def _end_digests(members: DataFrame) -> DataFrame:
    """(end_id, ends_sha256) from (seq, conv_id)."""
    packed = (members.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
              .mapInArrow(_packed_ids, "seq long, first long, ids string"))
    return (packed.repartition("seq").sortWithinPartitions("seq", "first").select("seq", "ids")
            .mapInArrow(_digests, "end_id long, ends_sha256 string"))


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def nodes(rows: DataFrame, conversations: DataFrame, *, hot_turns: int = 256,
          shard_turns: int = 50_000) -> DataFrame:
    """The nodes of the trie of ``rows`` (conv_id, depth from 1 without gaps,
    digest, words) of the ``conversations`` (conv_id, each once)."""
    rows = written(_prefixes(bounded(rows)), "turns")
    length = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "p1", "p2")).alias("end"))
    zero = F.lit(0).cast("long")
    ends = conversations.select("conv_id").join(length, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"end.{c}", zero).alias(to)
                     for c, to in (("depth", "length"), ("p1", "e1"), ("p2", "e2"))])
    ends = written(ends, "ends")
    key = ["length", "e1", "e2"]
    sequences = written(ends.groupBy(*key).agg(F.min("conv_id").alias("seq"), F.count("*").alias("n")), "sequences")

    q1, q2 = (F.col(p).bitwiseXOR(h) for p, h in zip(("p1", "p2"), _hashes("digest", "depth")))
    distinct = rows.withColumnRenamed("conv_id", "seq").join(
        sequences.select("seq", "n", "length"), "seq").withColumn("q1", q1).withColumn("q2", q2)
    distinct = written(distinct, "distinct")
    shared = (distinct.groupBy("depth", "p1", "p2").agg(F.sum("length").alias("weight"))
              .where(F.col("weight") > hot_turns).select("depth", "p1", "p2"))
    cuts = (distinct.select("seq", "depth", "p1", "p2").join(shared, ["depth", "p1", "p2"])
            .groupBy("seq").agg((F.max("depth") + 1).alias("cut")))
    placed = written(distinct.join(cuts, "seq", "left").withColumn("cut", F.coalesce("cut", F.lit(1).cast("long"))),
                     "placed")

    roots = placed.where("depth = cut").select("seq", F.col("p1").alias("r1"), F.col("p2").alias("r2"),
                                               F.col("q1").alias("o1"), F.col("q2").alias("o2"))
    below = placed.where("depth >= cut").join(roots, "seq").select(
        "r1", "r2", "seq", "depth", "digest", "words", "n", F.col("o1").alias("q1"), F.col("o2").alias("q2"))
    light = written(below.repartition("r1", "r2").sortWithinPartitions("r1", "r2", "seq", "depth")
                    .mapInArrow(_shard_nodes(shard_turns), _LIGHT), "shards")

    tops = sequences.select("seq", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("words"), "n",
                            "length", F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"))
    upper = placed.where("depth < cut").select(*tops.columns).unionByName(tops)
    merged = written(upper.groupBy("depth", "p1", "p2").agg(
        F.min("seq").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("words").alias("words"),
        F.max("q1").alias("q1"), F.max("q2").alias("q2"),
        F.min(F.when(F.col("length") == F.col("depth"), F.col("seq"))).alias("end_id")), "shared")
    shard_roots = light.where("q1 is not null")
    born = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = (merged.where("depth > 0").select(*born).unionByName(shard_roots.select(*born))
                .groupBy("depth", "p1", "p2").agg(F.count("*").alias("n_children")))
    counted = written(merged.join(children, ["depth", "p1", "p2"], "left")
                      .withColumn("n_children", F.coalesce("n_children", zero)), "counted")

    # What each sequence owns, summed from its end upwards, then over the sequences through a node.
    own = counted.select(F.col("conv_id").alias("seq"), "depth",
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                         (F.col("n_children") == 0).cast("long").alias("leaves"))
    tail = shard_roots.select(F.col("conv_id").alias("seq"), "depth", F.lit(None).cast("long").alias("p1"),
                              F.lit(None).cast("long").alias("p2"), F.col("saved_tokens").alias("saved"),
                              F.col("n_leaves").alias("leaves"))
    path = upper.select("seq", "depth", "p1", "p2").join(own, ["seq", "depth"], "left").unionByName(tail)
    upwards = Window.partitionBy("seq").orderBy(F.desc("depth")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    sums = (path.select("depth", "p1", "p2", F.sum("saved").over(upwards).alias("saved"),
                        F.sum("leaves").over(upwards).alias("leaves"))
            .where("p1 is not null").groupBy("depth", "p1", "p2")
            .agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")))
    parents = counted.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                             F.col("conv_id").alias("parent_conv_id"))
    above = counted.join(sums, ["depth", "p1", "p2"]).join(parents, ["depth", "q1", "q2"], "left")
    tops_of_shards = shard_roots.drop("parent_conv_id").join(parents, ["depth", "q1", "q2"], "left")
    every = (light.where("q1 is null").select(*_NODE, "end_id")
             .unionByName(tops_of_shards.select(*_NODE, "end_id"))
             .unionByName(above.select(*_NODE, "end_id")))
    members = written(ends.join(sequences.select(*key, "seq"), key).select("seq", "conv_id"), "members")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (every.join(_end_digests(members), "end_id", "left")
            .select(*_NODE, F.coalesce("ends_sha256", nothing).alias("ends_sha256")))


def with_shared_heads(placed: DataFrame, *, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows and conversations for ``nodes``, from ``positions``: conversation c
    starts with the first h = crc32(c) % ``heads`` turns of conversation
    c - c % ``family`` (all it has, if fewer), and goes on with its own turns
    after its first h."""
    placed = written(placed, "placed")
    conversations = placed.select("conv_id").distinct()
    first = placed.where((F.col("conv_id") % family == 0) & (F.col("place") < heads - 1)).select(
        F.col("conv_id").alias("head_id"), "place", "digest", "words")
    known = first.groupBy("head_id").agg(F.count("*").alias("known"))
    plan = (conversations.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % family)
            .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
            .join(known, "head_id", "left")
            .withColumn("taken", F.least("h", F.coalesce("known", F.lit(0).cast("long")))))
    plan = written(plan, "heads")
    lent = plan.join(first, "head_id").where("place < h").select(
        "conv_id", (F.col("place") + 1).alias("depth"), "digest", "words")
    own = placed.join(plan.select("conv_id", "h", "taken"), "conv_id").where("place >= h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "digest", "words")
    return lent.unionByName(own), conversations


def prefix_trie(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", **options) -> DataFrame:
    """The nodes of the trie of conversations as they are."""
    placed = written(positions(turns, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col),
                     "placed")
    rows = placed.select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "words")
    return nodes(rows, placed.select("conv_id").distinct(), **options)
