"""Exact Jaccard join of word n-gram sets by token-combination prefixes.

A text is the set of its distinct shingles (``shingle`` consecutive words,
A-Z in lower case; a shorter text is one shingle). Two texts link if 100 times
the intersection is at least ``percent`` times the union.

All shingles have one global order, by an estimate of their document frequency
(a count-min table over all texts, summed from the tasks' tables in a tree),
then by hash. A text of n shingles that has a partner misses at most
n - ceil(n percent / 100) of its shingles there. Shingles are indexed by class:

* rare ones (in at most the share ``rare`` of the texts) alone,
* frequent ones in pairs, and very frequent ones (eight times the share) in
  triples, within classes dealt by hash, so that a class has about four, or
  six, shingles of a prefix and the combinations stay linear in n.

A prefix is extended, rare shingles first, until its coverage, the sum of
(shingles of the class - combination size + 1) over all classes, exceeds the
number of shingles that may miss. Whatever misses, one class then keeps enough
shingles for a whole combination, so two texts that link share one. The number
of classes depends on the level (power of two) of the larger size of a pair; a
text's pairs and triples are indexed at its own level and at that of the
largest partner. The order is only a matter of speed: the result does not
depend on the estimates.

Buckets of up to ``small`` texts give all their pairs. In larger ones every
text is compared with one hub per round (the text of the commonest shingles
first), in ``hub_rounds`` rounds; what then still lies in different components
is compared exactly, in blocks: histograms first say which members can link at
all. Where few pairs are left, these are compared once each, however many
buckets share them; else matrix products of the sets give out only links
between components. Equal sets are one node throughout, known by a digest.
Pairs are verified on the sets themselves (48 bits of the shingles' hashes),
after a test by small histograms that no linked pair fails.

Defined results: null texts and texts without a word have no shingles and link
with nothing, each its own component; equal sets link; repeated rows and ids
are rows of one component; its id is the least, null if all are null; other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded
from sift.llm.components import components, written
from sift.llm.shingles import WordHashes, mix, whole_windows, window_hashes, word_runs
from sift.llm.trees import in_tree

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def _set_maker(shingle: int):
    """Per text: id, digest of its set, size, and the sorted set."""

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            ids = batch.column(0)
            texts = [t.lower() if t else t for t in batch.column(1).to_pylist()]
            for first, counts, hashes in word_runs(texts, memo):
                whole = whole_windows(counts, shingle)
                of = np.repeat(np.arange(len(counts)), counts)
                text, grams = of[:len(whole)][whole], mix(window_hashes(hashes, shingle)[whole])
                ends = np.cumsum(counts)
                few = np.flatnonzero((counts > 0) & (counts < shingle))
                if len(few):
                    ones = [mix(window_hashes(hashes[ends[k] - counts[k]:ends[k]], int(counts[k])))[0] for k in few]
                    text, grams = np.concatenate([text, few]), np.concatenate([grams, np.array(ones, np.uint64)])
                order = np.lexsort((grams, text))
                text, grams = text[order], grams[order]
                new = np.ones(len(text), np.bool_)
                new[1:] = (text[1:] != text[:-1]) | (grams[1:] != grams[:-1])
                text, grams = text[new], grams[new]
                sizes = np.bincount(text, minlength=len(counts))
                stops = np.cumsum(sizes)
                keys = [hashlib.blake2b(grams[b - n:b].tobytes(), digest_size=16).digest() if n else None
                        for b, n in zip(stops.tolist(), sizes.tolist())]
                packed = _pack(grams)
                sets = [packed[_BYTES * (b - n):_BYTES * b] for b, n in zip(stops.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(counts)), pa.array(keys, pa.binary()), pa.array(sizes.astype(np.int64)),
                     pa.array(sets, pa.binary())], names=["doc_id", "key", "n", "grams"])

    return run


_BYTES = 6  # of a shingle's hash in a stored set


def _pack(grams: np.ndarray) -> bytes:
    """The upper 48 bits of sorted 64-bit hashes."""
    return (grams >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // _BYTES, 8), np.uint8)
    out[:, :_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, _BYTES)
    return out.view("<u8").reshape(-1).astype(np.uint64, copy=False)


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The sets (packed), or the histograms, of each row."""
    if pa.types.is_binary(column.type):
        return [unpack(b) for b in column.to_pylist()]
    flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _cells(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    last = np.uint64(width - 1)
    return (grams & last).astype(np.int64), (mix(grams ^ _SECOND) & last).astype(np.int64) + width


_SKETCH = "slot long, counts binary"


def _sketch_batch(slot: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([counts.tobytes()], pa.binary())],
                                      names=["slot", "counts"])


def _sketcher(width: int):
    def run(batches):
        from pyspark import TaskContext
        total, waiting = None, []

        def summed(total):
            part = np.bincount(np.concatenate(waiting), minlength=2 * width)
            waiting.clear()
            return part if total is None else total + part

        for batch in batches:
            waiting.extend(_cells(unpack(b"".join(batch.column(0).to_pylist())), width))
            if sum(map(len, waiting)) > 2_000_000:
                total = summed(total)
        if waiting:
            total = summed(total)
        if total is not None:
            yield _sketch_batch(TaskContext.get().partitionId(), total.astype(np.int64))

    return run


def _sketch_adder(key, table):
    total = sum(np.frombuffer(c, np.int64) for c in table["counts"].to_pylist())
    return pa.Table.from_batches([_sketch_batch(key[0].as_py(), total)])


class Index:
    """Frequency estimates of shingles, and the combinations of a set."""

    def __init__(self, counts: np.ndarray, width: int, frequent: float, percent: int):
        self.counts, self.width, self.frequent, self.percent = counts, width, frequent, percent

    def estimate(self, grams: np.ndarray) -> np.ndarray:
        first, second = _cells(grams, self.width)
        return np.minimum(self.counts[first], self.counts[second])

    def levels(self, n: int) -> range:
        """Of the larger size of all pairs of a set of n."""
        return range(n.bit_length() - 1, (100 * n // self.percent).bit_length())

    def classes(self, level: int) -> tuple[int, int]:
        """Numbers of classes of pairs and of triples; 0 if the smallest set of
        the level could not spare what its classes do not cover."""
        least = -(-self.percent * 2 ** level // 100)
        spare = -(-self.percent * least // 100) - 1
        miss = (100 - self.percent) * 2 ** (level + 1) / 100
        pairs = min(spare, max(1, int(miss / 3)))
        return pairs, min((spare - pairs) // 2, max(1, int(miss / 4)))

    def combinations(self, grams: np.ndarray) -> np.ndarray:
        """Buckets of a set."""
        n, estimate = len(grams), self.estimate(grams)
        order = np.lexsort((grams, estimate))
        grams, estimate = grams[order], estimate[order]
        may_miss = n - -(-self.percent * n // 100)
        out, alone = [], grams[:0]
        for level in self.levels(n):
            salt = mix(np.array([level + 1], np.uint64) * _GOLDEN)[0]
            pairs, triples = self.classes(level)
            size = np.ones(n, np.int64)
            if pairs:
                size[estimate > self.frequent] = 2
            if triples:
                size[estimate > 8 * self.frequent] = 3
            # A shingle adds coverage unless it is among the first of its class.
            spread = mix(grams ^ salt)
            place = np.where(size == 2, spread % np.uint64(max(1, pairs)),
                             np.uint64(pairs) + spread % np.uint64(max(1, triples))).astype(np.int64)
            place[size == 1] = -1
            grouped = np.argsort(place, kind="stable")
            ordered = place[grouped]
            starts = np.searchsorted(ordered, ordered, "left")
            rank = np.empty(n, np.int64)
            rank[grouped] = np.arange(n) - starts
            covers = np.cumsum((size == 1) | (rank >= size - 1))
            stop = int(np.searchsorted(covers, may_miss + 1)) + 1
            if stop > n:
                raise RuntimeError(f"a set of {n} shingles cannot cover {may_miss + 1} at level {level}")
            # Rare shingles come alone, at any level; others with those after them in their class.
            single = grams[:stop][size[:stop] == 1]
            alone = single if len(single) > len(alone) else alone
            inside = grouped[(grouped < stop) & (ordered >= 0)]
            at, hashes, k = place[inside], mix(grams[inside] + salt), size[inside]
            most = int(rank[inside].max(initial=0))
            for near in range(1, most + 1):
                two = np.flatnonzero(at[:-near] == at[near:]) if near < len(at) else at[:0]
                if not len(two):
                    break
                joined = mix(hashes[two] * _GOLDEN ^ hashes[two + near])
                out.append(joined[k[two] == 2])
                three, joined = two[k[two] == 3], joined[k[two] == 3]
                for far in range(near + 1, most + 1):
                    fits = three + far < len(at)
                    three, joined = three[fits], joined[fits]
                    fits = at[three] == at[three + far]
                    three, joined = three[fits], joined[fits]
                    if not len(three):
                        break
                    out.append(mix(joined * _GOLDEN ^ hashes[three + far]))
        return np.unique(np.concatenate([mix(alone ^ _SECOND), *out]))

    @staticmethod
    def histogram(grams: np.ndarray) -> np.ndarray:
        """How many shingles fall in each of some n / 12 cells, by hash."""
        cells = 1 << max(4, len(grams).bit_length() - 4)
        return np.bincount((mix(grams) & np.uint64(cells - 1)).astype(np.int64), minlength=cells).astype(np.int32)

    def commonness(self, grams: np.ndarray) -> float:
        return float(np.log(np.maximum(self.estimate(grams), 1)).mean())


def _indexer(index: Index):
    def run(batches):
        for batch in batches:
            sets = _lists(batch.column(2))
            found = [index.combinations(s) for s in sets]
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            flat = np.concatenate([*found, np.empty(0, np.uint64)])
            cells = pa.array([index.histogram(s) for s in sets], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([round(index.commonness(s), 3) for s in sets], pa.float64()),
                 cells, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
                names=["key", "n", "common", "cells", "buckets"])

    return run


def _repeated(batches):
    """Rows (bucket, mark), sorted, of buckets with two marks or more, and of
    the first and the last bucket, which may go on in another task. Holds a
    batch and one row."""
    bucket = mark = np.empty(0, np.int64)
    first, sure = True, False  # no bucket is over yet; the held row's bucket is repeated

    def rows(take):
        return pa.RecordBatch.from_arrays([pa.array(bucket[take]), pa.array(mark[take])], names=["bucket", "mark"])

    for batch in batches:
        bucket = np.concatenate([bucket, batch.column(0).to_numpy()])
        mark = np.concatenate([mark, batch.column(1).to_numpy()])
        if not len(bucket):
            continue
        new = np.ones(len(bucket), np.bool_)
        new[1:] = (bucket[1:] != bucket[:-1]) | (mark[1:] != mark[:-1])
        bucket, mark = bucket[new], mark[new]
        start = np.ones(len(bucket), np.bool_)
        start[1:] = bucket[1:] != bucket[:-1]
        group = np.cumsum(start) - 1
        keep = np.bincount(group) > 1
        keep[0] |= first or sure
        first, sure = first and len(keep) == 1, bool(keep[-1])
        yield rows(keep[group])
        held = slice(len(bucket) - 1, None)
        bucket, mark = bucket[held], mark[held]
    yield rows(slice(None))


def _likely(marks: DataFrame):
    """Rows whose mark is likely among ``marks``, none of them missing, so that
    few others are shuffled: a bitmap of at most 32 MB, eight bits a mark as
    long as that suffices."""
    width = 1 << min(28, max(15, (8 * marks.count()).bit_length()))
    place = F.pmod("mark", F.lit(width)) + 1
    rows = (marks.groupBy(F.bitmap_bucket_number(place).alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).toArrow())
    bitmap = np.zeros((width // 32768, 4096), np.uint8)
    for part, bits in zip(rows["part"].to_pylist(), rows["bits"].to_pylist()):
        bitmap[part - 1] = np.frombuffer(bits, np.uint8)
    bitmap = bitmap.reshape(-1)

    def run(batches):
        for batch in batches:
            cell = batch.column(0).to_numpy() & (width - 1)
            found = (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
            yield batch.select(["key", "grams"]).filter(pa.array(found.astype(np.bool_)))

    return run


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def may_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether sets with these histograms can link: two sets share at most the
    smaller count of every cell."""
    if len(a) > len(b):
        a, b = b, a
    b = b.reshape(-1, len(a)).sum(axis=0)
    shared = int(np.minimum(a, b).sum())
    return 100 * shared >= percent * (int(a.sum() + b.sum()) - shared)


def _edge_batch(edges: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*edges) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _verifier(test, percent: int):
    """The pairs that pass, of rows (a, b, set or histogram), the two of a pair
    together."""

    def run(batches):
        held = None
        for batch in batches:
            out = []
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for pair, grams in zip(pairs, _lists(batch.column(2))):
                if held is None:
                    held = grams.copy()
                else:
                    if test(held, grams, percent):
                        out.append(pair)
                    held = None
            yield _edge_batch(out)

    return run


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Mask (left, right) of the pairs that link, by matrix products over slices
    of the shingles of both sides."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    shared = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(both), 4096):
        columns = both[at:at + 4096]

        def rows(side):
            out = np.zeros((len(side), len(columns)), np.float32)
            for k, grams in enumerate(side):
                place = np.minimum(np.searchsorted(columns, grams), len(columns) - 1)
                out[k, place[columns[place] == grams]] = 1
            return out

        shared += rows(left) @ rows(right).T
    shared = shared.astype(np.int64)
    total = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return 100 * shared >= percent * (total - shared)


def _exact_unit(rows: list[tuple], percent: int) -> pa.RecordBatch:
    """Links of a block pair that join components."""
    up: dict[bytes, bytes] = {}

    def root(label):
        while (higher := up.get(label, label)) != label:
            label = higher
        return label

    left = [r for r in rows if r[3] != "right"]
    right = [r for r in rows if r[3] != "left"]
    out = []
    if left and right:
        for i, j in np.argwhere(linked([r[6] for r in left], [r[6] for r in right], percent)).tolist():
            one, two = root(left[i][5]), root(right[j][5])
            if one != two:
                up[one] = two
                out.append((left[i][4], right[j][4]))
    return _edge_batch(out)


PAIRS = 8
_UNIT = "bucket long, i int, j int, side string, key binary, label binary"


def _likely_unit(rows: list[tuple], percent: int) -> pa.RecordBatch:
    """What may link across components in a block pair, by the histograms, as
    ``may_link``: the pairs (side ``pair``, the two keys as key and label) if
    there are at most ``PAIRS`` a row, else the rows."""
    right = [k for k, r in enumerate(rows) if r[3] != "left"]
    labels = np.array([r[5] for r in rows], object)
    stacks: dict[int, list] = {}  # by number of cells: the rows that have as many or, folded, twice as many
    for k in right:
        cells = rows[k][6]
        stacks.setdefault(len(cells), []).append((k, cells))
        stacks.setdefault(len(cells) // 2, []).append((k, cells.reshape(-1, len(cells) // 2).sum(axis=0)))
    stacked = {c: (np.array([k for k, _ in part]), np.array([h for _, h in part])) for c, part in stacks.items()}
    pairs: list[tuple[int, int]] = []
    for k, row in enumerate(rows):
        if row[3] == "right":
            continue
        cells, n = row[6], int(row[6].sum())
        for folded in (cells, cells.reshape(-1, len(cells) // 2).sum(axis=0)):
            others, table = stacked.get(len(folded), (right[:0], None))
            if table is None:
                continue
            sizes = table.sum(axis=1)
            fits = np.flatnonzero((100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
                                  & (labels[others] != row[5]))
            shared = np.minimum(table[fits], folded).sum(axis=1)
            near = others[fits[100 * shared >= percent * (sizes[fits] + n - shared)]]
            pairs += [(k, j) for j in near.tolist()]
    if len(pairs) <= PAIRS * len(rows):
        ends = {tuple(sorted((rows[k][4], rows[j][4]))) for k, j in pairs}
        chosen = [(*rows[0][:3], "pair", high, low) for low, high in ends]
    else:
        chosen = [rows[k][:6] for k in sorted({k for pair in pairs for k in pair})]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*chosen) if chosen else [()] * 6, (
            pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary()))],
        names=[c.split()[0] for c in _UNIT.split(", ")])


def _by_unit(work, percent: int):
    """``work`` on the rows of each block pair, which follow each other; the
    last column is a set or a histogram."""

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            heads = zip(*[batch.column(c).to_pylist() for c in range(6)])
            for head, values in zip(heads, _lists(batch.column(6))):
                if rows and head[:3] != rows[0][:3]:
                    yield work(rows, percent)
                    rows = []
                rows.append((*head, values.copy()))
        if rows:
            yield work(rows, percent)

    return run


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with labels."""
    labelled = (members.join(labels.withColumnRenamed("node", "key"), "key", "left")
                .withColumn("label", F.coalesce("label", "key")))
    mixed = (labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .where("low < high").select("bucket"))
    return labelled.join(mixed, "bucket", "left_semi")


def _blocks(opened: DataFrame, block: int) -> DataFrame:
    """Rows (bucket, i, j, side, key, label): the members outside the largest
    component of a bucket meet all members, block by block; of buckets with
    equal members one is enough."""
    by_label = opened.groupBy("bucket", "label").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("digest"))
    info = by_label.groupBy("bucket").agg(F.sum("n").alias("total"), F.max(F.struct("n", "label")).alias("main"),
                                          F.sum("digest").alias("digest"))
    info = (info.groupBy("total", "digest").agg(F.min(F.struct("bucket", "main")).alias("one"))
            .select("one.bucket", F.col("one.main.label").alias("main"),
                    F.ceil((F.col("total") - F.col("one.main.n")) / block).cast("int").alias("lefts"),
                    F.ceil(F.col("total") / block).cast("int").alias("rights")))
    met = opened.select("bucket", "key", "label").join(info, "bucket")
    one, minor = F.expr("lefts * rights = 1"), F.col("label") != F.col("main")
    right = met.select("bucket", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"),
                       F.pmod(F.xxhash64("key"), "rights").cast("int").alias("j"),
                       F.when(one & minor, "both").otherwise("right").alias("side"), "key", "label")
    left = met.where(~one & minor).select(
        "bucket", F.pmod(F.xxhash64("key", F.lit(1)), "lefts").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("j"), F.lit("left").alias("side"), "key", "label")
    return right.unionByName(left)


def join(docs: DataFrame, *, shingle: int = 4, percent: int = 85, rare: float = 0.004, small: int = 8,
         hub_rounds: int = 2, block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = bounded(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    sets = written(texts.mapInArrow(_set_maker(shingle), f"doc_id {id_type}, key binary, n long, grams binary"),
                   "sets")
    known = sets.where("n > 0")
    size = known.agg(F.count("*").alias("texts"), F.sum("n").alias("grams")).first()
    mean = (size["grams"] or 0) / max(1, size["texts"])
    width = 1 << min(20, max(12, int(4 * mean / rare).bit_length()))  # at most 16 MB
    sketch = in_tree(known.select("grams").mapInArrow(_sketcher(width), _SKETCH), _sketch_adder, _SKETCH, "sketch",
                     fan_in=8)
    keyed = sets.select("doc_id", "key", "n")
    if sketch is None:
        return keyed.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    index = Index(np.frombuffer(sketch["counts"], np.int64), width, max(16.0, rare * size["texts"]), percent)

    indexed = written(known.select("key", "n", "grams").mapInArrow(
        _indexer(index), "key binary, n long, common double, cells array<int>, buckets array<long>"), "index")
    # Only buckets of different sets go on. Sorted ranges cut a bucket of any size; no set travels.
    marks = (indexed.select(F.explode("buckets").alias("bucket"), F.xxhash64("key").alias("mark"))
             .repartitionByRange("bucket", "mark").sortWithinPartitions("bucket", "mark")
             .mapInArrow(_repeated, "bucket long, mark long"))
    marks = written(marks.distinct(), "marks")
    sizes = marks.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    keys = indexed.groupBy("key").agg(F.first("n").alias("n"), F.max("common").alias("common"))
    members = written(marks.join(sizes, "bucket").join(keys.withColumn("mark", F.xxhash64("key")), "mark")
                      .select("bucket", "members", "key", "n", "common"), "members")
    fits = F.expr(f"100 * least(n, other_n) >= {percent} * greatest(n, other_n)")
    few = members.where(F.col("members") <= small).select("bucket", "key", "n")
    other = few.select("bucket", F.col("key").alias("other"), F.col("n").alias("other_n"))
    tested = written(few.join(other, "bucket").where((F.col("key") > F.col("other")) & fits)
                     .select(F.col("key").alias("a"), F.col("other").alias("b")).distinct(), "pairs")
    large = written(members.where(F.col("members") > small).select("bucket", "key", "n", "common"), "large")

    cells = indexed.groupBy("key").agg(F.first("cells").alias("cells"))

    def sets_of(keys: DataFrame) -> DataFrame:
        """(key, grams) once per key."""
        likely = known.select(F.xxhash64("key").alias("mark"), "key", "grams").mapInArrow(
            _likely(keys.select(F.xxhash64("key").alias("mark"))), "key binary, grams binary")
        return likely.groupBy("key").agg(F.first("grams").alias("grams"))

    def passed(pairs: DataFrame, values: DataFrame, test) -> DataFrame:
        """The pairs (a, b) whose values (key, value) pass."""
        sides = pairs.select("a", "b", F.col("a").alias("key")).unionByName(
            pairs.select("a", "b", F.col("b").alias("key")))
        rows = values.join(sides, "key").drop("key").select("a", "b", values.columns[1])
        return written(rows.repartition("a", "b").sortWithinPartitions("a", "b")
                       .mapInArrow(_verifier(test, percent), "a binary, b binary"), "edges")

    def verified(pairs: DataFrame) -> DataFrame:
        left = passed(pairs, cells, may_link)
        return passed(left, sets_of(_ends(left)), links)

    edges = verified(tested)
    labels = components(edges)
    for step in range(hub_rounds):
        opened = _open(large, labels)
        first = -F.col("common") if step == 0 else F.lit(0.0)
        hubs = opened.groupBy("bucket").agg(F.min(F.struct(
            first.alias("first"), F.xxhash64(F.lit(step), "key").alias("rank"), "key", "label", "n")).alias("hub"))
        pairs = (opened.join(hubs.select("bucket", "hub", F.col("hub.n").alias("other_n")), "bucket")
                 .where((F.col("label") != F.col("hub.label")) & fits)
                 .select(F.greatest("key", "hub.key").alias("a"), F.least("key", "hub.key").alias("b")).distinct())
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        edges, tested = edges.unionByName(verified(pairs)), tested.unionByName(pairs)
        labels = components(edges)
    def in_units(rows: DataFrame, work, schema: str) -> DataFrame:
        return (rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
                .mapInArrow(_by_unit(work, percent), schema))

    unit = [c.split()[0] for c in _UNIT.split(", ")]
    blocks = _blocks(written(_open(large, labels), "open"), block).join(cells, "key").select(*unit, "cells")
    likely = written(in_units(blocks, _likely_unit, _UNIT), "likely")
    paired, blocked = likely.where("side = 'pair'"), likely.where("side <> 'pair'")
    pairs = written(paired.select(F.col("key").alias("a"), F.col("label").alias("b")).distinct()
                    .join(tested, ["a", "b"], "left_anti"), "pairs")
    met = blocked.join(sets_of(blocked.select("key").distinct()), "key").select(*unit, "grams")
    found = passed(pairs, sets_of(_ends(pairs)), links).unionByName(
        written(in_units(met, _exact_unit, "a binary, b binary"), "edges"))
    if not found.isEmpty():
        labels = components(edges.unionByName(found))

    least = (keyed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
             .join(labels.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("label", F.coalesce("label", "key")))
    by_label = least.groupBy("label").agg(F.min("least").alias("component_id"))
    by_key = least.select("key", "label").join(by_label, "label").select("key", "component_id")
    return keyed.join(by_key, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
