"""Near-duplicate classes by improved consistent weighted sampling.

A text is a weighted set of shingles: ``shingle`` consecutive lower-case words
(a shorter text is one shingle). A shingle weighs (1 + ln tf) times an idf
between 1 and 1 + ``spread``: the most for shingles in at most the share
``rare`` of all documents, falling with ln(df) to 1 for a shingle in every
document. The spread is small, so that the shingles of a very large group of
near copies, which are common, hardly weigh less than the edits. The document
frequencies of all shingles are counted over all documents in a count-min table
whose width follows from ``rare`` and the mean length of a text, so its size
does not grow with the corpus and its error stays far below the share ``rare``.

Improved consistent weighted sampling draws bands x rows samples per text; two
texts draw the same sample with a probability equal to their weighted Jaccard
similarity. The samples of a band make a bucket; texts in one bucket are
candidates and are verified with the exact weighted Jaccard similarity of
their shingles. A pair at the threshold is missed with a probability of
(1 - threshold^rows)^bands. With ``plain`` a pair also counts as similar if the
plain Jaccard similarity of the shingle sets reaches the threshold, and each
text draws as many bands with all weights equal (min-hashing); this is off.

Classes are the connected components of the verified pairs. Exact copies are
one node (a digest of the text), so copies are never expanded into pairs. In a
bucket, members are first compared with one hub, in ``hub_rounds`` rounds with
another hub each (the text of the commonest shingles first: the original of a
group of near copies), which is linear in the bucket. A bucket's rows are dealt
over parts of about ``block`` members for every join, and what is found per
bucket is repeated per part, so no bucket meets in one task. What is still apart then
is compared exactly: the members outside the bucket's largest component, in
blocks, with all members, in blocks. A block pair is one matrix product, and
only links that join components are given out, so no pair is left out and no
list of pairs is made.

Defined results: null texts and texts without a word are alone in their class,
unless the text is an exact copy (null equals null only in being alone);
repeated rows and ids are rows of one class; the class id is the smallest id of
the class, null if all its ids are null; other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded
from sift.llm.components import components, written
from sift.llm.shingles import WordHashes, mix, whole_windows, window_hashes, word_runs
from sift.operators.skew import salted_join, split_hot_join

_GOLDEN = 0x9E3779B97F4A7C15
_STEP = np.uint64(_GOLDEN)
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_TABLE = 1 << 16


def _gamma_table() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of equal bins,
    by Newton's method on its distribution function 1 - (1 + x) e^-x."""
    p = (np.arange(_TABLE) + 0.5) / _TABLE
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - ((1 - (1 + x) * np.exp(-x)) - p) / np.maximum(x * np.exp(-x), 1e-300), x / 2)
    return x


class Weights:
    """Weighted shingles of texts; the document frequencies are a count-min
    table of two rows, or not there yet."""

    def __init__(self, shingle: int, rare: float, spread: float, width: int, docs: int = 0,
                 counts: np.ndarray | None = None):
        self.shingle, self.rare, self.spread, self.width = shingle, rare, spread, width
        self.docs, self.counts = docs, counts

    def cells(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = np.uint64(self.width - 1)
        return ((shingles & last).astype(np.int64),
                (mix(shingles ^ _SECOND) & last).astype(np.int64) + self.width)

    def sets(self, counts: np.ndarray, hashes: np.ndarray):
        """Distinct shingles of a run of texts: text, shingle, tf; sorted by
        text and shingle."""
        whole = whole_windows(counts, self.shingle)
        texts = np.repeat(np.arange(len(counts)), counts)
        text, shingle = texts[:len(whole)][whole], mix(window_hashes(hashes, self.shingle)[whole])
        ends = np.cumsum(counts)
        short = np.flatnonzero((counts > 0) & (counts < self.shingle))
        if len(short):
            ones = [mix(window_hashes(hashes[ends[k] - counts[k]:ends[k]], int(counts[k])))[0]
                    for k in short]
            text, shingle = np.concatenate([text, short]), np.concatenate([shingle, np.array(ones, np.uint64)])
        order = np.lexsort((shingle, text))
        text, shingle = text[order], shingle[order]
        new = np.ones(len(text), np.bool_)
        new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
        at = np.flatnonzero(new)
        return text[at], shingle[at], np.diff(np.append(at, len(text)))

    def idf(self, shingles: np.ndarray) -> np.ndarray:
        first, second = self.cells(shingles)
        df = np.maximum(np.minimum(self.counts[first], self.counts[second]), 1)
        share = np.clip(df / max(1, self.docs), self.rare, 1.0)
        return 1 + self.spread * np.log(share) / math.log(self.rare)

    def of(self, shingles: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (1 + np.log(tf)) * self.idf(shingles)

    def of_text(self, text: bytes, memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of one text, and their weights."""
        words = memo.of(text.split())
        _, shingles, tf = self.sets(np.array([len(words)]), words)
        return shingles, self.of(shingles, tf)


def _frequencies(weights: Weights):
    """Cells of the shingles of every text, summed per task."""

    def run(batches):
        memo, total = WordHashes(), np.zeros(2 * weights.width, np.int64)
        for batch in batches:
            for _, counts, hashes in word_runs(batch.column(0).to_pylist(), memo):
                _, shingles, _ = weights.sets(counts, hashes)
                for cells in weights.cells(shingles):
                    np.add.at(total, cells, 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(total[cells])],
                                         names=["cell", "n"])

    return run


def _count_frequencies(texts: DataFrame, shingle: int, rare: float, spread: float) -> Weights:
    size = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    docs = size["n"]
    mean = max(1, (size["size"] or 0) // 6 // max(1, docs))  # about 6 bytes a word
    width = 1 << min(22, max(12, math.ceil(math.log2(4 * mean / rare))))
    weights = Weights(shingle, rare, spread, width)
    rows = (texts.select("text").mapInArrow(_frequencies(weights), "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(2 * width, np.int64)
    counts[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return Weights(shingle, rare, spread, width, docs, counts)


def draw(text: np.ndarray, shingles: np.ndarray, weights: np.ndarray, samples: int,
         table: np.ndarray) -> np.ndarray:
    """``samples`` consistent weighted samples of each text: an array (texts
    with a shingle, samples). ``text`` is sorted."""
    starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    sizes = np.diff(np.append(starts, len(text)))
    log_w, log_table, inverse = np.log(weights), np.log(table), 1 / table
    out = np.empty((len(starts), samples), np.uint64)
    low = np.uint64(_TABLE - 1)
    for k in range(samples):
        random = mix(shingles + np.uint64(_GOLDEN * (k + 1) % 2 ** 64))
        r_at = (random & low).astype(np.int64)
        c_at = ((random >> np.uint64(16)) & low).astype(np.int64)
        beta = (random >> np.uint64(32)).astype(np.float64) * 2.0 ** -32
        t = np.floor(log_w * inverse[r_at] + beta)
        log_a = log_table[c_at] - table[r_at] * (t - beta + 1)
        least = np.repeat(np.minimum.reduceat(log_a, starts), sizes)
        sample = mix(random ^ (t.astype(np.int64).view(np.uint64) * _SECOND))
        sample[log_a != least] = np.uint64(2 ** 64 - 1)
        out[:, k] = np.minimum.reduceat(sample, starts)
    return out


def draw_plain(text: np.ndarray, shingles: np.ndarray, samples: int) -> np.ndarray:
    """As ``draw``, with all weights equal."""
    starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    out = np.empty((len(starts), samples), np.uint64)
    for k in range(samples):
        out[:, k] = np.minimum.reduceat(mix((shingles ^ _SECOND) + np.uint64(_GOLDEN * (k + 1) % 2 ** 64)), starts)
    return out


def _signer(weights: Weights, bands: int, rows: int, plain: bool):
    """Of each text its buckets, one per band of weighted (and of plain)
    samples, and the mean idf of its shingles."""
    table, width = _gamma_table(), bands * (1 + plain)

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            keys = batch.column(0)
            for first, counts, hashes in word_runs(batch.column(1).to_pylist(), memo, 30_000):
                text, shingles, tf = weights.sets(counts, hashes)
                if not len(text):
                    continue
                samples = draw(text, shingles, weights.of(shingles, tf), bands * rows, table)
                if plain:
                    samples = np.hstack([samples, draw_plain(text, shingles, bands * rows)])
                buckets = np.empty((len(samples), width), np.uint64)
                for b in range(width):
                    value = np.full(len(samples), b + 1, np.uint64)
                    for r in range(rows):
                        value = mix(value * _STEP ^ samples[:, b * rows + r])
                    buckets[:, b] = value
                starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                share = np.add.reduceat(weights.idf(shingles), starts) / np.diff(np.append(starts, len(text)))
                flat = pa.array(buckets.reshape(-1).view(np.int64))
                offsets = pa.array(np.arange(0, buckets.size + 1, width, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(first + text[starts])), pa.array(np.round(share, 6)),
                     pa.ListArray.from_arrays(offsets, flat)], names=["key", "rarity", "buckets"])

    return run


def similar(a: tuple, b: tuple, threshold: float, plain: bool = False) -> bool:
    """Whether two weighted sets reach the threshold (or their plain sets)."""
    (sa, wa), (sb, wb) = a, b
    _, at, bt = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[at], wb[bt]).sum()
    return bool(shared >= threshold * (wa.sum() + wb.sum() - shared) - 1e-9
                or plain and len(at) >= threshold * (len(sa) + len(sb) - len(at)) - 1e-9)


def _verifier(weights: Weights, threshold: float, plain: bool):
    """Of candidate pairs with both texts, the similar ones."""

    def run(batches):
        memo = WordHashes()
        for batch in batches:
            take, left, right = [], batch.column(2).to_pylist(), batch.column(3).to_pylist()
            cache: dict[bytes, tuple] = {}

            def weighted(text: bytes):
                if text not in cache:
                    if len(cache) >= 64:
                        cache.clear()
                    cache[text] = weights.of_text(text, memo)
                return cache[text]

            for k, (a, b) in enumerate(zip(left, right)):
                if similar(weighted(a), weighted(b), threshold, plain):
                    take.append(k)
            yield batch.select(["a", "b"]).take(pa.array(take, pa.int64()))

    return run


def may_reach(left: list[tuple], right: list[tuple], threshold: float, plain: bool = False) -> np.ndarray:
    """Mask (left, right) of the pairs that can be ``similar``. Shared weights are
    bounded by the root of the product of the two; shared counts are exact.
    Only shingles of both sides are columns, in slices, so memory is bounded."""
    both = np.intersect1d(np.concatenate([x for x, _ in left]), np.concatenate([x for x, _ in right]))
    count = np.zeros((len(left), len(right)), np.float32)
    weight = np.zeros_like(count)
    for at in range(0, len(both), 4096):
        columns = both[at:at + 4096]

        def rows(side):
            out = np.zeros((len(side), len(columns)), np.float32)
            for k, (shingles, w) in enumerate(side):
                place = np.minimum(np.searchsorted(columns, shingles), len(columns) - 1)
                here = columns[place] == shingles
                out[k, place[here]] = np.sqrt(w[here])
            return out

        x, y = rows(left), rows(right)
        weight += x @ y.T
        if plain:
            count += (x > 0).astype(np.float32) @ (y > 0).astype(np.float32).T
    mask = np.zeros(count.shape, np.bool_)
    for shared, size in ((weight, lambda s: s[1].sum()), (count, lambda s: len(s[0])))[:1 + plain]:
        total = np.array([size(s) for s in left])[:, None] + np.array([size(s) for s in right])[None, :]
        mask |= shared >= (threshold - 1e-4) * (total - shared)
    return mask


def _rest_verifier(weights: Weights, threshold: float, plain: bool):
    """Links that join components, of block pairs whose rows follow each other."""

    def links(rows: list[tuple]) -> list[tuple]:
        memo_label: dict[bytes, bytes] = {}

        def root(label):
            while (up := memo_label.get(label, label)) != label:
                label = up
            return label

        sets = [weights.of_text(text, memo) for *_, text in rows]
        left = [k for k, row in enumerate(rows) if row[0] != "right"]
        right = [k for k, row in enumerate(rows) if row[0] != "left"]
        if not left or not right:
            return []
        mask = may_reach([sets[k] for k in left], [sets[k] for k in right], threshold, plain)
        out = []
        for i, j in np.argwhere(mask).tolist():
            (_, a, la, _), (_, b, lb, _) = rows[left[i]], rows[right[j]]
            if root(la) != root(lb) and similar(sets[left[i]], sets[right[j]], threshold, plain):
                memo_label[root(la)] = root(lb)
                out.append((a, b))
        return out

    memo = WordHashes()

    def run(batches):
        unit, rows = None, []
        for batch in batches:
            found = []
            columns = [batch.column(n).to_pylist() for n in ("bucket", "i", "j", "side", "key", "label", "text")]
            for *here, side, key, label, text in zip(*columns):
                if here != unit:
                    if rows:
                        found += links(rows)
                    unit, rows = here, []
                rows.append((side, key, label, text))
            yield _edge_batch(found)
        yield _edge_batch(links(rows) if rows else [])

    return run


def _edge_batch(edges: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*edges) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _rest_blocks(opened: DataFrame, block: int) -> DataFrame:
    """Rows (bucket, i, j, side, key, label): which members meet in which block
    pair. Buckets of two have met their hub; of buckets with equal members one
    is enough."""
    by_label = opened.groupBy("bucket", "parts", "label").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("digest"))
    info = by_label.groupBy("bucket", "parts").agg(
        F.sum("n").alias("total"), F.max(F.struct("n", "label")).alias("main"),
        F.sum("digest").alias("digest")).where("total > 2")
    info = (info.groupBy("total", "digest").agg(F.min(F.struct("bucket", "parts", "main")).alias("one"))
            .select("one.bucket", "one.parts", F.col("one.main.label").alias("main"),
                    F.ceil((F.col("total") - F.col("one.main.n")) / block).cast("int").alias("lefts"),
                    F.ceil(F.col("total") / block).cast("int").alias("rights")))
    met = opened.select("bucket", "part", "key", "label").join(_per_part(info), ["bucket", "part"])
    one, minor = F.expr("lefts * rights = 1"), F.col("label") != F.col("main")
    right = met.select("bucket", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"),
                       F.pmod(F.xxhash64("key"), "rights").cast("int").alias("j"),
                       F.when(one & minor, "both").otherwise("right").alias("side"), "key", "label")
    left = met.where(~one & minor).select(
        "bucket", F.pmod(F.xxhash64("key", F.lit(1)), "lefts").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("j"),
        F.lit("left").alias("side"), "key", "label")
    return right.unionByName(left)


def _distinct_pairs(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _with_text(rows: DataFrame, pairs: DataFrame, texts: DataFrame, side: str, other: str) -> DataFrame:
    """``rows`` with the text of one side; hubs of many pairs are salted."""
    return salted_join(rows, texts.select(F.col("key").alias(side), F.col("text").alias(f"text_{side}")), side,
                       pairs.groupBy(side).agg(F.count("*").alias("n")), "n", other, max_hot=100, salts=32)


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("key"))
    return (members.join(labels.withColumnRenamed("node", "key"), "key", "left")
            .withColumn("label", F.coalesce("label", "key")))


def _per_part(per_bucket: DataFrame) -> DataFrame:
    """A row for every part of a bucket, in place of one with ``parts``."""
    return per_bucket.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def _open_buckets(members: DataFrame, labels: DataFrame | None, order: Column | None = None) -> DataFrame:
    """Members of buckets that hold more than one component, with the least by
    ``order`` as ``hub``."""
    labelled = _labelled(members, labels)
    hub = F.min(order).alias("hub") if order is not None else F.lit(None).alias("hub")
    mixed = (labelled.groupBy("bucket", "parts").agg(F.min("label").alias("low"), F.max("label").alias("high"), hub)
             .where("low < high").select("bucket", "parts", "hub"))
    return labelled.join(_per_part(mixed), ["bucket", "part"])


def classes(docs: DataFrame, *, shingle: int = 5, threshold: float = 0.8, bands: int = 12,
            rows: int = 3, rare: float = 0.01, spread: float = 0.25, plain: bool = False, hub_rounds: int = 2,
            block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``key`` (digest of the text, null for
    null), ``class_id`` and ``class_key``, the key of the text with that id
    (the least key, if several texts have it)."""
    lowered = F.lower(F.col(text_col)).cast("binary").alias("text")
    named = bounded(docs).select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(F.col(text_col))).alias("key"),
                        lowered)
    weights = _count_frequencies(named.select("text"), shingle, rare, spread)
    signed = named.where("key is not null").select("key", "text").mapInArrow(
        _signer(weights, bands, rows, plain), "key binary, rarity double, buckets array<long>")
    every = signed.select("key", "rarity", F.explode("buckets").alias("bucket")).distinct()
    shared = written(every, "buckets")
    many = written(shared.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    members = split_hot_join(shared, many, "bucket", "n", max_hot=1000).withColumn(
        "parts", F.ceil(F.col("n") / block).cast("int")).withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int"))
    members = written(members.drop("n"), "members")
    wanted = members.select("key").distinct()
    texts = written(named.select("key", "text").join(wanted, "key", "left_semi")
                    .groupBy("key").agg(F.first("text").alias("text")), "texts")

    edges, tested, labels = None, None, None
    for step in range(max(1, hub_rounds)):  # every member against one hub
        first = F.col("rarity") if step == 0 else F.lit(0.0)
        order = F.struct(first.alias("first"), F.xxhash64(F.lit(step), "key").alias("rank"), "key", "label")
        pairs = (_open_buckets(members, labels, order).where("label != hub.label")
                 .select(F.col("hub.key").alias("a"), F.col("key").alias("b")))
        pairs = written(_distinct_pairs(pairs, tested), "pairs")
        both = _with_text(_with_text(pairs, pairs, texts, "a", "b"), pairs, texts, "b", "a").select(
            "a", "b", "text_a", "text_b")
        linked = written(both.mapInArrow(_verifier(weights, threshold, plain), "a binary, b binary"), "edges")
        tested = pairs if tested is None else tested.unionByName(pairs)
        edges = linked if edges is None else edges.unionByName(linked)
        labels = components(edges)
    opened = _open_buckets(members, labels)
    met = _rest_blocks(opened, block).join(texts, "key").select(
        "bucket", "i", "j", "side", "key", "label", "text")
    linked = written(met.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
                     .mapInArrow(_rest_verifier(weights, threshold, plain), "a binary, b binary"), "edges")
    if not linked.isEmpty():
        labels = components(linked if edges is None else edges.unionByName(linked))

    keyed = named.select("doc_id", "key")
    if labels is None:
        labels = members.sparkSession.createDataFrame([], "node binary, label binary")
    least = (keyed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
             .join(labels.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("label", F.coalesce("label", "key")))
    first = F.min(F.struct(F.col("least").isNull().alias("unknown"), "least", "key"))
    by_label = least.groupBy("label").agg(first.alias("first"))
    by_key = least.select("key", "label").join(by_label, "label").select(
        "key", F.col("first.least").alias("class_id"), F.col("first.key").alias("class_key"))
    return (keyed.join(by_key, "key", "left")
            .select("doc_id", "key", F.when(F.col("key").isNull(), F.col("doc_id"))
                    .otherwise(F.col("class_id")).alias("class_id"), "class_key"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id; of
    rows with that id, one. Null texts stay, each."""
    found = classes(docs, id_col=id_col, text_col=text_col, **options)
    kept = (found.where("key = class_key and doc_id <=> class_id")
            .select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key")).distinct())
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("doc_id"),
                       F.unhex(F.md5(F.col(text_col))).alias("key"))
    one = (rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id"))
                     & (F.col("key") == F.col("kept_key")), "left_semi")
           .dropDuplicates(["doc_id", "key"]))
    return one.select("doc.*").unionByName(docs.where(F.col(text_col).isNull()))
