"""Hard-negative mining with R-trees packed by sort-tile-recursive ordering.

Rows are sorted over the whole table by label and first component; runs of them are tiled
recursively into leaves of LEAF rows. A leaf is a row of a stored table: its ids, labels, vectors and,
per component, the least and the greatest value. These boxes give an interval for the inner products of an
anchor with all rows of the leaf, or of the node above it. Every anchor visits nodes in the order of
their upper ends and leaves out those outside its score window or strictly below its k-th score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketline.llm.common import scratch, stored

LEAF = 64  # rows of a leaf
FAN = 32  # leaves of an inner node
SLAB = LEAF * FAN * 4  # rows that are tiled at once, one after the other in the order of the table
GROUP = 1 << 17  # rows of the trees that a task holds at once, at most about
TILE = 256  # anchors whose bounds are taken at once
WAVE = 4  # leaves that are opened at once
SAFE = 1 << 53  # sums below this are exact in double precision
WIDEST = 1 << 61
LOWEST = -(1 << 62)


def usable_rows(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and floor(scale * x) of each component, of the rows that take part.

    Null ids, labels and vectors, empty vectors, and null or non-finite components take no part. Rows of
    one vec_id are one row, the smallest by vector, then label.
    """
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    rows = embeddings.where("vec_id is not null and label is not null and size(embedding) > 0").where(finite)
    scaled = F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(scaled.alias("v"), F.col("label").cast("long").alias("label")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


# --- Packing -------------------------------------------------------------------------


def tiles(v: np.ndarray, rows: np.ndarray, used: tuple[int, ...] = ()) -> Iterator[np.ndarray]:
    """The rows in leaves: slices of equal size along the widest component, each cut further along the next."""
    leaves = -(-len(rows) // LEAF)
    if leaves <= 1:
        yield rows
        return
    spread = v[rows].max(0).astype(float) - v[rows].min(0)
    if len(used) < len(spread):
        spread[list(used)] = -1
    widest = int(spread.argmax())
    levels = max(1, min(3 - len(used), v.shape[1] - len(used)))
    slices = leaves if levels == 1 else int(np.ceil(leaves ** (1 / levels)))
    size = -(-leaves // slices) * LEAF
    rows = rows[np.argsort(v[rows, widest], kind="stable")]
    for lo in range(0, len(rows), size):
        yield from tiles(v, rows[lo : lo + size], (*used, widest))


def leaves(rows: DataFrame) -> DataFrame:
    """One row per leaf: node (its inner node), dim, ids, labels, v, low and high."""

    def packed(held: list[tuple], shard: int, node: int):
        ids, labels = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        v = np.concatenate([h[2] for h in held])
        # Long runs of one label have leaves of their own; shorter ones share them.
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
        parts, at = [], 0
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if hi - lo >= LEAF:
                parts += [(at, lo), (lo, hi)]
                at = hi
        parts.append((at, len(labels)))
        found = [leaf for lo, hi in parts if hi > lo for leaf in tiles(v, np.arange(lo, hi))]
        flat = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * v.shape[1]), pa.array(x.ravel()))
        lists = lambda x: pa.array([x[leaf] for leaf in found], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array((shard << 40) + node + np.arange(len(found), dtype=np.int64) // FAN),
                pa.array(np.full(len(found), v.shape[1], np.int32)), lists(ids), lists(labels),
                pa.array([v[leaf].ravel() for leaf in found], pa.list_(pa.int64())),
                flat(np.stack([v[leaf].min(0) for leaf in found])), flat(np.stack([v[leaf].max(0) for leaf in found])),
            ],
            names=["node", "dim", "ids", "labels", "v", "low", "high"],
        )

    def run(batches):
        shard, node, held, n = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for lo in range(0, batch.num_rows, SLAB // 2):
                part = batch.slice(lo, SLAB // 2)
                for dim in np.unique(dims[lo : lo + SLAB // 2]).tolist():
                    own = part.filter(pa.array(dims[lo : lo + SLAB // 2] == dim))
                    if held and (held[0][2].shape[1] != dim or n + own.num_rows > SLAB):
                        yield (out := packed(held, shard, node))
                        node += -(-out.num_rows // FAN)
                        held, n = [], 0
                    v = own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    held.append((own.column("vec_id").to_numpy(), own.column("label").to_numpy(), v))
                    n += own.num_rows
        if held:
            yield packed(held, shard, node)

    order = ["dim", "label", F.col("v")[0], "vec_id"]
    rows = rows.withColumn("dim", F.size("v")).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = "node long, dim int, ids array<long>, labels array<long>, v array<long>, low array<long>, high array<long>"
    return rows.mapInArrow(run, kind)


# --- Searching -----------------------------------------------------------------------


def _product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products, exact."""
    if x.shape[-1] * float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) < SAFE:
        return (x.astype(float) @ y.T.astype(float)).astype(np.int64)
    return x @ y.T


@dataclass
class Trees:
    """The R-trees of a group: leaves in the order of their inner nodes."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    begin: np.ndarray  # first row of each leaf, and the number of rows
    low: np.ndarray
    high: np.ndarray
    nodes: np.ndarray  # first leaf of each inner node, and the number of leaves
    label_low: np.ndarray = field(init=False)
    label_high: np.ndarray = field(init=False)

    def __post_init__(self):
        self.label_low = np.minimum.reduceat(self.labels, self.begin[:-1])
        self.label_high = np.maximum.reduceat(self.labels, self.begin[:-1])

    @staticmethod
    def of(batch: pa.Table) -> Trees:
        batch = batch.sort_by("node").combine_chunks()
        lists = lambda c: batch.column(c).chunk(0)
        dim = batch.column("dim")[0].as_py()
        flat = lambda c: lists(c).flatten().to_numpy(zero_copy_only=False)
        size = lists("ids").value_lengths().to_numpy()
        node = batch.column("node").to_numpy()
        return Trees(
            flat("ids"), flat("labels"), flat("v").reshape(-1, dim), np.concatenate([[0], np.cumsum(size)]),
            flat("low").reshape(-1, dim), flat("high").reshape(-1, dim), np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1, [len(node)]]),
        )

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the scores of each query in each leaf."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return _product(up, self.low) + _product(down, self.high), _product(up, self.high) + _product(down, self.low)

    def scored(self, q: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of all rows of some leaves."""
        rows = np.concatenate([np.arange(self.begin[i], self.begin[i + 1]) for i in leaf.tolist()])
        return rows, _product(q[None], self.v[rows])[0]


class Queue:
    """Best-first search of one query over the trees; scores of opened leaves are kept for further windows."""

    def __init__(self, trees: Trees, q: np.ndarray, low: np.ndarray, high: np.ndarray, open_: np.ndarray):
        self.trees, self.q, self.low, self.high, self.open = trees, q, low, high, open_
        self.node_high = np.maximum.reduceat(np.where(open_, high, LOWEST), trees.nodes[:-1])
        self.node_low = np.minimum.reduceat(low, trees.nodes[:-1])
        self.memo: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def leaf(self, some: list[int]) -> tuple[np.ndarray, np.ndarray]:
        new = [i for i in some if i not in self.memo]
        if new:
            rows, scores = self.trees.scored(self.q, np.array(new))
            cuts = np.cumsum([self.trees.begin[i + 1] - self.trees.begin[i] for i in new])[:-1]
            self.memo.update(zip(new, zip(np.split(rows, cuts), np.split(scores, cuts))))
        got = [self.memo[i] for i in some]
        return np.concatenate([r for r, _ in got]), np.concatenate([s for _, s in got])

    def best(self, k: int, least: int, most: int, allowed) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best allowed rows with least <= score <= most, by score, then id.

        ``least`` rises to the k-th score as soon as there are k rows; boxes strictly below it, or
        with no score in the window, are never opened.
        """
        trees = self.trees
        heap = [(-int(h), 0, i) for i, h in enumerate(self.node_high.tolist()) if h >= least and self.node_low[i] <= most]
        heapq.heapify(heap)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while heap and -heap[0][0] >= least:
            wave: list[int] = []
            while heap and -heap[0][0] >= least and len(wave) < WAVE:
                _, is_leaf, i = heapq.heappop(heap)
                if is_leaf:
                    wave.append(i)
                    continue
                lo, hi = int(trees.nodes[i]), int(trees.nodes[i + 1])
                fits = self.open[lo:hi] & (self.high[lo:hi] >= least) & (self.low[lo:hi] <= most)
                for j in (np.flatnonzero(fits) + lo).tolist():
                    heapq.heappush(heap, (-int(self.high[j]), 1, j))
            if not wave:
                continue
            new, got = self.leaf(wave)
            keep = (got >= least) & (got <= most) & allowed(new)
            rows, scores = np.concatenate([rows, new[keep]]), np.concatenate([scores, got[keep]])
            if len(rows) > k:
                order = np.lexsort((trees.ids[rows], -scores))[:k]
                rows, scores = rows[order], scores[order]
            if len(rows) == k:
                least = max(least, int(scores.min()))
        order = np.lexsort((trees.ids[rows], -scores))[:k]
        return rows[order], scores[order]


def _positives(trees: Trees, batch: pa.RecordBatch, k: int):
    """The k best rows of the anchor's label, the anchor itself left out."""
    ids, labels, floor = (batch.column(c).to_numpy() for c in ("anchor_id", "label", "floor"))
    q = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    low, high = trees.bounds(q)
    for i, (anchor, label) in enumerate(zip(ids.tolist(), labels.tolist())):
        open_ = (trees.label_low <= label) & (trees.label_high >= label)
        if open_.any():
            allowed = lambda rows: (trees.labels[rows] == label) & (trees.ids[rows] != anchor)  # noqa: B023, E731
            rows, scores = Queue(trees, q[i], low[i], high[i], open_).best(k, int(floor[i]), WIDEST, allowed)
            yield np.full(len(rows), anchor), np.full(len(rows), -1), trees.ids[rows], np.full(len(rows), 0), scores


def _negatives(trees: Trees, batch: pa.RecordBatch, k: int, share: tuple[int, int]):
    """For each positive of an anchor the k best rows of other labels in its score window."""
    ids, labels = batch.column("anchor_id").to_numpy(), batch.column("label").to_numpy()
    q = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    low, high = trees.bounds(q)
    for i, (anchor, label) in enumerate(zip(ids.tolist(), labels.tolist())):
        open_ = ~((trees.label_low == label) & (trees.label_high == label))
        if not open_.any():
            continue
        queue = Queue(trees, q[i], low[i], high[i], open_)
        allowed = lambda rows: trees.labels[rows] != label  # noqa: B023, E731
        for positive in batch.column("positives")[i].as_py():
            score = positive["score"]
            least, most = max(-(-share[0] * score // 100), positive["floor"]), share[1] * score // 100
            if least <= most:
                rows, scores = queue.best(k, least, most, allowed)
                yield np.full(len(rows), anchor), np.full(len(rows), positive["id"]), trees.ids[rows], np.full(len(rows), score), scores


FOUND = "anchor_id long, positive_id long, vec_id long, positive_score long, score long"


def _search(packed: DataFrame, anchors: DataFrame, groups: list[int], visit) -> DataFrame:
    """What ``visit`` finds for every anchor in the trees of every one of some groups.

    Leaves are moved once; anchors are copied to each group and follow its leaves in the sorted
    stream of a task, so that a task holds one group and a batch of anchors.
    """

    def run(batches):
        key, held, trees = None, [], None
        for batch in batches:
            names = batch.column("group").to_numpy()
            kinds = batch.column("kind").to_numpy()
            at = np.concatenate([[0], np.flatnonzero((np.diff(names) != 0) | (np.diff(kinds) != 0)) + 1, [len(names)]])
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                part = batch.slice(lo, hi - lo)
                if names[lo] != key:
                    key, held, trees = names[lo], [], None
                if kinds[lo] == 0:
                    held.append(part.select(["node", "dim", "ids", "labels", "v", "low", "high"]))
                    continue
                if held:
                    every = pa.Table.from_batches(held)
                    dims = set(every.column("dim").to_pylist())
                    trees = {d: Trees.of(every.filter(pc.equal(every.column("dim"), d))) for d in dims}
                    held = []
                for dim in np.unique(part.column("dim").to_numpy()).tolist() if trees else []:
                    own = part.filter(pc.equal(part.column("dim"), dim))
                    for first in range(0, own.num_rows, TILE) if dim in trees else []:
                        got = [g for g in visit(trees[dim], own.slice(first, TILE)) if len(g[0])]
                        if got:
                            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*got)], names=["anchor_id", "positive_id", "vec_id", "positive_score", "score"])

    wanted = F.array(*[F.lit(g).cast("long") for g in groups]) if len(groups) <= 64 else F.sequence(F.lit(groups[0]).cast("long"), F.lit(groups[-1]).cast("long"))
    trees = packed.where(F.col("group").between(groups[0], groups[-1])).withColumn("kind", F.lit(0))
    queries = anchors.withColumn("group", F.explode(wanted)).withColumn("kind", F.lit(1))
    both = trees.unionByName(queries, allowMissingColumns=True)
    return both.repartition(len(groups), "group").sortWithinPartitions("group", "kind").mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _in_waves(packed: DataFrame, anchors: DataFrame, n_groups: int, k: int, visit, floors) -> DataFrame:
    """The k best rows over all groups: first in about the square root of them, then, from the k-th scores on, in the rest."""
    first = isqrt(n_groups - 1) + 1
    best = stored(_ranked(_search(packed, anchors, list(range(first)), visit), k))
    if first == n_groups:
        return best
    kth = best.where(F.col("rank") == k).select("anchor_id", "positive_id", F.col("score").alias("floor"))
    more = _search(packed, floors(anchors, kth), list(range(first, n_groups)), visit)
    return stored(_ranked(best.drop("rank").unionByName(more), k))


def hard_negatives(
    embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, share: tuple[int, int] = (30, 90),
    scale: int = 256, noise: int = 7, labels: int = 10, group_rows: int = GROUP,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives, exactly.

    Components become floor(scale * x) and scores are inner products. Labels of vec_ids divisible by
    ``noise`` first become (label + 1) % labels. Anchors are the rows whose vec_id is divisible by
    ``every``; their positives are the best other rows of their label, and the negatives of a positive
    the best rows of other labels with share[0] to share[1] hundredths of its score, which no positive
    with a score below 0 has. Ties go to the smaller vec_id. Only vectors of one length are compared. Rows
    that take no part: see ``usable_rows``; an empty table gives no rows. Scores that may not fit
    a long raise an error. Other columns are not looked at.

    Each anchor meets each group of trees once: the work grows with anchors times rows, less what the
    boxes leave out, and the anchors are copied once per group.
    """
    spark = embeddings.sparkSession
    with scratch(spark) as keep:
        rows = usable_rows(embeddings, scale)
        shifted = F.when(F.col("vec_id") % noise == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
        rows = stored(rows.withColumn("label", shifted))
        norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).first()
        if (facts["top"] or 0) > WIDEST:
            raise ValueError("inner products of these vectors may not fit a long")
        parallel = 2 * spark.sparkContext.defaultParallelism
        size = min(group_rows, max(SLAB, -(-facts["n"] // parallel)))
        n_groups = max(1, -(-facts["n"] // size))
        packed = stored(leaves(rows).withColumn("group", F.pmod(F.xxhash64(F.col("node")), F.lit(n_groups))))

        anchors = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor_id"), "label", "v", F.size("v").alias("dim"))

        def floor(anchors, kth):
            kth = kth.select("anchor_id", F.col("floor").alias("kth"))
            return anchors.join(kth, "anchor_id", "left").withColumn("floor", F.coalesce("kth", "floor")).drop("kth")

        plain = anchors.withColumn("floor", F.lit(LOWEST).cast("long"))
        near = _in_waves(packed, plain, n_groups, positives, lambda t, b: _positives(t, b, positives), floor)

        def windows(near):
            one = F.struct(F.col("vec_id").alias("id"), "score", "floor")
            return anchors.join(near.groupBy("anchor_id").agg(F.collect_list(one).alias("positives")), "anchor_id")

        def floors(_, kth):
            kth = kth.select("anchor_id", F.col("positive_id").alias("vec_id"), F.col("floor").alias("kth"))
            return windows(near.join(kth, ["anchor_id", "vec_id"], "left").withColumn("floor", F.coalesce("kth", F.lit(LOWEST))))

        asked = windows(near.withColumn("floor", F.lit(LOWEST).cast("long")))
        found = _in_waves(packed, asked, n_groups, negatives, lambda t, b: _negatives(t, b, negatives, share), floors)
        return keep(found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
