"""Shared parts: tables, stored intermediate results, bucket leaders and distributed components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketline.session import hadoop_path, pin_runtime, shared_folder

_scopes: list[list[str]] = []  # folders of the open scopes, the innermost last


BATCH_ROWS = 2000  # rows of an Arrow batch: whole texts and vectors take more memory than the usual 10000 allow for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_runtime(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: later reads survive lost executors."""
    folder = shared_folder(frame.sparkSession)
    if _scopes:
        _scopes[-1].append(folder)
    frame.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    out = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    out._folder = folder
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    path, fs = hadoop_path(spark, folder)
    fs.delete(path, True)


def dropped(frame: DataFrame) -> None:
    """Delete the table that ``stored`` has written, once nothing reads it any more."""
    _delete(frame.sparkSession, frame._folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A scope whose stored tables are deleted at its end, but for what is stored through ``keep``.

    What ``keep`` has stored belongs to the scope around this one, if there is one.
    """
    outer = _scopes[-1] if _scopes else []
    own: list[str] = []
    _scopes.append(own)

    def keep(frame: DataFrame) -> DataFrame:
        out = stored(frame)
        own.remove(out._folder)
        outer.append(out._folder)
        return out

    try:
        yield keep
    finally:
        _scopes.pop()
        for folder in own:
            _delete(spark, folder)


def fresh(columns: list[str], name: str) -> str:
    """The name, with underscores behind it until no given column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def document_rows(documents: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever other columns the table has; a null text is empty."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def identified(documents: DataFrame, name: str = "row_id") -> tuple[DataFrame, str, bool]:
    """The documents with a long that no two rows share, its column, and whether it is doc_id in every row.

    It is doc_id for the only or the first row that has it, by a hash of the text, then in storage order. Further
    rows of a doc_id and rows without one have numbers behind all doc_ids. So each row is a document of its own.
    """
    name = fresh(documents.columns, name)
    own = F.col("doc_id").cast("long")
    counted = documents.select(own.alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_top"))
    facts = counted.agg(F.max("_top").alias("top"), F.count_if((F.col("_n") > 1) | F.col("_id").isNull()).alias("odd")).first()
    if not facts["odd"]:
        return documents.withColumn(name, own), name, True
    rows, mark, seen = (fresh([*documents.columns, name], c) for c in ("row_no", "text_hash", "seen_id"))
    kept = documents.withColumn(rows, F.monotonically_increasing_id())
    kept = stored(kept.withColumn(mark, F.xxhash64(F.col("text").cast("string"))))
    first = kept.where(own.isNotNull()).groupBy(own.alias(seen)).agg(F.min(F.struct(mark, rows)).alias("_first"))
    first = first.select(seen, F.col(f"_first.{rows}").alias("_row"))
    joined = kept.join(first, (own == F.col(seen)) & (F.col(rows) == F.col("_row")), "left")
    behind = F.lit((facts["top"] or 0) + 1).cast("long") + F.col(rows)
    out = joined.withColumn(name, F.when(F.col("_row").isNotNull(), own).otherwise(behind))
    return stored(out.select(*documents.columns, name)), name, False


def marked(rows: DataFrame, ids: DataFrame, column: str, mark: str, bits: int = 1 << 26) -> DataFrame:
    """The rows with ``mark``: false only where ``column`` is certainly not in ``ids`` (one column); nothing is moved.

    A table of bitmaps over hashes of the ids, of ``bits`` bits whatever their number, is broadcast.
    """
    at, part, own = (fresh([*rows.columns, mark], c) for c in ("_at", "_part", "_bits"))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    set_bits = ids.select(place(F.col(ids.columns[0]).cast("long")).alias(at)).select(F.shiftright(at, 15).alias(part), (F.col(at) % 32768).alias("_bit"))
    table = set_bits.groupBy(part).agg(F.bitmap_construct_agg("_bit").alias(own))
    byte = F.substring(own, (F.floor(F.col(at) % 32768 / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (F.col(at) % 8).cast("int")) == 1
    some = rows.withColumn(at, place(F.col(f"`{column}`").cast("long"))).withColumn(part, F.shiftright(at, 15))
    some = some.join(F.broadcast(table), part, "left").withColumn(mark, F.coalesce(is_set, F.lit(False)))
    return some.select(*[F.col(f"`{c}`") for c in rows.columns], mark)


def screened(rows: DataFrame, ids: DataFrame, column: str, bits: int = 1 << 26) -> DataFrame:
    """The rows whose ``column`` is in ``ids`` (one column), without moving most of the others.

    Bitmaps turn away most other rows where they are; a join decides on the rest. It is an inner join, as Spark
    would move a semi join before the bitmaps, and then all rows.
    """
    may = fresh(rows.columns, "may")
    some = marked(rows, ids, column, may, bits).where(may).drop(may)
    return some.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column).select(*rows.columns)


def with_facts(rows: DataFrame, facts: DataFrame, column: str) -> DataFrame:
    """The rows with the columns of ``facts``, whose first one names rows by ``column``, or nulls.

    Names of facts and rows differ. Rows without facts, which bitmaps tell, stay where they are.
    """
    may = fresh([*rows.columns, *facts.columns], "may")
    some = marked(rows, facts.select(facts.columns[0]), column, may)
    key = facts.columns[0]
    moved = some.where(may).drop(may).join(facts, F.col(f"`{column}`") == F.col(key), "left")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields]
    return moved.union(some.where(~F.col(may)).select(*[F.col(f"`{c}`") for c in rows.columns], *nulls))


def key_rows(ids: np.ndarray, keys: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """(key, id, head, n) for the keys of some rows: keys[at[i] : at[i + 1]] are those of ids[i].

    The smallest id of each key is its head here, and has the number of ids; the others name their head. So a key
    that many rows have is one row without head for each batch.
    """
    owner = np.repeat(ids, np.diff(at))
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    again = np.zeros(len(keys), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    keys, owner = keys[~again], owner[~again]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(keys)))
    group = np.cumsum(first) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys.view(np.int64)), pa.array(owner), pa.array(owner[begin][group], pa.int64(), mask=first),
            pa.array(np.where(first, size[group], 1).astype(np.int32)),
        ],
        names=["key", "id", "head", "n"],
    )


KEY_ROWS = "key long, id long, head long, n int"


def led_by_heads(keys: DataFrame) -> DataFrame:
    """(key, id, leader) of every key of ``key_rows`` that two or more ids have, after one exchange.

    Heads are led by the smallest of their key, the others by their head; only heads of a key come together.
    """
    over = Window.partitionBy("key", "head")
    is_head = F.col("head").isNull()
    found = keys.withColumns({"first": F.min("id").over(over), "last": F.max("id").over(over)})
    found = found.where(~is_head | (F.col("first") < F.col("last")) | (F.col("n") > 1))
    # The same id may come from several batches.
    return found.select("key", "id", F.when(is_head, F.col("first")).otherwise(F.col("head")).alias("leader")).distinct()


def led(keys: DataFrame) -> DataFrame:
    """(key, id, leader) of every key that two or more ids have; the leader is the smallest id.

    The leaders are a combined minimum, so a key with a third of all rows costs one row per map
    task; the join back is one that adaptive execution splits.
    """
    shared = keys.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
    return keys.join(shared.where("leader < last").drop("last"), "key")


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of one part as (node, smallest node that the part connects it with)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(up, up)
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            x, y = find(u), find(v)
            if x != y:
                root[max(x, y)] = min(x, y)
    out = [(x, find(x)) for x in root]
    out = [x for x in out if x[0] != x[1]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), ()))], names=["u", "v"])


def components(edges: DataFrame, part: int = 100_000) -> DataFrame:
    """(id, component) of every node with an edge; edges are (a, b), the component the smallest id.

    Distributed union-find: parts of at most about ``part`` edges are contracted to stars by a task each.
    While there are several parts, large-star and small-star steps connect neighbours with the
    smallest node across parts, until every node hangs on a root. Each round is a stored table that takes the
    place of the one before, and so is the result; only counts reach the driver.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))

    def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
        new = stored(new)
        dropped(old)
        return new

    with scratch(edges.sparkSession) as keep:
        pairs = stored(pairs.distinct())
        while True:
            parts = -(-pairs.count() // part)
            if parts:
                pairs = replaced(pairs, pairs.repartition(parts).mapInArrow(_local_roots, "u long, v long"))
            roots = pairs.select("v").distinct()
            if parts <= 1 or pairs.join(roots.withColumnRenamed("v", "u"), "u", "left_semi").isEmpty():
                # One part, or all edges lead to roots and each node has one.
                if parts <= 1 or pairs.groupBy("u").count().where("count > 1").isEmpty():
                    own = roots.select(F.col("v").alias("id"), F.col("v").alias("component"))
                    return keep(pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(own))
            both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            up = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            pairs = replaced(pairs, up.distinct())
            least = pairs.groupBy("u").agg(F.min("v").alias("m"))
            small = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            pairs = replaced(pairs, small.union(least.select("u", F.col("m").alias("v"))).distinct())


def tiled(rows: DataFrame, payload: DataFrame, block: int = 2048, gathered: int = 2048) -> DataFrame:
    """Rows (key, id, ...) dealt out so that any two rows of a key meet in some (key, lo, hi).

    A key with more than ``block`` rows is cut into blocks by a hash of its ids, and each block meets
    each: no task holds more than two blocks of one key. Small keys are gathered in groups of
    about ``gathered`` rows, named by ``bucket``. ``own`` is the block of a row. The columns of
    ``payload`` join by id at the end, so they are moved once.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    out = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    out = out.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("blocks", "other")
    out = stored(out)
    buckets = max(1, out.count() // gathered)
    return out.withColumn("bucket", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(buckets))).join(payload, "id")


SMALL = 16  # rows of a group whose pairs are listed together with those of other groups


def _ordered(found: pa.Table, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Some rows of a bucket by (key, lo, hi) and block, and where a group begins, but for the first."""
    rows = np.arange(found.num_rows) if rows is None else rows
    key, lo, hi, own = (found.column(c).to_numpy()[rows] for c in ("key", "lo", "hi", "own"))
    order = np.lexsort((own, hi, lo, key))
    new = (np.diff(key[order]) != 0) | (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)
    return rows[order], np.flatnonzero(new) + 1


def small_pairs(found: pa.Table, component: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every pair of rows of different components in groups of one block and up to SMALL rows, once; and the rows of all other groups."""
    order, at = _ordered(found)
    begin, size = np.append(0, at), np.diff(np.concatenate([[0], at, [len(order)]]))
    lo, hi = found.column("lo").to_numpy(), found.column("hi").to_numpy()
    small = (size <= SMALL) & (lo[order[begin]] == hi[order[begin]])
    x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(size[small]).tolist():
        rows = order[begin[small & (size == n)][:, None] + np.arange(n)]
        for i in range(n):
            for j in range(i + 1, n):
                differ = component[rows[:, i]] != component[rows[:, j]]
                x.append(rows[differ, i])
                y.append(rows[differ, j])
    x, y = np.concatenate(x), np.concatenate(y)
    _, node = np.unique(found.column("id").to_numpy(), return_inverse=True)  # an id has several rows
    u, v = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
    _, first = np.unique(u.astype(np.int64) * found.num_rows + v, return_index=True)
    return x[first], y[first], order[np.repeat(~small, size)]


def groups_of(found: pa.Table, rows: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the two sides of every (key, lo, hi) in a bucket, or in some rows of it; the same side twice for one block."""
    lo, hi, own = (found.column(c).to_numpy() for c in ("lo", "hi", "own"))
    order, at = _ordered(found, rows)
    if not len(order):
        return
    for group in np.split(order, at):
        if lo[group[0]] == hi[group[0]]:
            yield group, group
        else:
            left = own[group] == lo[group[0]]
            if left.any() and not left.all():
                yield group[left], group[~left]


def linked(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    payload: Callable[[], DataFrame],
    may_link: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray],
    exact: Callable[[pa.Table, np.ndarray], tuple[Callable[[int, int], bool], Callable[[np.ndarray, np.ndarray], np.ndarray]]] | None = None,
    rounds: int = 2,
) -> DataFrame:
    """Components over all links that share a key: (id, component) of every id with a link; stored.

    ``members`` is (key, id, leader); ``verify`` turns candidate pairs (a, b) into those that
    link. First every id is held against the leader of each of its keys, then what is not
    in the leader's component against the next leader: linear work that settles groups of near
    copies. Keys that still hold several components are then searched whole, in tiles of bounded size
    inside tasks: ``may_link`` bounds the pairs of two sides of a tile from the columns that
    ``payload`` gives per id, and only pairs of different components that it leaves are looked at. With ``exact``
    they are verified in the tile too: ``exact`` gives a function of one pair of some rows and one of many pairs. All pairs
    of small groups are verified at once, those of others unless a link found in the tile already connects them. Without
    it they are verified as rows. So no link between components is lost.
    """
    with scratch(members.sparkSession) as keep:
        members = stored(members)
        rest, edges, seen = members, [], []
        for _ in range(rounds):
            pairs = rest.where("id <> leader").select(F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b")).distinct()
            for before in seen:
                pairs = pairs.join(before, ["a", "b"], "left_anti")
            seen.append(stored(pairs))
            edges.append(stored(verify(seen[-1])))
            known = components(_union(edges))
            tag = known.select(F.col("id").alias("leader"), F.col("component").alias("leads"))
            left = rest.join(known, "id", "left").join(tag, "leader", "left")
            left = left.where(F.coalesce("component", "id") != F.coalesce("leads", "leader")).select("key", "id")
            left = stored(led(left))
            if rest is not members:
                dropped(rest)
            rest = left
        tagged = members.join(known, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        several = tagged.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        rest = stored(tagged.join(several.where("lo < hi").select("key"), "key"))
        dropped(members)
        if rest.isEmpty():
            return keep(known)

        def bounded(found: pa.Table) -> pa.Table:
            ids, component = found.column("id").to_numpy(), found.column("component").to_numpy()
            label = component.copy()  # components that links of this bucket have put together have one label
            a, b, holds, large = [], [], None, None
            if exact:
                x, y, large = small_pairs(found, component)
                holds, all_hold = exact(found, large)
                links = all_hold(x, y)
                a += np.minimum(ids[x], ids[y])[links].tolist()
                b += np.maximum(ids[x], ids[y])[links].tolist()
            for left, right in groups_of(found, large):
                ok = may_link(found, left, right)
                if left is right:
                    ok = np.triu(ok, 1)
                for x in np.flatnonzero(ok.any(1)).tolist():
                    one = int(left[x])
                    for other in right[np.flatnonzero(ok[x] & (label[right] != label[one]))].tolist():
                        if label[other] == label[one]:
                            continue
                        if holds:
                            if not holds(one, other):
                                continue
                            label[label == label[other]] = label[one]
                        a.append(min(ids[one], ids[other]))
                        b.append(max(ids[one], ids[other]))
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}).group_by(["a", "b"]).aggregate([])

        cross = tiled(rest, payload()).groupBy("bucket").applyInArrow(bounded, "a long, b long").distinct()
        if not exact:
            for before in seen:
                cross = cross.join(before, ["a", "b"], "left_anti")
            cross = verify(stored(cross))
        return keep(components(_union([*edges, cross])))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def bitmap(codes: np.ndarray) -> bytes:
    """A bit for each code, in a signature of a power of two of bits, four per code or more."""
    size = max(64, 1 << (4 * len(codes) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(codes & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_in_common(found: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of any two sets, from bit counts of their ``bits`` and sizes ``n``.

    A bit that only one signature has stands for at least one code that only this set has. Longer
    signatures are folded to the shortest.
    """
    raw, n = found.column("bits"), found.column("n").to_numpy()
    size = min(len(raw[int(i)].as_py()) for i in {*left.tolist(), *right.tolist()}) // 8

    def folded(at: np.ndarray) -> np.ndarray:
        return np.stack([np.bitwise_or.reduce(np.frombuffer(raw[i].as_py(), np.uint64).reshape(-1, size), 0) for i in at.tolist()])

    x = folded(left)
    y = x if left is right else folded(right)
    own_x, own_y = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    both = np.empty((len(x), len(y)), np.int64)
    step = max(1, (1 << 19) // (len(y) * size))
    for i in range(0, len(x), step):
        both[i : i + step] = np.bitwise_count(x[i : i + step, None] & y[None]).sum(2, dtype=np.int64)
    return np.minimum(n[left][:, None] - own_x[:, None] + both, n[right][None] - own_y[None] + both)


def bits_in_common(x: pa.Buffer, y: pa.Buffer, n_x: int, n_y: int) -> int:
    """``most_in_common`` of two sets."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(v.reshape(-1, size), 0) if len(v) > size else v for v in (x, y))
    own_x, own_y, both = (int(np.bitwise_count(v).sum()) for v in (x, y, x & y))
    return min(n_x - own_x + both, n_y - own_y + both)


def intersection(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct codes."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int(np.count_nonzero(y[at] == x)) if len(x) else 0


def overlaps(x: np.ndarray, x_at: np.ndarray, y: np.ndarray, y_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets of mixed codes of row i on both sides, and of their intersection; codes may repeat.

    Rows are taken 4096 at a time, so that a row's number and 52 bits of a code make one number to sort.
    """
    out = []
    for lo in range(0, len(x_at) - 1, 4096):
        parts = []
        for codes, at in ((x, x_at[lo : lo + 4097]), (y, y_at[lo : lo + 4097])):
            row = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
            key = np.sort((row << np.uint64(52)) | (codes[at[0] : at[-1]] >> np.uint64(12)))
            parts.append(key[np.append(True, key[1:] != key[:-1])] if len(key) else key)
        both = np.sort(np.concatenate(parts))
        parts.append(both[1:][both[1:] == both[:-1]])
        out.append([np.bincount((p >> np.uint64(52)).astype(np.int64), minlength=len(at) - 1) for p in parts])
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def sets_link(pairs: DataFrame, own: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets (id, n, bits, codes) have a Jaccard similarity of num / den or more."""

    def run(batches):
        for batch in batches:
            n = [batch.column(c).to_pylist() for c in ("n_a", "n_b")]
            keep = []
            for i, (x, y) in enumerate(zip(*n)):
                least = -(-(x + y) * num // (num + den))
                a, b = (batch.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in ("codes_a", "codes_b"))
                keep.append(min(x, y) >= least and intersection(a, b) >= least)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    def side(s: str) -> DataFrame:
        return own.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("codes").alias(f"codes_{s}"))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long").distinct()
