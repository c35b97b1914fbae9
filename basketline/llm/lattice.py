"""Embedding near-duplicates by E8 lattice hashing with neighbour probes and exact cosines."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.common import components, groups_of, stored, tiled

SEED = 20


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8: whole numbers with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1).astype(np.int64) & 1)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: the better one of D8 and of D8 shifted by a half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(closer[:, None], a, b)


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: differences of a point and its neighbours."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) / 2 for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.stack(out)


@lru_cache(maxsize=8)
def projections(dim: int, tables: int, parts: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Random projections of each table onto ``parts`` times 8 dimensions, and random offsets."""
    rng = np.random.default_rng(SEED)
    p = rng.normal(size=(tables, dim, parts * 8)) * (scale / np.sqrt(8))  # lengths 1 become about ``scale``
    return p, rng.random((tables, parts * 8))


def _codes(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit name of lattice points (n, 8 k)."""
    total = np.full(len(points), X.mix(np.array([salt + 1], X.U))[0])
    for c in np.rint(points * 2).astype(np.int64).T:
        total = X.mix(total * X.U(X.ODD) + c.view(X.U))
    return total


def cells(vectors: np.ndarray, tables: int, parts: int, scale: float, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each unit vector in every table, and the ``probes`` nearest cells around it.

    A cell is the pair (in general the tuple) of lattice points of the projections. Neighbouring cells
    change one or more of the points to one of their nearest neighbours; those with the smallest
    distance from the projection are probed.
    """
    n, dim = vectors.shape
    near = 4  # points looked at in each part: the nearest and its three best neighbours
    own = np.empty((n, tables), X.U)
    others = np.empty((n, tables, probes), X.U)
    matrices, offsets = projections(dim, tables, parts, scale)
    choices = np.array(list(product(range(near), repeat=parts)))[1:]
    for t in range(tables):
        y = vectors @ matrices[t] + offsets[t]
        names, costs = [], []
        for k in range(parts):
            x = y[:, 8 * k : 8 * k + 8]
            point = nearest_point(x)
            rest = x - point
            far = 2.0 - 2.0 * rest @ neighbours().T  # change of the squared distance
            best = np.argpartition(far, near, axis=1)[:, : near - 1]
            order = np.argsort(np.take_along_axis(far, best, 1), axis=1)
            best = np.take_along_axis(best, order, 1)
            names.append([_codes(point, k), *[_codes(point + neighbours()[best[:, i]], k) for i in range(near - 1)]])
            costs.append(np.hstack([np.zeros((n, 1)), np.take_along_axis(far, best, 1)]))

        def named(choice: np.ndarray) -> np.ndarray:
            total = np.full(n, X.U(t + 1))
            for k in range(parts):
                total = X.mix(total * X.U(X.ODD) + np.stack(names[k])[choice[:, k], np.arange(n)])
            return total

        own[:, t] = named(np.zeros((n, parts), np.int64))
        cost = sum(costs[k][:, choices[:, k]] for k in range(parts))
        ranked = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        for i in range(probes):
            others[:, t, i] = named(choices[ranked[:, i]])
    return own, others


def usable_vectors(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All (vec_id, v), and those whose v can be compared; doubles, one row per vec_id."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    rows = embeddings.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v")))
    finite = F.forall("v", lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    return rows, rows.where("size(v) > 0").where(finite & F.exists("v", lambda c: c != 0.0))


def near_vectors(
    embeddings: DataFrame,
    cosine: float = 0.95,
    tables: int = 12,
    parts: int = 2,
    scale: float = 1.8,
    probes: int = 6,
    block: int = 512,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Equal vectors are one node with a weight. Every node lies in one cell per table and visits the
    nearest cells; the residents of a cell are compared with each other and with its visitors by
    exact cosines, inside tasks that hold at most two blocks of a cell. A pair counts in the first
    table and cell where it meets, so links are counted once and never made as rows: tasks
    return sums per vector and the edges of a spanning forest. Vectors of different length do not
    link. Null, empty, zero and non-finite vectors link with nothing. Rows of one vec_id are one vector
    (the smallest in array order, nulls last); rows with a null vec_id are left out.
    """
    rows, usable = usable_vectors(embeddings)
    nodes = stored(usable.groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")))

    def hashed(batches):
        for batch in batches:
            lists = batch.column("v").to_pylist()
            by: dict[int, list[int]] = {}
            for i, v in enumerate(lists):
                by.setdefault(len(v), []).append(i)
            for dim, at in by.items():
                m = np.array([lists[i] for i in at])
                m = m / np.abs(m).max(1, keepdims=True)
                m /= np.sqrt((m * m).sum(1, keepdims=True))
                own, others = cells(m, tables, parts, scale, probes)
                own, others = (X.mix(c ^ X.mix(np.array([dim], X.U))[0]) for c in (own, others))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(at)),
                        pa.array([x.tobytes() for x in m], pa.binary()),
                        batch.column("weight").take(pa.array(at)),
                        X.long_list(list(own)),
                        X.long_list(list(others.reshape(len(at), -1))),
                    ],
                    names=["id", "unit", "weight", "cells", "probes"],
                )

    nodes_of = stored(nodes.mapInArrow(hashed, "id long, unit binary, weight long, cells array<long>, probes array<long>"))
    visits = nodes_of.select("id", F.explode("cells").alias("key"), F.lit(True).alias("resident")).union(
        nodes_of.select("id", F.explode(F.array_distinct(F.array_except("probes", "cells"))).alias("key"), F.lit(False))
    )
    open_cells = visits.groupBy("key").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("resident").alias("lived_in")
    )
    visits = visits.join(open_cells.where("lived_in and lo < hi").select("key"), "key")

    def compared(found: pa.Table) -> pa.Table:
        ids, weight = found.column("id").to_numpy(), found.column("weight").to_numpy()
        resident = found.column("resident").to_numpy()
        unit = found.column("unit").to_pylist()
        own, others = (np.array(found.column(c).to_pylist(), np.int64) for c in ("cells", "probes"))
        others = others.reshape(len(ids), own.shape[1], -1)
        key = found.column("key").to_numpy()
        sums: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for left, right in groups_of(found):
            x = np.stack([np.frombuffer(unit[i]) for i in left.tolist()])
            y = x if left is right else np.stack([np.frombuffer(unit[i]) for i in right.tolist()])
            link = (x @ y.T >= cosine) & (resident[left][:, None] | resident[right][None])
            i, j = np.nonzero(np.triu(link, 1) if left is right else link)
            if not len(i):
                continue
            a, b = left[i], right[j]
            a, b = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
            here = key[left[0]]
            # Where a pair meets, table by table: in a common cell, in the cell of a, in the cell of b.
            of_a = (own[a][:, :, None] == others[b]).any(2)
            of_b = (own[b][:, :, None] == others[a]).any(2)
            meets = (own[a] == own[b]) | of_a | of_b
            first = meets.argmax(1)
            r = np.arange(len(a))
            cell = np.where(of_a[r, first] | (own[a] == own[b])[r, first], own[a][r, first], own[b][r, first])
            once = cell == here
            a, b = a[once], b[once]
            for p, q in ((a, b), (b, a)):
                for vec, n in zip(ids[p].tolist(), weight[q].tolist()):
                    sums[vec] = sums.get(vec, 0) + n
            edges += _forest(ids[a].tolist(), ids[b].tolist())
        return pa.table(
            {
                "a": pa.array([*sums, *[a for a, _ in edges]], pa.int64()),
                "b": pa.array([*[None] * len(sums), *[b for _, b in edges]], pa.int64()),
                "n": pa.array([*sums.values(), *[0] * len(edges)], pa.int64()),
            }
        )

    found = stored(tiled(visits, nodes_of, block).groupBy("bucket").applyInArrow(compared, "a long, b long, n long"))
    degree = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    classes = components(found.where("b is not null").select("a", "b"))
    nodes = nodes.join(degree, "id", "left").join(classes, "id", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    linked = usable.join(nodes, "v").select("vec_id", "n_links", "component")
    out = rows.select("vec_id").join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _forest(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Edges that connect what all the given edges connect."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    out = []
    for p, q in zip(a, b):
        x, y = find(p), find(q)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((p, q))
    return out
