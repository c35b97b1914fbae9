"""Exact Jaccard join of documents on word shingles: size bands, tiles, bitmaps, intersection."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.common import (
    KEY_ROWS, bitmap, bits_in_common, document_rows, key_rows, led_by_heads, linked, most_in_common, scratch, screened, sets_link, stored,
)


@lru_cache(maxsize=16)
def bands(num: int, den: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower size bound of every band up to sizes of ``most``, and the buckets of its tiles.

    Two sizes that can reach the similarity lie in one band or in neighbouring ones. In band i the
    sets differ in at most (den - num) / (den + num) of both sizes; with one bucket more than that,
    they agree in one bucket at least.
    """
    low = [1]
    while low[-1] <= most:
        low.append(max(low[-1] + 1, den * (low[-1] - 1) // num + 1))
    low.append(max(low[-1] + 1, den * (low[-1] - 1) // num + 1))
    low.append(max(low[-1] + 1, den * (low[-1] - 1) // num + 1))
    top = np.array(low[1:]) - 1
    return np.array(low), 2 * top * (den - num) // (den + num) + 1


LEVELS = 4  # ways of dealing shingles out to buckets, each for sets that had too few buckets with shingles before


def tile_keys(codes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the tiles of one set: its own size band and the next, times their buckets.

    A bucket is a range of hash values; its key stands for all the shingles that fall in it. Buckets without shingles,
    in which very many sets agree, have no key: a set with more others than the similarity lets differ agrees with
    each similar one in one of those. A set with fewer is dealt out anew by other hash values, where it meets the
    others with fewer, and in the last of LEVELS its empty buckets have keys too.
    """
    n = len(codes)
    low, buckets = bands(num, den, 1 << max(10, n.bit_length()))
    band = int(np.searchsorted(low, n, "right")) - 1
    dealt = []
    out = []
    for i in (band, band + 1):
        m = int(buckets[i])
        edges = (np.arange(m + 1, dtype=X.U) * X.U((1 << 64) // m)) if m > 1 else np.zeros(2, X.U)
        differ = (n + min(int(low[i + 1]) - 1, n * den // num)) * (den - num) // (den + num)
        for level in range(LEVELS):
            if level == len(dealt):
                values = np.sort(X.mix(codes ^ X.U(level))) if level else codes
                dealt.append((values, np.concatenate([np.zeros(1, X.U), np.cumsum(X.mix(values ^ X.U(0x5DEECE66D)))])))
            values, sums = dealt[level]
            at = np.searchsorted(values, edges)
            at[0], at[-1] = 0, n
            keys = X.mix((sums[at[1:]] - sums[at[:-1]]) ^ X.mix((np.arange(m, dtype=X.U) << X.U(24)) + X.U((level << 20) + i + 1)))
            filled = at[1:] > at[:-1]
            enough = int(np.count_nonzero(filled)) > differ
            out.append(keys if level == LEVELS - 1 and not enough else keys[filled])
            if enough:
                break
    return np.concatenate(out)


def _rows(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    codes, offsets = X.words(texts)
    return X.sets(*X.shingles(codes, offsets, shingle))


def profiles(documents: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """doc_id, size and 128-bit name of the shingle set, its bitmap, and the tile keys."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "text"):
                found = list(_rows(batch.column("text"), shingle))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array(np.array([X.mix(s).sum(dtype=X.U) for s in found], X.U).view(np.int64)),
                        pa.array(np.array([X.mix(s ^ X.U(X.ODD)).sum(dtype=X.U) for s in found], X.U).view(np.int64)),
                        pa.array(map(bitmap, found), pa.binary()),
                        X.long_list([tile_keys(s, num, den) if len(s) else s for s in found]),
                    ],
                    names=["doc_id", "n_shingles", "name_a", "name_b", "bits", "keys"],
                )

    kind = "doc_id long, n_shingles long, name_a long, name_b long, bits binary, keys array<long>"
    return document_rows(documents).mapInArrow(run, kind)


def shingle_sets(documents: DataFrame, shingle: int) -> DataFrame:
    """id, size and the sorted set itself."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "text"):
                found = list(_rows(batch.column("text"), shingle))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in found], pa.int64()), X.long_list(found)],
                    names=["id", "n", "codes"],
                )

    return documents.mapInArrow(run, "id long, n long, codes array<long>")


def signatures_allow(pairs: DataFrame, signatures: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that their sizes and bitmaps (id, n, bits) do not keep from linking."""

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            keep = np.zeros(batch.num_rows, bool)
            sizes_fit = np.minimum(n_a, n_b) * den >= np.maximum(n_a, n_b) * num
            for i in np.flatnonzero(sizes_fit).tolist():
                keep[i] = bits_in_common(batch.column("bits_a")[i].as_buffer(), batch.column("bits_b")[i].as_buffer(), int(n_a[i]), int(n_b[i])) * (num + den) >= (n_a[i] + n_b[i]) * num
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in "ab"], names=["a", "b"])

    def side(s: str) -> DataFrame:
        return signatures.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long").distinct()


def keyed(rows: DataFrame) -> DataFrame:
    """``key_rows`` of the stored profiles; of equal sets in a batch only the first has keys."""

    def run(batches):
        for batch in batches:
            name = np.stack([batch.column(c).to_numpy() for c in ("name_a", "name_b", "n_shingles")], 1)
            ids = batch.column("doc_id").to_numpy()
            order = np.lexsort((ids, name[:, 2], name[:, 1], name[:, 0]))
            new = np.ones(len(ids), bool)
            new[1:] = (name[order[1:]] != name[order[:-1]]).any(1)
            some = batch.take(pa.array(np.sort(order[new])))
            column = some.column("keys")
            at = column.offsets.to_numpy().astype(np.int64)
            yield key_rows(some.column("doc_id").to_numpy(), column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), at - at[0])

    return rows.mapInArrow(run, KEY_ROWS)


def jaccard_classes(documents: DataFrame, shingle: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and whether it is the one kept.

    Documents link when the Jaccard similarity of their word-shingle sets is at least num / den.
    Equal sets are one node; the others meet in size-banded tiles, are bounded from above by
    bit counts of hashed signatures and decided by an exact intersection. Null and empty texts have
    size 0, link with nothing and are kept. Rows that share a doc_id are one document; rows
    without doc_id link with nothing and have a null component. Other columns are not looked at.
    """
    texts = document_rows(documents)
    name = ["n_shingles", "name_a", "name_b"]
    with scratch(documents.sparkSession) as keep:
        rows = stored(profiles(documents, shingle, num, den))
        some = rows.where("n_shingles > 0 and doc_id is not null")
        nodes = stored(some.groupBy(*name).agg(F.min("doc_id").alias("id")))
        # Rows whose set another row has too stand for that row, their node.
        copies = some.select("doc_id", *name).join(nodes, name).where("doc_id <> id").select("doc_id", F.col("id").alias("node"))
        copies = stored(copies.distinct().join(nodes.select(F.col("id").alias("doc_id")), "doc_id", "left_anti"))

        def of_nodes(members: DataFrame, column: str) -> DataFrame:
            node = copies.select(F.col("doc_id").alias(column), "node")
            return members.join(node, column, "left").withColumn(column, F.coalesce("node", column)).drop("node")

        members = of_nodes(of_nodes(led_by_heads(keyed(some)), "id"), "leader").distinct()
        signatures = some.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bits")

        def verify(pairs: DataFrame) -> DataFrame:
            """The bound by bitmaps first; the sets are made and moved only for pairs that it leaves."""
            with scratch(documents.sparkSession) as keep:
                close = stored(signatures_allow(pairs, signatures, num, den))
                ids = stored(close.select(F.explode(F.array("a", "b")).alias("id")).distinct())
                own = stored(shingle_sets(screened(texts, ids, "doc_id"), shingle))
                return keep(sets_link(close, own, num, den))

        def may_link(found: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            n = found.column("n").to_numpy()
            return most_in_common(found, left, right) * (num + den) >= (n[left][:, None] + n[right][None]) * num

        found = linked(members, verify, lambda: signatures, may_link)
        groups = nodes.join(found, "id", "left").select(*name, F.coalesce("component", "id").alias("component_id"))
        # A doc_id with several rows: all of them get the smallest class that one of them is in.
        out = rows.join(groups, name, "left").select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        return keep(out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))
