"""Token ids as length-delimited binary records, with an offset index for reads in any order.

A record file is a run of frames: the length of the payload as eight bytes, a masked CRC-32C of
those bytes, the payload, a masked CRC-32C of the payload; all numbers are little-endian. A payload
is the id of the document, the width of a token in bytes, whether the document has an id, how many
tokens follow, and the tokens. The index is a Parquet table with a row per record; files that no
index row names do not belong to the table, so a task that is repeated or lost leaves nothing behind.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.bpe import codec
from basketline.llm.common import document_rows, stored
from basketline.session import shared_folder

HEAD = 12  # bytes of a frame before its payload: length and its checksum
FOOT = 4  # checksum behind the payload
OWN = "<qHHI"  # doc_id, bytes of a token, 1 with a doc_id, tokens
OWN_SIZE = struct.calcsize(OWN)
POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected (fixed value)
MASK = 0xA282EAD8  # added to rotated checksums, so that a checksum of checksums is not degenerate (fixed value)
LANE = 256  # bytes whose checksums are taken side by side
RUN = 8 << 20  # bytes that are read at once

INDEX = "shard int, file string, record long, position long, length long, doc_id long, before long, n_tokens long"


# --- Checksums -----------------------------------------------------------------------


@lru_cache(maxsize=1)
def _bytes_table() -> np.ndarray:
    """Tables that carry a checksum over one to four bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1)
    tables = [one]
    for _ in range(3):
        tables.append(one[tables[-1] & 0xFF] ^ (tables[-1] >> 8))
    return np.stack(tables)


def _moved(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][(crc >> 8) & 0xFF] ^ table[2][(crc >> 16) & 0xFF] ^ table[3][crc >> 24]


@lru_cache(maxsize=64)
def _zeros_table(level: int) -> np.ndarray:
    """Tables that carry a checksum over LANE * 2**level zero bytes, by each byte of the checksum."""
    if level:
        below = _zeros_table(level - 1)
        return _moved(below, below)
    one = _bytes_table()[0]
    crc = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(LANE):
        crc = one[crc & 0xFF] ^ (crc >> 8)
    return crc


def crc32c(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32C of every run raw[offsets[i] : offsets[i + 1]]; runs have four bytes at least.

    Checksums are linear: each run is filled with zeros in front to whole lanes, the lanes' checksums are
    taken side by side, and neighbours are put together until each run has one.
    """
    n = np.diff(offsets)
    if not len(n):
        return np.zeros(0, np.uint32)
    lanes = -(-n // LANE)
    first = np.concatenate([[0], np.cumsum(lanes)])
    padded = np.zeros(int(first[-1]) * LANE, np.uint8)
    begin = first[1:] * LANE - n
    padded[np.repeat(begin - offsets[:-1], n) + np.arange(offsets[0], offsets[-1])] = raw[offsets[0] : offsets[-1]]
    padded[(begin[:, None] + np.arange(4)).ravel()] ^= 0xFF  # the state that a checksum begins with
    table = _bytes_table()
    crc = np.zeros(int(first[-1]), np.uint32)
    for word in np.ascontiguousarray(padded.view("<u4").reshape(-1, LANE // 4).T):
        crc ^= word
        crc = table[3][crc & 0xFF] ^ table[2][(crc >> 8) & 0xFF] ^ table[1][(crc >> 16) & 0xFF] ^ table[0][crc >> 24]
    level = 0
    while lanes.max() > 1:
        # The last lane of a run pairs with the one before it; a first lane without partner stays.
        half = (lanes + 1) // 2
        to = np.concatenate([[0], np.cumsum(half)])
        right = np.repeat(first[1:] - 1 - 2 * (to[1:] - 1), half) + 2 * np.arange(to[-1])
        left = np.where(right > np.repeat(first[:-1], half), crc[right - 1], 0).astype(np.uint32)
        crc = _moved(_zeros_table(level), left) ^ crc[right]
        lanes, first, level = half, to, level + 1
    return ~crc


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK)


# --- Writing -------------------------------------------------------------------------


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: local and mounted paths, and every URI that Arrow knows (HDFS, object stores)."""
    return pafs.FileSystem.from_uri(folder)


def _framed(payloads: list[bytes]) -> bytes:
    """The payloads as frames, one after the other."""
    n = np.array([len(p) for p in payloads], np.uint64)
    heads = n.astype("<u8").view(np.uint8)
    head_crc = masked(crc32c(heads, np.arange(0, 8 * len(n) + 1, 8))).astype("<u4")
    offsets = np.concatenate([[0], np.cumsum(n.astype(np.int64))])
    foot_crc = masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), offsets)).astype("<u4")
    out = []
    for i, payload in enumerate(payloads):
        out += [heads[8 * i : 8 * i + 8].tobytes(), head_crc[i].tobytes(), payload, foot_crc[i].tobytes()]
    return b"".join(out)


def write_records(documents: DataFrame, tokenizer: str, folder: str, end: int | None = 2) -> DataFrame:
    """Write the ids of every document to record files below ``folder``; returns the index, stored.

    Documents are dealt over the files in ascending order of doc_id, rows without one first, rows of
    one doc_id by a hash of their texts; equal rows stand side by side. Each is closed by the id
    ``end``. Tokens take two bytes where the vocabulary allows it. A null or empty text has the closing id
    alone. ``folder`` is a path or URI that the driver and all executors reach. A doc_id with very many rows
    is dealt over several files. Other columns are not looked at.
    """
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    ids = [*spec["model"]["vocab"].values(), *[t["id"] for t in spec["added_tokens"]], end or 0]
    width = 2 if max(ids) < 1 << 16 else 4
    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)

    def run(batches):
        fs, root = _file_system(folder)
        words = codec(tokenizer)
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:06d}-{uuid.uuid4().hex}.records"
        out, record, position, before = None, 0, 0, 0
        try:
            for big in batches:
                for batch in X.slices(big, "text"):
                    out = out or fs.open_output_stream(f"{root}/{name}")
                    payloads, n = [], []
                    doc_ids = batch.column("doc_id").to_pylist()
                    for doc_id, slots in zip(doc_ids, words.slots(batch.column("text").to_pylist())):
                        flat = words.expand(slots)
                        flat = flat if end is None else np.append(flat, end)
                        n.append(len(flat))
                        payloads.append(struct.pack(OWN, doc_id or 0, width, doc_id is not None, len(flat)) + flat.astype(f"<u{width}").tobytes())
                    out.write(_framed(payloads))
                    length = np.array([len(p) + HEAD + FOOT for p in payloads], np.int64)
                    n = np.array(n, np.int64)
                    m = len(n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(m, shard, np.int32)), pa.array([name] * m), pa.array(np.arange(record, record + m)),
                            pa.array(position + np.cumsum(length) - length), pa.array(length), batch.column("doc_id"),
                            pa.array(before + np.cumsum(n) - n), pa.array(n),
                        ],
                        names=["shard", "file", "record", "position", "length", "doc_id", "before", "n_tokens"],
                    )
                    record, position, before = record + m, position + int(length.sum()), before + int(n.sum())
        finally:
            if out:
                out.close()

    rows = document_rows(documents).withColumns({"mark": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = ["doc_id", "mark", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    index = stored(rows.mapInArrow(run, INDEX))
    named = {r.file for r in index.select("file").distinct().collect()}  # one name per task
    for found in fs.get_file_info(pafs.FileSelector(root)):
        if found.base_name.endswith(".records") and found.base_name not in named:
            fs.delete_file(found.path)  # of a task that was repeated
    return index


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: ids of all documents before it, over all files.

    The window runs over one row per file.
    """
    files = index.groupBy("shard").agg(F.sum("n_tokens").alias("of_shard"))
    before = F.sum("of_shard").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    return index.join(files, "shard").withColumn("start", F.col("base") + F.col("before")).drop("base", "before")


# --- Reading -------------------------------------------------------------------------


def _parsed(raw: bytes, at: np.ndarray, length: np.ndarray) -> list[memoryview]:
    """The payloads of frames in raw bytes, their checksums verified."""
    data = np.frombuffer(raw, np.uint8)
    heads = data[at[:, None] + np.arange(HEAD)]
    n = np.ascontiguousarray(heads[:, :8]).view("<u8").ravel().astype(np.int64)
    crc = np.ascontiguousarray(heads[:, 8:]).view("<u4").ravel()
    good = (masked(crc32c(heads[:, :8].ravel(), np.arange(0, 8 * len(at) + 1, 8))) == crc) & (n == length - HEAD - FOOT)
    if not good.all():
        raise ValueError("a record's length does not match its checksum or the index")
    view = memoryview(raw)
    payloads = [view[a : a + k] for a, k in zip((at + HEAD).tolist(), n.tolist())]
    foot = np.ascontiguousarray(data[(at + HEAD + n)[:, None] + np.arange(FOOT)]).view("<u4").ravel()
    if not (masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), np.concatenate([[0], np.cumsum(n)]))) == foot).all():
        raise ValueError("a record does not match its checksum")
    return payloads


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, str, int, int]]:
    """(first row, last row + 1, file, first byte, last byte + 1) of neighbouring records, read at once."""
    names, position, length = batch.column("file").to_pylist(), batch.column("position").to_numpy(), batch.column("length").to_numpy()
    lo = 0
    for i in range(1, len(names) + 1):
        near = i < len(names) and names[i] == names[lo] and position[i] == position[i - 1] + length[i - 1]
        if not near or position[i] + length[i] - position[lo] > RUN:
            yield lo, i, names[lo], int(position[lo]), int(position[i - 1] + length[i - 1])
            lo = i


def _read(batch: pa.RecordBatch, folder: str) -> Iterator[tuple[pa.RecordBatch, list[int | None], list[np.ndarray]]]:
    """Index rows, and the doc_id and the ids that their records hold."""
    fs, root = _file_system(folder)
    handle, name = None, None
    for lo, hi, file, begin, end in _runs(batch):
        if file != name:
            handle, name = fs.open_input_file(f"{root}/{file}"), file
        handle.seek(begin)
        part = batch.slice(lo, hi - lo)
        payloads = _parsed(handle.read(end - begin), part.column("position").to_numpy() - begin, part.column("length").to_numpy())
        doc_ids, ids = [], []
        for payload in payloads:
            doc_id, width, known, n = struct.unpack(OWN, payload[:OWN_SIZE])
            doc_ids.append(doc_id if known else None)
            ids.append(np.frombuffer(payload, f"<u{width}", n, OWN_SIZE).astype("<u4"))
        yield part, doc_ids, ids


def _placed(index: DataFrame, order: list[str], per_task: int = 32 << 20) -> DataFrame:
    """Index rows dealt over tasks of about ``per_task`` bytes of records, in the given order."""
    size = index.agg(F.sum("length")).first()[0] or 0
    return index.repartitionByRange(max(1, -(-size // per_task)), *order).sortWithinPartitions(*order)


def read_records(index: DataFrame, folder: str, seed: int | None = None) -> DataFrame:
    """doc_id and ids of every record that the index rows name, read at their offsets and verified.

    Without ``seed`` in the order of the files; with it in an order that is shuffled over the whole table,
    another for each seed and the same for the same one. Records that follow each other are read at once.
    """

    def run(batches):
        for batch in batches:
            for _, doc_ids, ids in _read(batch, folder):
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), flat], names=["doc_id", "ids"])

    rows, order = index, ["shard", "record"]
    if seed is not None:
        rows, order = index.withColumn("turn", F.xxhash64(F.lit(seed), "shard", "record")), ["turn", "shard", "record"]
    return _placed(rows, order).mapInArrow(run, "doc_id long, ids array<int>")


def record_digests(documents: DataFrame, tokenizer: str, end: int = 2, folder: Callable[[SparkSession], str] = shared_folder) -> DataFrame:
    """One row per document, from the files read back: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, in the order of ``write_records``; the
    checksum is that of the ids as little-endian unsigned 32-bit integers. Null and empty texts have
    the closing id alone. Every row counts: repeated rows have records of their own, a null doc_id stays null. An empty
    table gives no rows.
    """
    place = f"{folder(documents.sparkSession)}/records"
    index = with_starts(write_records(documents, tokenizer, place, end))

    def run(batches):
        for batch in batches:
            for part, doc_ids, ids in _read(batch, place):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()), part.column("start"), pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return _placed(index, ["shard", "record"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
