"""Whole Arrow batches of text as numpy codes: word hashes, shingles, sets of them.

Hashes are sums of a random code per byte times powers of an odd number, modulo 2**64, so the hash
of any span is a difference of prefix sums and no Python string is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 1 << 20
ODD = 0x9E3779B97F4A7C15
_state: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit codes (the splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, for positions below n."""
    if len(_state.get("pow", ())) <= n:
        size = max(n, CHUNK + 1)
        out = []
        for base in (ODD, pow(ODD, -1, 1 << 64)):
            p = np.full(size, base, U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _state["pow"], _state["inv"] = out
    return _state["pow"], _state["inv"]


def span_hashes(codes: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """64-bit hash of codes[s:e] for every span, for each array of ends; codes are uint64."""
    pw, inv = powers(len(codes))
    sums = np.empty(len(codes) + 1, U)
    sums[0] = 0
    np.cumsum(codes * pw[: len(codes)], out=sums[1:])
    before, scale = sums[starts], inv[starts]
    return [mix((sums[e] - before) * scale + (e - starts).astype(U)) for e in ends]


def random_codes(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(ODD))


def byte_codes() -> np.ndarray:
    """A code per byte; A-Z have those of a-z."""
    if "bytes" not in _state:
        codes = random_codes(256)
        codes[65:91] = codes[97:123]
        _state["bytes"] = codes
    return _state["bytes"]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def _cuts(raw: np.ndarray, limit: int) -> list[int]:
    """Chunk borders about ``limit`` bytes apart, each at a white space byte."""
    cuts, at = [0], limit
    while at < len(raw):
        step = 1 << 12
        while True:
            found = np.flatnonzero(_SPACE[raw[at : at + step]])
            if len(found) or at + step >= len(raw):
                break
            step *= 4
        if not len(found):
            break
        cuts.append(at + int(found[0]))
        at = cuts[-1] + limit
    return [*cuts, len(raw)]


def words(texts: pa.Array, beginnings: tuple[int, ...] = ()) -> tuple:
    """Hash of every lower-cased word of a batch, and the n + 1 offsets of its rows into them.

    With ``beginnings``, the hashes of the first so many bytes of each word stand in between, as a list.
    """
    raw, offsets = buffers(texts)
    row_starts = np.unique(offsets[:-1][offsets[:-1] < offsets[1:]])
    hashes, starts, heads = [np.zeros(0, U)], [np.zeros(0, np.int64)], [[np.zeros(0, U)] for _ in beginnings]
    cuts = _cuts(raw, CHUNK)
    for lo, hi in zip(cuts, cuts[1:]):
        part = raw[lo:hi]
        inside = ~_SPACE[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        own = row_starts[np.searchsorted(row_starts, lo) : np.searchsorted(row_starts, hi)] - lo
        first[own] = inside[own]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = own[own > 0] - 1
        last[before] = inside[before]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        whole, *rest = span_hashes(byte_codes()[part], s, e, *[np.minimum(s + k, e) for k in beginnings])
        hashes.append(whole)
        for head, got in zip(heads, rest):
            head.append(got)
        starts.append(s + lo)
    at = np.searchsorted(np.concatenate(starts), offsets)
    if beginnings:
        return np.concatenate(hashes), [np.concatenate(h) for h in heads], at
    return np.concatenate(hashes), at


def shingles(codes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of each row, in order, and their offsets.

    A row with fewer words has one shingle of all of them; a row without words has none.
    """
    counts = np.diff(offsets)
    out = np.maximum(counts - size + 1, (counts > 0).astype(counts.dtype))
    to = np.concatenate([[0], np.cumsum(out)])
    rows = np.repeat(np.arange(len(counts)), out)
    begin = np.arange(to[-1]) - to[rows] + offsets[rows]
    length = np.minimum(counts, size)[rows]
    total = length.astype(U)
    for k in range(size):
        here = k < length
        step = np.zeros(len(begin), U)
        step[here] = codes[begin[here] + k]
        total = mix(total * U(ODD) + step)
    return total, to


def distinct(codes: np.ndarray) -> np.ndarray:
    """The sorted distinct values; for short arrays much faster than numpy's hashing."""
    codes = np.sort(codes)
    return codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes


def sets(codes: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct codes of each row."""
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield distinct(codes[lo:hi])


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``limit`` bytes of text; one longer row stands alone."""
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def long_list(parts: list[np.ndarray]) -> pa.Array:
    """A list column of longs from one array of 64-bit codes per row."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def word_spans(raw: bytes) -> np.ndarray:
    """Start and end byte of every word of one text."""
    inside = np.concatenate([[False], ~_SPACE[np.frombuffer(raw, np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges.reshape(-1, 2)
