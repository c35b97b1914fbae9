"""Stable buckets cut from SHA-256 digests; the same in every engine that has the hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(digest: Column, slot: int | Column, digits: int = 8) -> Column:
    """The ``slot``-th run of ``digits`` hexadecimal digits of a digest, as bigint (at most 15 digits)."""
    start = (slot if isinstance(slot, Column) else F.lit(slot)) * digits + 1
    return F.conv(F.substring(digest, start, F.lit(digits)), 16, 10).cast("bigint")


def id_bucket(key: Column) -> Column:
    """First 32 bits of SHA-256 of the id."""
    return number(F.sha2(key.cast("string"), 256), 0)


def in_hash_sample(key: Column, fraction: float) -> Column:
    """Stable membership test: the same ids on every rerun, and nested across fractions."""
    if not 0 < fraction <= 1:
        raise ValueError("sample fraction must be in (0, 1]")
    return id_bucket(key) < F.lit(float(fraction) * 2**32)


def seeded_rank(key: Column, seed: int) -> Column:
    """A uniform random order of the ids that only depends on id and seed."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def payload_fingerprint(*columns: Column) -> Column:
    """Digest of a canonical JSON text of the columns; NULL fields are left out of the text."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)
