"""Duplicate suppression and the audit of ids that carry different payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketline import schemas
from basketline.session import through_table

ARRIVAL_ORDER = ("ingested_at", "partition", "offset")


def dedup_exact(
    df: DataFrame, key: str | Sequence[str] = "event_id", order_by: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    """One row per key, the first observed in ``order_by``. Batch only.

    The rank filter is planned as a group limit below the exchange: every task sends at most one
    row per key, so a key with any number of copies reaches its reducer as one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn(
        "_seen", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order_by]))
    )
    return ranked.filter(F.col("_seen") == 1).drop("_seen")


def dedup_stored(
    df: DataFrame,
    folder: str,
    key: str = "event_id",
    order_by: Sequence[str] = ARRIVAL_ORDER,
    broadcast_ids: int = 200_000,
) -> DataFrame:
    """``dedup_exact`` for stored rows of which few are repeated, as after the streaming form.

    Only the ids are shuffled, to find the repeated ones; they are stored in ``folder`` and counted.
    None: the rows are returned as they are. Few: every other row passes by them in a broadcast join
    without being moved. Too many to broadcast: all rows are ranked, and stored for repeated use.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    repeated = through_table(counts.select(key), f"{folder}/repeated_ids")
    found = repeated.count()
    if not found:
        return df
    if found > broadcast_ids:
        return through_table(dedup_exact(df, key, order_by), f"{folder}/unique_rows")
    ids = F.broadcast(repeated.withColumnRenamed(key, "_repeated"))
    same = F.col(key).eqNullSafe(F.col("_repeated"))  # NULL is a key like any other, as in ``dedup_exact``
    return df.join(ids, same, "left_anti").unionByName(dedup_exact(df.join(ids, same, "left_semi"), key, order_by))


def dedup_within_watermark(
    df: DataFrame, key: str = "event_id", ts: str = "event_ts", delay: str = "2 minutes"
) -> DataFrame:
    """Streaming form: ids are remembered until the watermark passes, which bounds the state."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def conflicting_ids(valid_events: DataFrame) -> DataFrame:
    """Ids with more than one distinct payload, and how many. Batch only.

    The payload is every contract field but the event time text, plus the instant it stands for:
    equal instants written with different offsets are the same payload. Each record is parsed once and stands for
    its payload by two 64-bit hashes, which differ for different payloads but for a chance of 2**-128. Copies are
    combined in the map tasks, so an id with any number of them is a row per task and payload.
    """
    fields = [F.col(f.name) for f in schemas.EVENT.fields if f.name != "event_time"] + [F.col("event_ts")]
    hashed = valid_events.select("event_id", F.xxhash64(*fields).alias("_a"), F.xxhash64(F.lit(1), *fields).alias("_b"))
    payloads = hashed.groupBy("event_id", "_a", "_b").agg(F.count(F.lit(1)).alias("_n"))
    return (
        payloads.groupBy("event_id").agg(F.count(F.lit(1)).alias("payload_variants")).filter("payload_variants > 1")
    )


class ConflictingPayloads(RuntimeError):
    """Exact totals were asked for while some ids carry contradictory payloads."""


def require_no_conflicts(conflicts: DataFrame) -> int:
    """Number of conflicting ids, which must be zero."""
    found = conflicts.count()
    if found:
        raise ConflictingPayloads(
            f"{found} event ids have conflicting payloads; resolve them before claiming exact totals"
        )
    return found
