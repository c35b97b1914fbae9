"""What a stateful query remembers, read from its checkpoint as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def remembered_ids(spark: SparkSession, checkpoint: str, key: str = "event_id") -> DataFrame:
    """Ids that de-duplication within the watermark still knows, and until when; after the last batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col(f"key.{key}").alias(key), F.timestamp_micros(F.col("value.expiresAtMicros")).alias("known_until")
    )


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint, the number of their partitions, and the batches they hold."""
    return spark.read.format("state-metadata").load(checkpoint)
