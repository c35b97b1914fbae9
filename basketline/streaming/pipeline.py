"""The live pipeline: five durable queries joined by files, never by one plan.

bronze keeps every raw record; quarantine and silver split it; two metric queries read silver. Each
has its own checkpoint, so the state of de-duplication never feeds the state of an aggregation in the
same query, and each can be restarted or rebuilt on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketline import constants as C
from basketline import schemas
from basketline.operators.contract import parse_events, quarantined, valid_events
from basketline.operators.dedup import dedup_within_watermark
from basketline.operators.metrics import window_metrics
from basketline.sinks.changelog import epoch_publisher
from basketline.sources.raw import stream_files
from basketline.streaming import queries as Q


@dataclass(frozen=True)
class Pipeline:
    """Folders and watermark of one deployment of the pipeline.

    Input is capped at the raw source only. The stages in between read whatever their upstream has
    committed: a cap there would cut one upstream batch into several, of which the first moves the
    watermark past the others.
    """

    root: str
    checkpoints: str
    watermark: str = "2 minutes"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def serving(self) -> str:
        return f"{self.root}/serving"

    def keep_raw(self, raw: DataFrame, trigger: dict) -> StreamingQuery:
        return Q.start_query(raw, C.BRONZE, self.checkpoints, path=self.bronze, trigger=trigger)

    def split(self, spark: SparkSession, trigger: dict) -> list[StreamingQuery]:
        """Quarantine and silver, both from bronze."""
        Q.ensure_folder(spark, self.bronze)
        parsed = parse_events(stream_files(spark, schemas.RAW, self.bronze))
        silver = dedup_within_watermark(valid_events(parsed), delay=self.watermark)
        return [
            Q.start_query(
                quarantined(parsed), C.QUARANTINE, self.checkpoints, path=self.quarantine, trigger=trigger
            ),
            Q.start_query(silver, C.SILVER, self.checkpoints, path=self.silver, trigger=trigger),
        ]

    def measure(self, spark: SparkSession, trigger: dict) -> list[StreamingQuery]:
        """Tumbling and sliding metrics of silver, published as absolute values of changed keys."""
        Q.ensure_folder(spark, self.silver)
        started = []
        for name, size, slide in C.METRIC_WINDOWS:
            silver = stream_files(spark, schemas.SILVER, self.silver)
            metrics = window_metrics(silver.withWatermark("event_ts", self.watermark), size, slide)
            started.append(
                Q.start_query(
                    metrics,
                    name,
                    self.checkpoints,
                    publish=epoch_publisher(name, self.serving),
                    mode="update",
                    trigger=trigger,
                )
            )
        return started

    def start(self, raw: DataFrame, interval: str = "5 seconds") -> list[StreamingQuery]:
        """All five queries, running until stopped."""
        spark, trigger = raw.sparkSession, Q.every(interval)
        Q.use_rocksdb(spark)
        return [self.keep_raw(raw, trigger), *self.split(spark, trigger), *self.measure(spark, trigger)]

    def run_available(self, raw: DataFrame) -> list[StreamingQuery]:
        """Process what has arrived, stage by stage, and stop. Returns the finished queries."""
        spark, trigger = raw.sparkSession, Q.AVAILABLE_NOW
        Q.use_rocksdb(spark)
        finished: list[StreamingQuery] = []
        for stage in (
            lambda: [self.keep_raw(raw, trigger)],
            lambda: self.split(spark, trigger),
            lambda: self.measure(spark, trigger),
        ):
            running = stage()
            Q.drain(running)
            finished += running
        return finished
