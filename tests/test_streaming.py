import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.operators.dedup import ConflictingPayloads, dedup_within_watermark
from basketline.plans.reconciliation import Mismatch, run_reconciliation
from basketline.plans.snapshot import run_snapshot
from basketline.sinks.changelog import latest_metrics
from basketline.sources import raw as R
from basketline.streaming import progress as P
from basketline.streaming import queries as Q
from basketline.streaming.pipeline import Pipeline
from tests.helpers import BASE, brute_metrics, event, metric_dict, random_events, raw_frame

RAW_DDL = "raw_json string, topic string, partition int, offset bigint, ingested_at timestamp"


def stage(spark, folder, events):
    raw_frame(spark, events).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return R.read_raw(spark, "files", {"path": folder})


def published(spark, pipeline, name):
    return metric_dict(latest_metrics(spark, pipeline.serving, name), None)


def test_log_options_and_projection(spark):
    options = R.kafka_options("host:1", "topic", 500)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "true"
    assert options["maxOffsetsPerTrigger"] == "500"
    assert "maxOffsetsPerTrigger" not in R.kafka_options("host:1", "topic")
    log = spark.createDataFrame(
        [(bytearray(b"{}"), "t", 1, 5, BASE)], "value binary, topic string, partition int, offset bigint, timestamp timestamp"
    )
    assert tuple(R.raw_from_log(log).first()) == ("{}", "t", 1, 5, BASE)
    with pytest.raises(ValueError):
        R.read_raw(spark, "pigeon", {})


def test_pipeline_equals_batch_restarts_and_reconciles(spark, tmp_path):
    source = str(tmp_path / "source")
    pipeline = Pipeline(str(tmp_path / "lake"), str(tmp_path / "checkpoints"))
    events = random_events(240)
    bad = [event(900, quantity=0), "{bad json", event(901, schema_version=2)]
    stage(spark, source, events + events[:30] + bad)
    pipeline.run_available(stream(spark, source))

    def check(items):
        exact = {k: v[:5] for k, v in brute_metrics(items).items()}
        slid = {k: v[:5] for k, v in brute_metrics(items, 300, 60).items()}
        assert {k: v[:5] for k, v in published(spark, pipeline, C.SALES).items()} == exact
        assert {k: v[:5] for k, v in published(spark, pipeline, C.TRENDING).items()} == slid

    check(events)
    assert spark.read.parquet(pipeline.quarantine).count() == 3
    assert spark.read.parquet(pipeline.silver).count() == 240
    assert spark.read.parquet(pipeline.bronze).count() == 273

    pipeline.run_available(stream(spark, source))  # restart: nothing new, nothing changes
    check(events)
    more = [dict(e, event_id="m" + e["event_id"]) for e in random_events(100, seed=8)]
    more = [dict(e, event_time=(BASE + timedelta(seconds=240 + n)).isoformat() + "Z") for n, e in enumerate(more)]
    stage(spark, source, more)
    finished = pipeline.run_available(stream(spark, source))
    check(events + more)

    reported = P.collected_progress(finished)
    rates = {r.query_name: r.rows_per_second for r in P.stage_throughput(reported).collect()}
    assert set(rates) == {C.BRONZE, C.SILVER, C.QUARANTINE, C.SALES, C.TRENDING} and min(rates.values()) > 0
    counters = {r.query_name: r for r in P.quality_counters(reported).collect()}
    assert counters[C.SILVER].late_events_removed == 0 and counters[C.SILVER].repeated_events_removed is not None
    assert counters[C.SALES].repeated_events_removed is None and counters[C.BRONZE].late_events_removed is None
    P.append_progress(spark, [tuple(r) for r in reported.collect()], str(tmp_path / "progress"))
    assert P.read_progress(spark, str(tmp_path / "progress")).count() == reported.count()
    health = P.pipeline_health(reported, reported.agg(F.max("updated_at")).first()[0] + timedelta(hours=1))
    assert {r.state for r in health.collect()} == {"Idle or needs checking"}

    out = str(tmp_path / "mismatches")
    assert run_reconciliation(spark, pipeline.silver, pipeline.serving, out) == 0
    report = run_snapshot(spark, pipeline.silver, str(tmp_path / "batch"), "real:", bronze=pipeline.bronze)
    assert report.totals.events == 340 and report.conflicting_event_ids == 0
    assert report.totals.revenue_paise == sum(v[2] for v in published(spark, pipeline, C.SALES).values())
    stored = spark.read.json(str(tmp_path / "batch" / "reports")).first()
    assert json.loads(stored.summary)["totals"]["events"] == 340
    assert spark.read.parquet(str(tmp_path / "batch" / "windows")).count() == len(published(spark, pipeline, C.SALES))

    spark.read.parquet(pipeline.silver).limit(1).withColumn("event_id", F.lit("extra")).write.mode("append").parquet(
        str(tmp_path / "silver2")
    )
    with pytest.raises(Mismatch):
        run_reconciliation(spark, str(tmp_path / "silver2"), pipeline.serving, str(tmp_path / "m2"))


def test_snapshot_fails_on_conflicting_payloads(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    stage(spark, bronze, [event(1), event(1, price_paise=7)])
    with pytest.raises(ConflictingPayloads):
        run_snapshot(spark, silver, str(tmp_path / "out"), "real:", bronze=bronze)
    assert spark.read.parquet(str(tmp_path / "out" / "conflicting_ids")).count() == 1


def test_late_and_repeated_records(spark, tmp_path):
    folder = tmp_path / "input"
    folder.mkdir()
    events = spark.readStream.schema("event_id string, event_ts timestamp").json(str(folder))
    query = (
        dedup_within_watermark(events)
        .writeStream.format("memory")
        .queryName("kept")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .start()
    )

    def send(number, name, seconds):
        text = json.dumps({"event_id": name, "event_ts": (BASE + timedelta(seconds=seconds)).isoformat()})
        partial = tmp_path / "partial.json"
        partial.write_text(text + "\n")
        os.rename(partial, folder / f"{number:03d}.json")
        query.processAllAvailable()

    try:
        send(1, "original", 10)
        send(2, "original", 10)
        assert spark.table("kept").count() == 1
        send(3, "advance", 300)
        send(4, "within", 270)
        send(5, "too-old", 30)
        assert {r.event_id for r in spark.table("kept").collect()} == {"original", "advance", "within"}
        dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
        assert dropped == 1
        Q.require_alive([query])
    finally:
        query.stop()
    with pytest.raises(RuntimeError, match="stopped"):
        Q.require_alive([query])


def test_listener_collects_reports(spark, tmp_path):
    recorder = P.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        source = str(tmp_path / "source")
        stage(spark, source, [event(1)])
        pipeline = Pipeline(str(tmp_path / "lake"), str(tmp_path / "checkpoints"))
        Q.drain([pipeline.keep_raw(stream(spark, source), Q.AVAILABLE_NOW)])
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(recorder)
    assert recorder.flush(spark, str(tmp_path / "progress")) >= 1
    assert P.read_progress(spark, str(tmp_path / "progress")).first().query_name == C.BRONZE
    assert recorder.flush(spark, str(tmp_path / "progress")) == 0


def test_metric_stream_refuses_exact_users(spark, tmp_path):
    from basketline import schemas
    from basketline.operators.metrics import window_metrics

    folder = tmp_path / "silver"
    folder.mkdir()
    silver = R.stream_files(spark, schemas.SILVER, str(folder))
    with pytest.raises(ValueError):
        window_metrics(silver, users="exact")


def test_json_lines_keep_line_numbers(spark, tmp_path):
    path = tmp_path / "fixture.jsonl"
    path.write_text("\n".join([json.dumps(event(1)), "{oops", json.dumps(event(2, quantity=0))]) + "\n")
    from basketline.operators.contract import parse_events

    raw = R.read_json_lines(spark, str(path), BASE + timedelta(hours=1))
    found = parse_events(raw, reasons=True).orderBy("offset").collect()
    assert [(r.offset, r.reject_reason) for r in found] == [(1, None), (2, "malformed JSON"), (3, "invalid quantity")]


def test_older_files_without_provenance_can_be_merged(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "event_id string, source_row bigint").write.parquet(str(tmp_path / "s" / "p=1"))
    spark.createDataFrame([("b",)], "event_id string").write.parquet(str(tmp_path / "s" / "p=2"))
    rows = {r.event_id: r.source_row for r in R.scan_silver(spark, str(tmp_path / "s"), merge=True).collect()}
    assert rows == {"a": 1, "b": None}


def test_replayed_slices_add_up_to_their_source(spark, tmp_path):
    """Slices sent one after the other, one of them twice, give the totals of the replay table."""
    from basketline.operators.metrics import window_rollup
    from basketline.operators.normalize import next_cursor, replay_slice
    from basketline.plans.replay import prepare_replay
    from tests.test_history_import import row, write_csv

    kinds = ["view", "purchase", "cart", "remove_from_cart"]
    rows = [row(kind=kinds[n % 4], price=f"{n}.5", product=f"p{n % 5}", day=f"{n % 9 + 1:02d}") for n in range(120)]
    rows[7] = row(price="NaN")
    prepare_replay(spark, write_csv(tmp_path / "m.csv", rows), str(tmp_path / "replay"), "real:", "shop")
    table = spark.read.parquet(str(tmp_path / "replay" / "events"))
    source, cursor = str(tmp_path / "source"), 0
    pipeline = Pipeline(str(tmp_path / "lake"), str(tmp_path / "checkpoints"))
    for n in range(3):
        at = BASE + timedelta(seconds=30 * n)
        piece = replay_slice(table, cursor, 50, at=at.isoformat() + "+00:00")
        raw = piece.select(
            F.to_json(F.struct(*[c for c in piece.columns if c != "position"])).alias("raw_json"),
            F.lit("t").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("position").alias("offset"),
            F.lit(at).alias("ingested_at"),
        )
        for _ in range(2 if n == 1 else 1):
            raw.coalesce(1).write.mode("append").parquet(source)
        cursor = next_cursor(piece, cursor)
    pipeline.run_available(stream(spark, source))
    live = window_rollup(latest_metrics(spark, pipeline.serving, C.SALES)).first()
    assert cursor == 119 == live.events == table.count()
    assert live.purchases == table.filter("event_type = 'purchase'").count()
    assert live.revenue_paise == table.filter("event_type = 'purchase'").agg(F.sum("price_paise")).first()[0]
    report = run_snapshot(spark, pipeline.silver, str(tmp_path / "b"), "real:", real=True, bronze=pipeline.bronze)
    assert report.totals.events == 119 and report.totals.revenue_paise == live.revenue_paise
    assert run_reconciliation(spark, pipeline.silver, pipeline.serving, str(tmp_path / "x")) == 0


def test_state_and_reports_of_restarted_queries(spark, tmp_path):
    """Two deliveries with a late and a repeated record: reports, state and totals after the second start."""
    from basketline.streaming.state import remembered_ids, state_operators

    source, progress = str(tmp_path / "source"), str(tmp_path / "progress")
    pipeline = Pipeline(str(tmp_path / "lake"), str(tmp_path / "checkpoints"), "2 minutes")
    first = [event(n, BASE + timedelta(seconds=n)) for n in range(10)] + [event(50, BASE + timedelta(minutes=10))]
    second = [event(3, BASE + timedelta(seconds=3)), event(60, BASE), event(50, BASE + timedelta(minutes=10)), event(70, BASE + timedelta(minutes=9))]
    with P.recording(spark, progress):
        for events in (first, second):
            stage(spark, source, events)
            pipeline.run_available(stream(spark, source))
    counters = P.batch_counters(P.read_progress(spark, progress)).filter(F.col("query_name") == C.SILVER).orderBy("batch_id").collect()
    assert [(r.input_rows, r.late, r.repeated) for r in counters] == [(11, 0, 0), (4, 2, 1)]
    assert {r.event_id for r in spark.read.parquet(pipeline.silver).collect()} == {e["event_id"] for e in first} | {"e00070"}
    checkpoint = f"{pipeline.checkpoints}/{C.SILVER}"
    assert {r.event_id for r in remembered_ids(spark, checkpoint).collect()} == {"e00050", "e00070"}
    assert state_operators(spark, checkpoint).filter("operatorName like 'dedupe%'").count() == 1


def test_records_of_few_large_files_are_dealt_to_all_cores(spark, tmp_path):
    """A table that is one row group ordered by time: the raw files of every delivery hold even shares."""
    from workload import queries as W
    from workload import views as V

    tables = str(tmp_path / "tables")
    V.table(spark, "/root/testdata/sf0.001", "events").coalesce(1).orderBy("ts").write.parquet(f"{tables}/events.parquet")
    least = spark.sparkContext.defaultParallelism
    shares = F.count(F.lit(1)).alias("rows")
    files = spark.read.parquet(W._streamed(spark, tables).bronze).groupBy(F.input_file_name()).agg(shares).collect()
    assert len(files) >= least and max(r.rows for r in files) <= 4 * sum(r.rows for r in files) / len(files)
    records = V.delivered(spark, tables).groupBy("partition", F.spark_partition_id().alias("task")).count().collect()
    assert {r.partition for r in records} == set(range(V.ROUNDS))
    assert all(sum(r.partition == number for r in records) >= least for number in range(V.ROUNDS))


def test_reports_of_queries_that_ran_before_are_not_recorded(spark):
    from types import SimpleNamespace as Event

    def report(run):
        return Event(progress=Event(name=run, runId=run, batchId=0, json="{}"))

    recorder = P.ProgressRecorder()
    recorder.onQueryStarted(Event(runId="inside"))
    for run in ("before", "inside"):
        recorder.onQueryProgress(report(run))
    assert [row[0] for row in recorder._rows] == ["inside"]
