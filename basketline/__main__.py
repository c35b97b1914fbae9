"""Jobs: ``spark-submit`` or ``python -m basketline <job> --help``."""

from __future__ import annotations

import argparse
import json
import sys
import time
from datetime import datetime, timezone


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="basketline", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    stream = jobs.add_parser("stream", help="run the live pipeline until stopped")
    stream.add_argument("--root", required=True, help="folder of bronze, silver, quarantine and serving")
    stream.add_argument("--checkpoints", required=True)
    stream.add_argument("--bootstrap", help="log servers; without them raw Parquet files are read")
    stream.add_argument("--topic", default="commerce.events.v1")
    stream.add_argument("--source", help="folder of raw Parquet files")
    stream.add_argument("--max-offsets", type=int, help="log records per micro-batch")
    stream.add_argument("--max-files", type=int, help="raw files per micro-batch; they must arrive in time order")
    stream.add_argument("--watermark", default="2 minutes")
    stream.add_argument("--trigger", default="5 seconds")
    stream.add_argument("--once", action="store_true", help="process what is there and stop")

    snapshot = jobs.add_parser("snapshot", help="report over stored events")
    snapshot.add_argument("--silver", required=True)
    snapshot.add_argument("--bronze")
    snapshot.add_argument("--output", required=True)
    snapshot.add_argument("--namespace", required=True)
    snapshot.add_argument("--data-source", choices=["real", "synthetic"], default="synthetic")
    snapshot.add_argument("--sample-fraction", type=float, default=0.1)

    reconcile = jobs.add_parser("reconcile", help="compare published metrics with stored events")
    reconcile.add_argument("--silver", required=True)
    reconcile.add_argument("--serving", required=True)
    reconcile.add_argument("--output", required=True)

    month = jobs.add_parser("import-month", help="import one month of history from CSV")
    month.add_argument("--source", required=True)
    month.add_argument("--month", required=True, help="such as 2019-Oct")
    month.add_argument("--root", required=True)
    month.add_argument("--id-prefix", required=True)

    for name, text in (("customers", "customer report of history"), ("algorithms", "sketch experiment")):
        jobs.add_parser(name, help=text).add_argument("--root", required=True)

    replay = jobs.add_parser("prepare-replay", help="positioned replay table from a CSV prefix")
    replay.add_argument("--source", required=True)
    replay.add_argument("--output", required=True)
    replay.add_argument("--namespace", required=True)
    replay.add_argument("--id-prefix", required=True)
    replay.add_argument("--rows", type=int, help="only the first so many source rows")

    fixture = jobs.add_parser("fixture", help="exact report of a file of JSON events")
    fixture.add_argument("--source", required=True)
    fixture.add_argument("--output", required=True)
    return parser


def run_stream(spark, args) -> None:
    from basketline.sources.raw import kafka_options, read_raw
    from basketline.streaming.pipeline import Pipeline
    from basketline.streaming.progress import ProgressRecorder
    from basketline.streaming.queries import require_alive

    if args.bootstrap:
        raw = read_raw(spark, "kafka", kafka_options(args.bootstrap, args.topic, args.max_offsets))
    else:
        raw = read_raw(spark, "files", {"path": args.source, "max_files_per_trigger": args.max_files})
    pipeline = Pipeline(args.root, args.checkpoints, args.watermark)
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    progress = f"{args.root}/progress"
    if args.once:
        pipeline.run_available(raw)
        recorder.flush(spark, progress)
        return
    queries = pipeline.start(raw, args.trigger)
    try:
        while True:
            require_alive(queries)
            recorder.flush(spark, progress)
            time.sleep(10)
    finally:
        for query in reversed(queries):
            query.stop()


def main(argv: list[str] | None = None) -> int:
    args = arguments().parse_args(argv)
    from basketline.session import build_session

    spark = build_session(f"commerce {args.job}")
    if args.job == "stream":
        run_stream(spark, args)
    elif args.job == "snapshot":
        from basketline.plans.snapshot import run_snapshot

        row = run_snapshot(
            spark,
            args.silver,
            args.output,
            args.namespace,
            args.data_source == "real",
            args.sample_fraction,
            args.bronze,
        )
        print(json.dumps(row.asDict(recursive=True), default=str))
    elif args.job == "reconcile":
        from basketline.plans.reconciliation import Mismatch, run_reconciliation

        try:
            run_reconciliation(spark, args.silver, args.serving, args.output)
        except Mismatch as found:
            print(found, file=sys.stderr)
            return 1
    elif args.job == "import-month":
        from basketline.sinks.history import import_month

        print(import_month(spark, args.source, args.month, args.root, args.id_prefix))
    elif args.job == "customers":
        from basketline.plans.customers import run_customer_report

        print(run_customer_report(spark, args.root)["accepted_rows"])
    elif args.job == "algorithms":
        from basketline.plans.algorithms import run_algorithm_report

        print(run_algorithm_report(spark, args.root)["events"])
    elif args.job == "prepare-replay":
        from basketline.plans.replay import prepare_replay

        print(prepare_replay(spark, args.source, args.output, args.namespace, args.id_prefix, args.rows))
    elif args.job == "fixture":
        from basketline.plans.fixture import run_fixture_report

        run_fixture_report(spark, args.source, args.output, datetime.now(timezone.utc).replace(tzinfo=None))
    return 0


if __name__ == "__main__":
    sys.exit(main())
