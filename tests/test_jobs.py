"""The jobs as a user starts them, and the smaller reports."""

import json
from datetime import timedelta

import pytest

from basketline.__main__ import arguments, main
from basketline.plans.algorithms import read_algorithm_report, run_algorithm_report
from basketline.plans.fixture import fixture_sections
from tests.helpers import BASE, brute_metrics, event, random_events, raw_frame
from tests.test_history_import import row, write_csv


def test_every_job_has_arguments():
    args = arguments().parse_args(["import-month", "--source", "s", "--month", "2019-Oct", "--root", "r", "--id-prefix", "p"])
    assert args.month == "2019-Oct"
    with pytest.raises(SystemExit):
        arguments().parse_args(["nothing"])


def test_stream_snapshot_reconcile(spark, tmp_path, capsys):
    raw_frame(spark, random_events(60)).write.parquet(str(tmp_path / "raw"))
    root = str(tmp_path / "lake")
    places = ["--silver", f"{root}/silver"]
    assert main(["stream", "--root", root, "--checkpoints", str(tmp_path / "c"), "--source", str(tmp_path / "raw"), "--once"]) == 0
    assert main(["snapshot", *places, "--bronze", f"{root}/bronze", "--output", str(tmp_path / "b"), "--namespace", "real:"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["totals"]["events"] == 60 and report["data_source"] == "synthetic"
    reconcile = ["reconcile", *places, "--serving", f"{root}/serving", "--output", str(tmp_path / "m")]
    assert main(reconcile) == 0
    extra = spark.read.parquet(f"{root}/silver").limit(1).selectExpr("* except (event_id)", "'extra' as event_id")
    spark.read.parquet(f"{root}/silver").unionByName(extra).write.parquet(str(tmp_path / "silver2"))
    reconcile[2] = str(tmp_path / "silver2")
    assert main(reconcile) == 1


def test_algorithm_report(spark, tmp_path):
    root = str(tmp_path / "history")
    rows = [row(product=f"p{n % 37}", user=str(n), session=f"s{n}", day=f"{n % 28 + 1:02d}") for n in range(400)]
    assert main(["import-month", "--source", write_csv(tmp_path / "m.csv", rows), "--month", "2019-Oct", "--root", root, "--id-prefix", "shop"]) == 0
    assert read_algorithm_report(spark, root) is None
    report = run_algorithm_report(spark, root, limit=300, inserted=100, sample=50)
    assert report["events"] == 300 and report == read_algorithm_report(spark, root)
    assert all(r["overcount"] >= 0 for r in report["count_min_sketch"]["comparison"])
    assert len(report["count_min_sketch"]["comparison"]) == 20
    assert (report["reservoir"]["retained"], len(report["reservoir"]["examples"])) == (50, 10)
    assert report["bloom"]["absent_probes"] == 200 and report["bloom"]["inserted"] == 100
    assert report["bloom"]["false_positives"] < 20


def test_fixture_report(spark, tmp_path):
    events = random_events(90)
    lines = [json.dumps(e) for e in events + events[:10]] + ["{bad", json.dumps(event(1, user_id=5))]
    path = tmp_path / "fixture.jsonl"
    path.write_text("\n".join(lines) + "\n")
    sections = fixture_sections(spark, str(path), BASE + timedelta(days=1), str(tmp_path / "scratch"))
    refused = sorted((r.line, r.reject_reason) for r in sections["invalid_records"].collect())
    assert refused == [(101, "malformed JSON"), (102, "id is not text")]
    totals = sections["totals"].first()
    assert (totals.input_lines, totals.duplicate_records, totals.events) == (102, 10, 90)
    assert totals.revenue_paise == sum(v[2] for v in brute_metrics(events).values())
    assert sections["tumbling_windows"].count() == len(brute_metrics(events))
    assert sections["sample_estimates"].count() == 5


def test_lines_of_the_fixture_are_put_in_order_by_more_tasks_as_they_grow(spark, tmp_path, monkeypatch):
    from workload import queries as W

    tables = "/root/testdata/sf0.001"
    expected = W.fixture_report(spark, tables).first()
    monkeypatch.setattr(W, "LINES_A_FILE", 100, raising=False)
    monkeypatch.setattr(W, "shared_folder", lambda _: str(tmp_path / "shared"))
    assert W.fixture_report(spark, tables).first() == expected
    files = [p for p in (tmp_path / "shared" / "lines").glob("part-*") if p.stat().st_size]
    assert len(files) >= spark.read.parquet(f"{tables}/events.parquet").count() / 100 / 2 > 4
