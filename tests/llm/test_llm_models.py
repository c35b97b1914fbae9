"""Formulas of the learned and scored parts against plain ones, and readers on broken input."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketline.llm import common, html_tree, packing, toxicity


def test_slopes_of_the_risk():
    rng = np.random.default_rng(1)
    for prior, shift in ((0.3, 0.0), (0.9, -6.0)):  # the second has a negative part below 0
        p, u = rng.normal(size=7) + 1, rng.normal(size=9) + shift

        def part(p, u):
            return np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()

        def risk(p, u):
            return prior * np.logaddexp(0, -p).mean() + part(p, u) if part(*start) >= 0 else -part(p, u)

        start = (p, u)
        assert (part(p, u) >= 0) == (shift == 0)
        got = toxicity.pu_slopes(p, u, prior)
        for side in (0, 1):
            for i in range(len(start[side])):
                step = [x.copy() for x in start]
                step[side][i] += 1e-6
                assert abs((risk(*step) - risk(*start)) / 1e-6 - got[side][i]) < 1e-4


def test_screen_finds_the_features_that_tell():
    model = toxicity.Linear(0.2)
    p, u = np.zeros(toxicity.BUCKETS), np.zeros(toxicity.BUCKETS)
    p[:3], u[:3] = (900, 500, 2), (200, 500, 1)  # toxic alone, everywhere, rare
    assert np.flatnonzero(model.screen(p, u, 1000, 1000)).tolist() == [0]


def test_scores_are_those_of_bm25():
    rng = random.Random(2)
    docs = [[rng.randrange(60) for _ in range(rng.randrange(1, 80))] for _ in range(50)]
    idf = np.random.default_rng(2).random(64).astype(np.float32) + 0.5
    mean = sum(map(len, docs)) / len(docs)
    terms = [np.unique(np.array(d, np.int32), return_counts=True) for d in docs]
    index = packing.Index(terms, idf, mean)
    for seed in (0, 7, 33):
        scores = {}
        for i, d in enumerate(docs):
            total = sum(
                float(idf[t]) * d.count(t) * (packing.K1 + 1) / (d.count(t) + packing.K1 * (1 - packing.B + packing.B * len(d) / mean)) for t in set(docs[seed]) if t in d
            )
            if total > 0:
                scores[i] = total
        got = index.neighbours(seed).tolist()
        assert set(got) == set(scores)
        assert all(scores[a] >= scores[b] - 1e-4 for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("piece", ["<div>", "<a ", '<a b="', """<a ">" '""", "<p><table>", "<li>x", "<!x", "<!-- x", "< ", "<script>"])
def test_broken_pages_take_linear_time(piece):
    started = time.process_time()
    html_tree.parse(piece * 60_000)
    assert time.process_time() - started < 6


def test_tags_and_text_of_odd_pages():
    page = """<body><div title="a > b" class='x'>1 < 2 &amp; <b>three</b><!-- <p>no --><br>four<p>five<p>six</div>seven <a href="y">link</a><td>t"""
    tree = html_tree.parse(page)
    shown = [(tree.tag[tree.parent[i]], tree.text[i]) for i in range(len(tree.tag)) if tree.tag[i] == "#text"]
    assert shown == [("div", "1 < 2 & three four"), ("p", "five"), ("p", "six"), ("body", "seven link"), ("td", "t")]
    assert tree.linked[tree.text.index("seven link")] == 4
    assert any(a.startswith('title="a > b"') for a in tree.attrs)
    for odd in ("", "<", "<a", "</", "<>", "a<b", '<a "', "<!", "<!--", "</div></p>", "\0<p>\0"):
        html_tree.parse(odd)


def test_bitmaps_stand_before_the_join(spark):
    rows = spark.range(1000).withColumn("text", F.lit("x")).hint("merge")
    plan = common.screened(rows, spark.range(0, 1000, 7).hint("merge"), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan
    lines = plan.splitlines()
    depth = {m: next(len(x) - len(x.lstrip(" :+-")) for x in lines if m in x) for m in ("getbit", "Join Inner")}
    assert depth["Join Inner"] < depth["getbit"]


def test_facts_are_joined_and_other_rows_stay(spark):
    rows = spark.range(500).select(F.when(F.col("id") != 3, F.col("id")).alias("a.b"), F.lit("x").alias("_at"))
    facts = spark.range(0, 900, 5).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    got = common.with_facts(rows, facts, "a.b")
    assert got.columns == ["a.b", "_at", "key", "twice"]
    want = [(i, "x", *((i, 2 * i) if i % 5 == 0 else (None, None))) for i in range(500) if i != 3]
    assert sorted(tuple(r) for r in got.where("`a.b` is not null").collect()) == sorted(want)
    assert [tuple(r) for r in got.where("`a.b` is null").collect()] == [(None, "x", None, None)]


def test_screened_rows_are_exact(spark):
    rows = spark.range(5000).selectExpr("id * 7 as id", "'x' as bits", "1 as _n")
    ids = spark.range(3000).selectExpr("id * 14 as wanted")
    for bits in (1 << 26, 1 << 15):
        assert sorted(r.id for r in common.screened(rows, ids, "id", bits).collect()) == [14 * i for i in range(2500)]
    assert common.screened(rows, ids.limit(0), "id").count() == 0


def test_keys_are_led_as_one_by_one(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(k), int(i)) for k, i in zip(rng.integers(0, 200, 3000), rng.integers(0, 400, 3000))] + [(7, i) for i in range(1000, 1400)]
    batches = [pairs[i : i + 300] for i in range(0, len(pairs), 300)]
    frames = []
    for batch in batches:
        ids = np.array([i for _, i in batch])
        found = common.key_rows(ids, np.array([k for k, _ in batch], np.uint64), np.arange(len(batch) + 1))
        frames += found.to_pylist()
    led = common.led_by_heads(spark.createDataFrame([tuple(f.values()) for f in frames], common.KEY_ROWS)).collect()
    members = {}
    for k, i in pairs:
        members.setdefault(k, set()).add(i)
    assert {(r.key, r.id) for r in led} == {(k, i) for k, ids in members.items() if len(ids) > 1 for i in ids}
    # Every leader is a member, and following leaders ends at the smallest id of the key.
    up = {}
    for r in led:
        up[r.key, r.id] = min(r.leader, up.get((r.key, r.id), r.leader))
    for key, i in up:
        while up[key, i] != i:
            assert up[key, i] < i and up[key, i] in members[key]
            i = up[key, i]
        assert i == min(members[key])


def test_overlaps_of_many_rows():
    rng = np.random.default_rng(4)
    sides = [[rng.integers(0, 30, rng.integers(0, 20)).astype(np.uint64) << np.uint64(20) for _ in range(9000)] for _ in range(2)]
    flat = [np.concatenate(s) for s in sides]
    at = [np.concatenate([[0], np.cumsum([len(x) for x in s])]) for s in sides]
    n_a, n_b, both = common.overlaps(flat[0], at[0], flat[1], at[1])
    for i in range(0, 9000, 37):
        a, b = set(sides[0][i].tolist()), set(sides[1][i].tolist())
        assert (n_a[i], n_b[i], both[i]) == (len(a), len(b), len(a & b))
