"""Pairs of places that need no search: what is turned away has no similar passage, and few are left."""

import random

import numpy as np
import pyarrow as pa
import pytest

from basketline.llm import substring_dedup


def prose(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def stretch(rng, n):
    return rng.integers(0, 2**32, n).astype("<u4")


def pair(words, other, at, other_at, same=False):
    return {
        "doc_id": 2, "from": 0, "near": words.tobytes(), "other": 2 if same else 1, "other_from": 0, "other_near": other.tobytes(), "shift": at - other_at,
        "places": [at],
    }


def edited(rng, words, edits):
    """A copy with words changed, left out and put in, and at times a part moved to the end."""
    out = words.tolist()
    for _ in range(edits):
        at = int(rng.integers(0, len(out)))
        out[at : at + int(rng.integers(0, 2))] = stretch(rng, int(rng.integers(0, 2))).tolist()
    cut = int(rng.integers(0, len(out))) if rng.random() < 0.3 else 0
    return np.array(out[cut:] + out[:cut], "<u4")


def many_pairs(rng, n):
    rows = []
    for case in range(n):
        passage = stretch(rng, int(rng.integers(45, 160)))
        if case % 5 == 0:  # few different words
            passage = passage[rng.integers(0, 6, len(passage))]
        copy = edited(rng, passage, int(rng.integers(0, 6)))
        words = np.concatenate([stretch(rng, 40), passage, stretch(rng, 40)])[:256]
        other = np.concatenate([stretch(rng, 60), copy, stretch(rng, 20)])[:256]
        rows.append(pair(words, other, 40 + int(rng.integers(0, len(passage))), 60 + int(rng.integers(0, len(copy)))))
    return rows


def test_pairs_that_are_turned_away_have_no_passage(monkeypatch):
    rng = np.random.default_rng(5)
    rows = many_pairs(rng, 400)
    (batch,) = pa.Table.from_pylist(rows).to_batches()
    found = substring_dedup._verified(batch).to_pylist()
    may = substring_dedup._may_hold(batch)
    monkeypatch.setattr(substring_dedup, "_may_hold", lambda part: np.ones(part.num_rows, bool))
    alone = [substring_dedup._verified(batch.slice(i, 1)).num_rows > 0 for i in range(batch.num_rows)]
    assert found == substring_dedup._verified(batch).to_pylist() and len(found) > 50
    assert not (np.array(alone) & ~may).any() and may.mean() < 0.9

    left, right = (substring_dedup._Side(batch, c) for c in ("near", "other_near"))
    at = np.array([r["places"][0] for r in rows])
    ok = substring_dedup._may_be_similar(left, at, right, at - np.array([r["shift"] for r in rows]))
    assert ok[np.arange(len(rows)), np.arange(len(rows))][alone].all()
    assert ok.sum() < 2 * len(rows)  # of all pairs of a place and another's copy


def test_a_short_text_of_very_many_documents_is_no_search(spark, monkeypatch):
    """20 words that 200 documents have, of which 40 are alike in twos around them."""
    rng = random.Random(23)
    common = prose(rng, 20)
    texts = [prose(rng, 60) + common + prose(rng, 60) for _ in range(160)]
    for _ in range(20):
        before, behind = prose(rng, 30), prose(rng, 30)
        texts.append(prose(rng, 60) + before + common + behind + prose(rng, 60))
        texts.append(prose(rng, 60) + before + common[:10] + ["new"] + common[10:] + behind + prose(rng, 60))
    monkeypatch.setattr(substring_dedup, "tiled", lambda *_: pytest.fail("pairs of all places are searched"))
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.deduplicated(rows).collect()}
    assert {i for i, n in got.items() if n} == {i for i in range(161, 200, 2)}
    assert all(81 <= got[i] <= 85 for i in range(161, 200, 2))


def test_pairs_of_large_keys_are_all_that_share_enough(spark):
    rng = np.random.default_rng(9)
    short = stretch(rng, 12)
    near = []
    for case in range(150):
        words = np.concatenate([stretch(rng, 100), short, stretch(rng, 100)])
        if case % 3 == 1:  # some shingles of the one before
            n = int(rng.integers(20, 60))
            words[112 : 112 + n] = near[-1][112 : 112 + n]
        near.append(words)
    texts = spark.createDataFrame([(i, 100, 0, bytearray(w.tobytes())) for i, w in enumerate(near)], "doc_id long, pos long, from long, near binary")
    large = spark.createDataFrame([(k, i, 100, i, False) for k in (7, 8) for i in range(150) if k == 7 or i % 2], "key long, doc_id long, pos long, component long, settled boolean")
    few, many = substring_dedup.pairs_of_large_keys(large, texts)
    got = {(r.doc_id, r.other) for r in few.collect()}
    sets = [set(zip(*[w[i : len(w) - 4 + i].tolist() for i in range(5)])) for w in near]
    want = {(i, j) for i in range(150) for j in range(i) if len(sets[i] & sets[j]) >= substring_dedup.FEWEST}
    assert want <= got and len(want) > 20 and len(got) < 100 and many.isEmpty()
