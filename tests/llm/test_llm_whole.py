"""Rows and neighbours that a shorter job would leave out."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest

from basketline.llm import packing, substring_dedup, topk
from basketline.llm.queries import QUERIES


def prose(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def documents(spark, texts):
    return spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def removed(spark, texts):
    return {r.doc_id: r.n_removed for r in substring_dedup.deduplicated(documents(spark, texts)).collect()}


def test_registered_edit_counts_with_a_null_id(spark, tmp_path):
    text = "some words and 12 numbers in the middle of a short text"
    rows = [(None, text), (0, text), (5, None), (7, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op4_edit_aware_counts"](spark, str(tmp_path)).collect()}
    assert set(got) == {None, 0, 5, 7} and all(r.n_edits == 4 for r in got.values())
    assert got[None][1:] == got[0][1:]
    assert got[5][1:] == got[7][1:]


def test_passages_behind_an_earlier_partial_copy(spark):
    rng = random.Random(5)
    texts, want = [], {}
    for case in range(40):
        size = rng.randrange(50, 75)
        passage = prose(rng, size)
        part = rng.randrange(25, 50)
        cut = passage[:part] if case % 2 else passage[-part:]
        for k, held in enumerate((cut, passage, passage)):
            texts.append((3 * case + k, [*prose(rng, 30), *held, *prose(rng, 30)]))
            want[3 * case + k] = size if k == 2 else 0
    # An earlier copy of 60 words settles the bands of both later ones, which share 80.
    for case in range(40, 60):
        passage = prose(rng, 80)
        for k, held in enumerate((passage[:60], passage, passage)):
            texts.append((3 * case + k, [*prose(rng, 30), *held, *prose(rng, 30)]))
            want[3 * case + k] = (0, 60, 80)[k]
    assert removed(spark, texts) == want


def test_passages_with_one_edit(spark):
    rng = random.Random(6)
    texts, want = [], {}
    for case in range(120):
        size = rng.choice([51, 55, 60, 70, 98])
        passage = prose(rng, size)
        at = size // 2
        near = [[*passage[:at], "new", *passage[at:]], [*passage[:at], *passage[at + 1 :]], [*passage[:at], "new", *passage[at + 1 :]]][case % 3]
        a, b = shingles(passage), shingles(near)
        assert len(a & b) >= 0.8 * len(a | b)
        for k, held in enumerate((passage, near)):
            texts.append((2 * case + k, [*prose(rng, 30), *held, *prose(rng, 30)]))
            want[2 * case + k] = len(near) if k else 0
    # Two inserted words in one passage, and an insertion within one text.
    passage = prose(rng, 120)
    near = [*passage[:40], "x", *passage[40:80], "y", *passage[80:]]
    texts += [(900, passage), (901, near), (902, [*(own := prose(rng, 60)), *prose(rng, 20), *own[:30], "z", *own[30:]])]
    want |= {900: 0, 901: 122, 902: 61}
    assert removed(spark, texts) == want


def test_lexical_neighbours_meet_in_a_shard(spark):
    rng = random.Random(7)
    texts = []
    for topic in range(60):
        own = prose(rng, 40)
        texts += [(4 * topic + k, [*rng.sample(own, 36), *rng.choices("the of and to in".split(), k=10)]) for k in range(3)]
        texts.append((4 * topic + 3, texts[-1][1][::-1]))  # the terms of the one before
    size = sum(len(" ".join(t)) for _, t in texts)
    pieces = packing.packed(documents(spark, texts), public_tokenizers.path("byte_bpe_50k.json"), shard_bytes=size // 20).toPandas()
    shard = {p.doc_id: p.sequence_id >> 32 for p in pieces.itertuples()}
    assert len(shard) == 240 and 10 <= len(set(shard.values())) <= 60
    assert all(shard[4 * t + 2] == shard[4 * t + 3] for t in range(60))
    assert sum(shard[4 * t] == shard[4 * t + 1] for t in range(60)) >= 36


def test_common_terms_of_a_seed_count_too():
    texts = [list(range(20)), [*range(12, 20)], [0, 30, 31], [40, 41]]
    terms = [(np.array(t, np.int32), np.ones(len(t), np.int64)) for t in texts]
    index = packing.Index(terms, np.linspace(2, 1, 64).astype(np.float32), 8.0)
    index.free[0] = False
    assert index.neighbours(0).tolist() == [1, 2] and index.neighbours(0, 1).tolist() == [1]


def test_stage_of_similar_documents_takes_five_words(spark):
    rng = random.Random(8)
    base = prose(rng, 100)
    near = [*base[:30], "x", *base[31:70], "y", *base[71:]]  # 0.81 on five words, 0.88 on three
    docs = documents(spark, [(1, base), (2, near), (3, prose(rng, 100))])
    assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_similar(spark, docs, "").collect()) == [1, 3]


def test_large_components_take_part(spark):
    rng = random.Random(9)
    vectors = {i: [rng.uniform(-1, 1) * rng.choice([1, 2e6 if i % 20 == 0 else 4e7]) for _ in range(4)] for i in range(60)}
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in vectors.items()}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.exact_top_k(table, k=5).collect()}
    for q in (0, 20, 40):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in scores[:5]]
    with pytest.raises(ValueError):
        topk.exact_top_k(table.union(spark.createDataFrame([(100, [1e12] * 4)], table.schema)), k=5)


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rng = random.Random(10)
    long, other = prose(rng, 300), prose(rng, 60)
    passage = prose(rng, 70)
    rows = [(1, [*long, *passage]), (1, other), (2, [*passage, *prose(rng, 40)]), (2, other), (None, [*prose(rng, 20), *passage]), (None, prose(rng, 80))]
    out = substring_dedup.deduplicated(documents(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in out) == sorted(
        [(False, 1, 370, 0), (False, 2, 110, 70), (True, 0, 90, 70), (True, 0, 80, 0)]
        + ([(False, 1, 60, 0), (False, 2, 60, 60)] if any(r.doc_id == 1 and r.n_words == 60 and r.n_removed == 0 for r in out) else [(False, 1, 60, 60), (False, 2, 60, 0)])
    )
    assert all(r.component_id in (1, 2) for r in out if r.n_removed)


def test_lines_of_rows_that_share_an_id(spark):
    from basketline.llm import line_dedup

    a, b, c = (" ".join(prose(random.Random(i), 12)) for i in range(3))
    table = spark.createDataFrame([(1, f"{a}\n{b}"), (1, f"{c}\n{a}"), (None, f"{c}\nnew line"), (None, None), (2, b)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in line_dedup.deduplicated(table).collect())
    assert sum(t.split("\n").count(a) for _, _, t in got) == 1 == sum(t.split("\n").count(c) for _, _, t in got)
    assert sum(t.split("\n").count(b) for _, _, t in got) == 1
    assert (True, 0, "new line") in got and (True, 0, "") in got and len(got) == 5


def test_stages_take_rows_without_and_with_repeated_ids(spark):
    """Decisions hold for rows, not for ids: toxic rows without an id go, copies without one go too."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.union(docs.limit(40)).union(docs.limit(60).selectExpr("cast(null as long) doc_id", *docs.columns[1:]))
    stages = dict(corpus_pipeline.STAGES)
    clean = {r.text for r in stages["toxicity"](spark, docs, sf).collect()}
    out = stages["toxicity"](spark, odd, sf).collect()
    assert {r.text for r in out if r.doc_id is None} <= clean and len(out) > len(clean)
    out = stages["ngram_jaccard_join"](spark, odd, sf).collect()
    alone = stages["ngram_jaccard_join"](spark, docs, sf).collect()
    assert sorted(r.doc_id for r in out if (r.text or "").strip()) == sorted(r.doc_id for r in alone if (r.text or "").strip())


def test_similar_passages_with_insertions_and_in_another_order(spark):
    """Recall of passages with a Jaccard similarity of 0.8 or more against brute force, by the words that go."""
    rng = random.Random(11)
    texts, near_of = [], {}
    for case in range(120):
        if case % 3 == 0:  # 9 to 11 words inserted behind 45 to 49 words
            p = prose(rng, rng.randrange(100, 120))
            at = rng.randrange(45, 50)
            near = [*p[:at], *prose(rng, rng.randrange(9, 12)), *p[at:]]
        elif case % 3 == 1:  # blocks of 30 words in another order
            p = prose(rng, 120)
            blocks = [p[i : i + 30] for i in range(0, 120, 30)]
            rng.shuffle(blocks)
            near = [w for b in blocks for w in b]
        else:  # several substitutions
            p = prose(rng, rng.randrange(55, 200))
            near = list(p)
            for i in rng.sample(range(len(p)), max(1, len(p) // 60)):
                near[i] = "new"
        a, b = shingles(p), shingles(near)
        if len(a & b) < 0.8 * len(a | b):
            continue
        texts += [(2 * case, [*prose(rng, 30), *p, *prose(rng, 30)]), (2 * case + 1, [*prose(rng, 30), *near, *prose(rng, 30)])]
        near_of[2 * case + 1] = len(near)
    got = removed(spark, texts)
    found = {kind: [got[i] >= 0.8 * n for i, n in near_of.items() if (i // 2) % 3 == kind] for kind in range(3)}
    assert all(len(f) > 20 for k, f in found.items() if k != 1) and len(found[1]) >= 10
    assert all(sum(f) >= 0.9 * len(f) for f in found.values()), {k: sum(f) / len(f) for k, f in found.items()}
    assert all(got[i - 1] == 0 for i in near_of)


@pytest.mark.parametrize("copies", [1, 70])
def test_similar_passages_that_are_not_the_first_of_their_key(spark, copies):
    """Two passages with their halves in another order, behind documents that hold each half alone."""
    rng = random.Random(17)
    texts, want = [], set()
    for case in range(12 if copies == 1 else 2):
        x, y = prose(rng, 28), prose(rng, 28)
        for half in (x, y):
            for _ in range(copies):
                texts.append((len(texts), prose(rng, 60) + half + prose(rng, 60)))
        for passage in (x + y, y + x):
            texts.append((len(texts), prose(rng, 60) + passage + prose(rng, 60)))
        want.add(texts[-1][0])
    got = removed(spark, texts)
    assert {i for i, n in got.items() if n >= 50} == want
    assert all(n == 0 for i, n in got.items() if i not in want)


def test_places_of_a_diagonal_are_each_tried():
    """A place beside a gap that belongs to no passage, and one behind the gap that does."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    words = rng.integers(0, 2**32, 300).astype("<u4")
    other = rng.integers(0, 2**32, 300).astype("<u4")
    other[100:106], other[125:180] = words[100:106], words[125:180]
    columns = {"doc_id": [2], "from": [0], "near": [words.tobytes()], "other": [1], "other_from": [0], "other_near": [other.tobytes()], "shift": [0], "places": [[100, 126, 127]]}
    (batch,) = pa.table(columns).to_batches()
    found = substring_dedup._verified(batch).to_pylist()
    assert found == [{"doc_id": 2, "start": 125, "stop": 180, "other": 1}]
