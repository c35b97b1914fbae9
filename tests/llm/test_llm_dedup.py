"""Near-duplicate operators against brute force, and their odd inputs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketline.llm import common, jaccard_join, lattice, line_dedup, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id int, n_removed int, spans string"


def docs(spark, texts):
    """Documents with columns whose names clash with those the operators use."""
    rows = [(i, t, "en", "s", len(t or ""), "k", 1, 2, "x") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, words=600):
    return " ".join(f"w{int(rng.paretovariate(0.3)) % words}x{rng.randrange(40)}" for _ in range(n))


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}


def shingle_set(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    texts = [(i, prose(rng, rng.choice([1, 2, 3, 12, 40, 120, 300]))) for i in range(60)]
    base = prose(rng, 200).split()
    for i in range(60, 100):  # near copies, some of them only through others
        own = list(base)
        for _ in range(rng.randrange(7)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
        texts.append((i, " ".join(own)))
    texts += [(100 + i, texts[i][1].upper()) for i in range(5)]
    return texts + [(200, None), (201, ""), (202, " \n\t "), (203, texts[0][1])]


def test_jaccard_classes_are_exact(spark, corpus):
    sets = {i: shingle_set(t, 3) for i, t in corpus}
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    want = roots(ids, links)
    got = jaccard_join.jaccard_classes(docs(spark, corpus)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in ids}
    assert len(set(want.values())) < len(ids) - 20


def test_band_and_bucket_bounds():
    low, buckets = jaccard_join.bands(90, 100, 5000)
    for n in range(1, 4000):
        most = n * 10 // 9
        a, b = (max(i for i in range(len(low)) if low[i] <= x) for x in (n, most))
        assert b - a <= 1
        assert buckets[b] > (n + most) * 10 // 190


def test_unlike_sets_share_no_key():
    rng = np.random.default_rng(5)
    keys = [jaccard_join.tile_keys(np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)), 80, 100) for n in rng.integers(20, 500, 300)]
    _, times = np.unique(np.concatenate(keys), return_counts=True)
    assert (times > 1).sum() == 0


@pytest.mark.parametrize("num, den", [(80, 100), (90, 100), (50, 100)])
def test_similar_sets_share_a_key(num, den):
    rng = np.random.default_rng(6)
    codes = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
    for n in [*range(1, 60), *rng.integers(60, 900, 60).tolist()] * 4:
        both = codes(n)
        differ = n * (den - num) // num
        x = int(rng.integers(0, differ + 1))
        a, b = (np.sort(np.concatenate([both, codes(k)])) for k in (x, differ - x))
        assert n * den >= (n + differ) * num
        assert np.intersect1d(jaccard_join.tile_keys(a, num, den), jaccard_join.tile_keys(b, num, den)).size


def test_small_groups_give_each_pair_once():
    rng = np.random.default_rng(7)
    sizes = np.where(np.arange(400) % 40 == 0, 60, 5)
    key = np.repeat(np.arange(400), sizes)
    n = len(key)
    ids = rng.integers(0, 500, n)
    other = rng.integers(0, 2, n) * (key % 7 == 0)
    found = pa.table({"key": key, "id": ids, "lo": np.zeros(n, int), "hi": other, "own": other})
    x, y, rest = common.small_pairs(found, ids % 3)
    groups = {}
    for i in range(n):
        groups.setdefault((key[i], other[i]), []).append(i)
    small = {k: g for k, g in groups.items() if len(g) <= common.SMALL and k[1] == 0}
    want = {tuple(sorted((ids[i], ids[j]))) for g in small.values() for i in g for j in g if ids[i] % 3 != ids[j] % 3}
    got = [tuple(sorted((ids[i], ids[j]))) for i, j in zip(x, y)]
    assert set(got) == want and len(got) == len(want) > 100
    assert sorted(rest.tolist()) == sorted(i for k, g in groups.items() if k not in small for i in g)


def test_repeated_and_null_ids(spark):
    rows = docs(spark, [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "A B C D")])
    got = sorted(jaccard_join.jaccard_classes(rows).collect(), key=lambda r: r.doc_id or 0)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(None, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_empty_tables(spark):
    none = docs(spark, [])
    assert jaccard_join.jaccard_classes(none).count() == 0
    assert line_dedup.line_digests(none).count() == 0
    assert substring_dedup.passage_digests(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert lattice.near_vectors(vectors).count() == 0


def byte_shingles(line, k=8):
    raw = line.encode()
    return {raw[i : i + k] for i in range(len(raw) - k + 1) if raw[i] & 0xC0 != 0x80} or {raw}


def test_lines_against_brute_force(spark):
    rng = random.Random(9)
    lines = [prose(rng, rng.choice([1, 3, 10, 25])) for _ in range(60)] + ["é" * 30, "ü ö ä", "x", "xy"]
    for line in lines[:25]:
        w = line.split()
        w[rng.randrange(len(w))] = "q"
        lines.append(" ".join(w))
    texts = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    texts += [(90, None), (91, ""), (92, "\n\n"), (93, "  x  \n\nx")]
    places = {}
    for i, t in sorted(texts):
        for j, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                places.setdefault(line.strip(" "), []).append((i, j))
    sets = {x: byte_shingles(x) for x in places}
    names = sorted(places)
    links = [
        (a, b)
        for k, a in enumerate(names)
        for b in names[k + 1 :]
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    group = roots(names, links)
    keep = {}
    for x, at in places.items():
        keep[group[x]] = min([*at, keep.get(group[x], at[0])])
    keep = set(keep.values())
    want = {
        i: "\n".join(x for j, x in enumerate((t or "").split("\n")) if not x.strip(" ") or (i, j) in keep) for i, t in texts
    }
    out = line_dedup.deduplicated(docs(spark, texts))
    assert out.columns == [*docs(spark, []).columns, "n_lines", "n_removed_"]
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert links


def test_passages_go_but_for_the_first(spark):
    rng = random.Random(3)
    passage, short = prose(rng, 70), prose(rng, 40)
    near = passage.split()
    near[33] = "other"
    texts = [(i, prose(rng, 150)) for i in range(8)]

    def inside(i, what):
        w = texts[i][1].split()
        texts[i] = (i, " ".join([*w[:50], what, *w[50:]]))
        return " ".join(w)

    rest = {i: inside(i, passage) for i in (2, 5, 6)}
    rest[7] = inside(7, " ".join(near))
    for i in (0, 1):
        inside(i, short)
    texts += [(20, None), (21, ""), (22, texts[3][1]), (23, "la " * 400)]
    rows = docs(spark, texts)
    out = {r.doc_id: r for r in substring_dedup.deduplicated(rows).collect()}
    given = dict(texts)
    assert all(out[i].text == given[i] for i in (0, 1, 2, 3, 4, 21)) and out[20].text == ""
    for i in (5, 6, 7):
        assert out[i].text.split() == rest[i].split()
        assert out[i].component_id == 2 and out[i].n_removed_ == 70
    assert out[22].text.split() == [] and out[22].component_id == 3
    assert 0 < len(out[23].text.split()) < 120


def test_window_minima_cover_every_passage():
    import numpy as np

    from basketline.llm import textcodes as X

    rng = np.random.default_rng(1)
    for alphabet in (3, 50, 10**6):
        codes = X.mix(rng.integers(0, alphabet, 500).astype(np.uint64))
        at = substring_dedup.minima(codes)
        for s in range(len(codes) - substring_dedup.WINDOW + 1):
            w = codes[s : s + substring_dedup.WINDOW]
            assert any(codes[a] == w.min() for a in at[(at >= s) & (at < s + len(w))].tolist())


def test_vectors_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    vectors = [*base, *(base[:30] + 0.05 * rng.normal(size=(30, 16))), *(base[:20] * 3.0), *base[:10]]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    rows += [(200, None, 0), (201, [], 0), (202, [0.0] * 16, 0), (203, [float("nan")] * 16, 0), (204, [1.0, None], 0), (205, [1.0, 2.0], 0), (206, [2.0, 4.0], 0)]
    m = np.array(vectors)
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = m @ m.T >= 0.95
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)))] + [(205, 206)]
    want = roots([r[0] for r in rows], links)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1))
    got = {r.vec_id: r for r in lattice.near_vectors(table).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    count = {i: sum(i in x for x in links) for i in want}
    assert {i: r.n_links for i, r in got.items()} == count
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_lattice_points():
    import numpy as np

    x = np.random.default_rng(0).normal(size=(200, 8)) * 2
    p = lattice.nearest_point(x)
    # A point of E8: all whole or all halves, with an even sum; no neighbour is closer.
    assert np.allclose(p * 2, np.rint(p * 2)) and (np.abs(p.sum(1) % 2) < 1e-9).all()
    near = ((x[:, None] - (p[:, None] + lattice.neighbours()[None])) ** 2).sum(2)
    assert (near >= ((x - p) ** 2).sum(1)[:, None] - 1e-9).all()


def test_recall_at_the_threshold():
    import numpy as np

    rng = np.random.default_rng(5)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(1)[:, None] * a
    o /= np.linalg.norm(o, axis=1)[:, None]
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * o
    (x, px), (y, py) = (lattice.cells(v, 12, 2, 1.8, 6) for v in (a, b))
    met = (x == y) | (px == y[:, :, None]).any(2) | (py == x[:, :, None]).any(2)
    assert met.any(1).mean() > 0.97


def test_components_over_many_parts(spark):
    from basketline.llm.common import components

    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(500, rng.randrange(501, 900)) for _ in range(300)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(150)]
    want = roots({x for e in links for x in e}, links)
    edges = spark.createDataFrame(links, "a long, b long")
    for part in (1000, 60):
        got = [tuple(r) for r in components(edges, part).collect()]
        assert dict(got) == {i: c for i, c in want.items() if (i, i) not in links or list(want.values()).count(c) > 1}
        assert len(got) == len(dict(got))
