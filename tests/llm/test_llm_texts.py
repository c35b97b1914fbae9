"""Tokenizers, packing, edits, search, pages and toxicity against their libraries or brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketline.llm import bpe, bpe_codes, edit_counts, html_content, html_tree, packing, topk, toxicity

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a", "a  ", "\n\n b\t c  \n", "it's don't 'tis we'll ''s !'s", "<|endoftext|> x <|startoftext|>", "ÀÉÎ ßẞ İı ŉ",
    "é àb", "日本語 テスト 123 ４５", "a b　c", "x\0y \0", "1234 12ab ½²", "Ως ΑΣ σς", "a​b", "😀 hi 😀😀",
    "\x1c\x1d a\x85b", "the\r\nend", "lonely" * 300,
]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, start int")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_those_of_the_library(path):
    rng = random.Random(2)
    alphabet = " \n\t'abcSTvd12é!?.-<|ÉßΣя́ "
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    library, own = Tokenizer.from_file(path), bpe.codec(path)
    for text, slots in zip(texts, own.slots(texts)):
        assert own.expand(slots).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_texts_are_cut_where_white_space_begins(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    text = "one two  three\n\nfour don't 12 " * 40
    own = bpe.codec(BYTE)
    assert own.expand(own.slots([text])[0]).tolist() == Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids


def test_digests_and_round_trip(spark):
    library = Tokenizer.from_file(WORD)
    rows = documents(spark, [*ODD, None])
    got = {r.doc_id: r for r in bpe_codes.bpe_digests(rows, WORD).collect()}
    for i, text in enumerate([*ODD, ""]):
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    plain = documents(spark, ["the quick brown fox", "ça va , très bien", None])
    back = {r.doc_id: r.text for r in bpe_codes.decoded(bpe_codes.encoded(plain, WORD), WORD).collect()}
    assert back == {0: "the quick brown fox", 1: "ça va , très bien", 2: ""}
    assert bpe_codes.bpe_digests(rows.limit(0), WORD).count() == 0


def test_packing_holds_every_id_once(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(rng.choice([0, 1, 30, 900, 5000]))) for _ in range(120)]
    texts += [None, *ODD]
    rows = documents(spark, texts)
    rows = rows.union(rows.where("doc_id = 1")).union(rows.where("doc_id = 2").withColumn("doc_id", F.lit(None)))
    library = Tokenizer.from_file(BYTE)
    pieces = packing.packed(rows, BYTE, shard_bytes=20_000).toPandas()
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        own = pieces[pieces.doc_id == i].sort_values(["sequence_id", "offset"])
        assert own.length.sum() == len(ids) * (2 if i == 1 else 1) and (own.doc_tokens == len(ids)).all()
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 2048 and s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]]
    assert (pieces.groupby("sequence_id").length.sum() < 2048).sum() <= pieces.sequence_id.floordiv(1 << 32).nunique()
    assert packing.packed(rows.limit(0), BYTE).count() == 0


def test_neighbours_come_by_bm25():
    docs = [[1, 2, 3], [1, 2, 9], [1, 7, 8], [4, 5, 6], [2, 3, 1]]
    terms = [(np.unique(np.array(d, np.int32)), np.ones(len(d), np.int64)) for d in docs]
    idf = np.linspace(2, 1, 16).astype(np.float32)
    index = packing.Index(terms, idf, 3.0)
    index.free[0] = False
    assert index.neighbours(0).tolist() == [4, 1, 2]
    index.free[4] = False
    assert index.neighbours(0).tolist() == [1, 2]


def test_edits_count_as_a_fresh_encoding(spark):
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    rng = random.Random(5)
    alphabet = "  \n\tabcdeé'sSt12.,!? "
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    texts = {i: make(rng.choice([0, 5, 100, 3000])) for i in range(40)} | {98: ODD[5], 99: None}
    edits, want = [], {}
    for i, text in texts.items():
        text = text or ""
        before = len(library.encode(text, add_special_tokens=False).ids)
        for k in range(6):
            a, n, new = rng.randrange(len(text) + 3), rng.choice([0, 0, 1, 3, 50, 1000]), make(rng.choice([0, 1, 4, 30, 900]))
            edits.append((i, k, a, n, new))
            a = min(a, len(text))
            text = text[:a] + new + text[a + n :]
        want[i] = (before, 6, len(library.encode(text, add_special_tokens=False).ids), len(text))
    rows = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, edits int")
    changes = spark.createDataFrame([*edits, (None, 0, 0, 1, "x"), (500, 0, 0, 1, "x")], "doc_id long, seq int, start int, length int, insert string")
    got = {r.doc_id: (r.n_tokens, r.n_edits, r.n_tokens_after, r.n_chars_after) for r in edit_counts.edited_counts(rows, changes, BYTE).collect()}
    assert got == want
    none = {r.doc_id: r.n_edits for r in edit_counts.edited_counts(rows, changes.where("doc_id = 500"), BYTE).collect()}
    assert set(none.values()) == {0}


def test_an_edit_encodes_little_of_a_long_text():
    tree = edit_counts.TokenTree("some words and more of them\n" * 20_000, edit_counts.PieceCounts(bpe.codec(BYTE)))
    before = tree.encoded
    tree.edit(280_000, 3, "other")
    assert tree.encoded - before < 200


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(260, 6)), 2)
    v[100:180] = v[0]  # ties over many ids
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(400, None), (420, [float("inf")] * 6), (440, [1.0] * 3), (441, [2.0] * 3), (500, [None] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("tile", F.lit("x"))
    q = np.floor(64 * v).astype(int)
    want = []
    for i in range(0, 260, 20):
        scores = q @ q[i]
        best = sorted((j for j in range(260) if j != i), key=lambda j: (-scores[j], j))[:20]
        want += [(i, r + 1, j, int(scores[j])) for r, j in enumerate(best)]
    want.append((440, 1, 441, 64 * 128 * 3))
    got = topk.exact_top_k(table, block_rows=50, query_rows=4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert topk.exact_top_k(table.limit(0)).count() == 0


@pytest.fixture(scope="module")
def model():
    return html_content.trained()


def test_held_out_pages(model):
    rng = random.Random(77)
    wrong = runs = 0
    for _ in range(100):
        tree, labels = html_content.labelled(html_tree.labelled_page(rng))
        kinds = ["#text" if t == "#text" else "block" for t in tree.tag]
        belief = model.marginals(tree.parent, kinds, [model.score(f) for f in html_content.node_features(tree)])
        for t, y, b in zip(tree.tag, labels, belief):
            if t == "#text":
                runs += 1
                wrong += (b >= 0) != y
    assert wrong < 0.03 * runs


def test_marginals_are_those_of_all_states(model):
    parent, kinds, unary = [-1, 0, 0, 1], ["block", "block", "#text", "#text"], [0.3, -1.0, 0.7, 2.0]
    weights = {}
    for state in np.ndindex(2, 2, 2, 2):
        e = sum(u for u, s in zip(unary, state) if s) + sum(model.edges[kinds[i]][state[parent[i]]][state[i]] for i in range(1, 4))
        weights[state] = np.exp(e)
    belief = model.marginals(parent, kinds, unary)
    for i in range(4):
        p = sum(w for s, w in weights.items() if s[i]) / sum(weights.values())
        assert abs(1 / (1 + np.exp(-belief[i])) - p) < 1e-9


def test_pages(spark, model):
    page = (
        "<html><head><title>T</title><script>var t='</p>'</script></head><body><nav><ul><li><a href=x>A</a></li></ul></nav>"
        "<article><h1>Big &amp; new</h1><p>One <b>two<br>three<p>caf&eacute;\n  4 &lt; 5</article><div class='comments'><p>me too, I think</p></div>"
        "<footer>&copy; x</footer></body>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "v", "<p"), (1, "u", page), (5, "w", "<div>" * 3000 + "x")]
    got = html_content.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)), model).collect()
    assert len(got) == 6
    assert [r.text for r in got if r.page_id == 1] == ["Big & new\n\nOne two three\n\ncafé 4 < 5"] * 2
    assert all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (2, 3)] == ["", ""]


def test_toxicity_on_the_held_out_fold(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, labels = [], []
    for i in range(900):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = "nasti" + rng.choice(["o", "a", "es", "."])
        texts.append((i, " ".join(words), "x"))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic), "x"))
    texts += [(1000, None, "x"), (1001, "", "x"), (None, "w1", "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 0, 1, "x"), (5000, 0, None, "x")], "doc_id long, quality int, toxic int, kind string")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, marks).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(900)) and got[None].held_out is None
    held = [(got[i].predicted, t) for i, _, t, _ in labels if got[i].held_out]
    assert sum(p == t for p, t in held) > 0.95 * len(held)
    assert got[1000].score == got[1001].score and got[1001].predicted == 0
    assert {r.score for r in toxicity.toxicity_scores(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity_scores(docs.limit(0), marks).count() == 0
