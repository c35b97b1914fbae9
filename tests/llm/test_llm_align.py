"""Alignment of two tokenizers against the libraries and plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from basketline.llm import align
from basketline.llm.bpe import SAFE

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute_force(libraries, rows):
    """The contract, token by token."""
    a, b = libraries
    names = a.get_vocab()
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(0x100, 0x200))
    byte = {(chr(x) if x in shown else chr(next(extra))): x for x in range(256)}
    bytes_a = {i: bytes(byte[c] for c in t) for t, i in names.items() if all(c in byte for c in t)}

    def of_b(i):
        p = b.id_to_piece(i)
        m = re.fullmatch("<0x([0-9A-F]{2})>", p)
        return bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        if b"".join(bytes_a[i] for i in ids_a) != raw or b"".join(map(of_b, ids_b)) != raw:
            ids_a, ids_b = [], []
        at, end_a, end_b = 0, {}, {}
        for k, i in enumerate(ids_a):
            at += len(bytes_a[i])
            end_a[at] = k
        at = 0
        for k, i in enumerate(ids_b):
            at += len(of_b(i))
            end_b[at] = k
        both = sorted(set(end_a) & set(end_b))
        links = [(ids_a[end_a[e]], ids_b[end_b[e]]) for e in both]
        i = j = 0
        groups = []
        for e in both:
            groups.append(",".join(map(str, ids_a[i : end_a[e] + 1])) + "|" + ",".join(map(str, ids_b[j : end_b[e] + 1])))
            i, j = end_a[e] + 1, end_b[e] + 1
        counts.update(links)
        docs.append((doc_id, len(ids_a), len(ids_b), links, ";".join(groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (d, n_a, n_b, len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(g.encode()).hexdigest() if n_a else "")
        for d, n_a, n_b, links, g in docs
    ]


TEXTS = [
    None, "", " ", "   ", "\n", "a", "two words", "two words", "  leading and  double   spaces  ", "x▁y and ▁ z",
    "<|endoftext|> and <s></s> <unk> <0x41>", "tabs\tand\r\nlines\n\n\nend\n", "don't won't I'll", "café naïve слово 日本語 \U0001f600   x",
    "é ﬁ ① \x00 \x85   ﻿", "12345 3.14 1,000 ====---- ___", "z" * 700, "word " * 3000,
]


def test_digests_match_brute_force(spark, libraries):
    rng = random.Random(1)
    letters = "etaoinsrhldcumf  ,.'-0123\näößаб中"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(400))) for _ in range(60)]
    rows = [*enumerate(texts), (None, "no id"), (3, "an id twice")]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, codes string, n_a int, a_ids int")
    got = [tuple(r) for r in align.alignment_digests(docs, A, B).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=lambda r: str(key(r))) == sorted(brute_force(libraries, rows), key=lambda r: str(key(r)))


def test_alignments_give_back_the_text(spark, libraries):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in align.alignments(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()}
    a, b = libraries
    for i, text in rows:
        r = got[i]
        if not text or "▁" in text:
            assert not r.a_ids and not r.b_ids and not r.ends
            continue
        assert r.a_ids == a.encode(" " + text, add_special_tokens=False).ids and r.b_ids == b.encode(text)
        assert (r.a_cuts[-1], r.b_cuts[-1], r.ends[-1]) == (len(r.a_ids), len(r.b_ids), len((" " + text).encode()))


def test_empty_table(spark):
    assert align.alignment_digests(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_every_safe_character_as_the_library(libraries):
    a, b = libraries
    both = align.pair(A, B)
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)} '{chr(c)}" for span in SAFE for c in span]
    ids_a, n_a, ids_b, n_b = both(texts)
    for text, x, y in zip(texts, np.split(ids_a, np.cumsum(n_a)), np.split(ids_b, np.cumsum(n_b))):
        assert x.tolist() == a.encode(" " + text, add_special_tokens=False).ids
        assert y.tolist() == b.encode(text)


@pytest.mark.parametrize("work", [1, 2, 3, 7, 64])
def test_overlaps_against_all_pairs(work):
    rng = np.random.default_rng(work)
    for _ in range(40):
        top = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(top) < rng.random()) , top) for _ in range(2))
        a, b = np.unique(a[a > 0]), np.unique(b[b > 0])
        in_a, in_b, group, cut = align.overlaps(a, b, work)
        starts_a, starts_b = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts_a[i], starts_b[j]) < min(a[i], b[j])]
        assert list(zip(in_a.tolist(), in_b.tolist())) == want
        cuts = np.intersect1d(a, b)
        assert group.tolist() == [int(np.searchsorted(cuts, min(a[i], b[j]))) for i, j in want]
        assert cut.tolist() == [a[i] == b[j] for i, j in want]
        i, j = align.diagonals(a, b, work)
        assert (np.diff(i + j)[:-1] == work).all() and (i[-1], j[-1]) == (len(a), len(b))
