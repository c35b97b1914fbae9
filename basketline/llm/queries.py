"""One query per operator over its whole table, and the DuckDB equivalents where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketline.llm import (
    align, bpe_codes, edit_counts, hard_negatives, html_content, jaccard_join, lattice, line_dedup, packing, records, substring_dedup, topk, toxicity,
)
from basketline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op9_ngram_jaccard(spark, sf_dir):
    """Documents with a Jaccard similarity of 0.9 on three-word shingles."""
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"), shingle=3, num=90, den=100)


@query
def op2_e8_lattice(spark, sf_dir):
    """Vectors with a cosine of 0.95 or more."""
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op5_bpe_segment_tree(spark, sf_dir):
    """Ids and decoded text of every document, as digests."""
    return bpe_codes.bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_bm25_packing(spark, sf_dir):
    """All documents in sequences of 2048 ids, with lexical neighbours side by side."""
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_histogram_topk(spark, sf_dir):
    """The 20 highest integer inner products of every twentieth vector."""
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


ORACLES["op6_histogram_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 20 = 0
), r AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


ORACLES["op2_e8_lattice"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, other) AS (
    SELECT a, b FROM link
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other
), least AS (
    SELECT vec_id, min(other) AS other FROM reach GROUP BY vec_id
), degree AS (
    SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.other, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.other, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d USING (vec_id) LEFT JOIN least l USING (vec_id)
"""


@query
def op8_nnpu_toxicity(spark, sf_dir):
    """A toxicity score for every document, learned outside the held-out fold."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_tree_model_text(spark, sf_dir):
    """The main text of every page."""
    return html_content.main_texts(table(spark, sf_dir, "pages"))


@query
def op3_fuzzy_lines(spark, sf_dir):
    """Documents after fuzzy line dedup, as digests."""
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


@query
def op1_paragraph_minhash(spark, sf_dir):
    """Documents without the passages that earlier ones have, as digests."""
    return substring_dedup.passage_digests(table(spark, sf_dir, "documents"))


@query
def op4_edit_aware_counts(spark, sf_dir):
    """Token counts of every document before and after edits, encoded again only where they touch."""
    rows = edit_counts.own_edits(table(spark, sf_dir, "documents"))
    return edit_counts.counted(rows, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_merge_path_alignment(spark, sf_dir):
    """Tokens of a byte-level and of a sentencepiece tokenizer aligned by their ends, as digests."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.alignment_digests(table(spark, sf_dir, "documents"), *paths)


@query
def op11_binary_records(spark, sf_dir):
    """Ids of every document written to record files and read back, as digests."""
    return records.record_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_rtree_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector and its five best vectors of the same label."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op13_rtree_negatives"] = """
WITH v AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.v)
    WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM s WHERE same
), n AS (
    SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM p JOIN s USING (anchor_id)
    WHERE place <= 5 AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
