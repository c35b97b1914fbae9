"""From raw documents to packed training sequences, in stages written as tables.

Each stage reads what the one before it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline.llm import jaccard_join, line_dedup, packing, substring_dedup, toxicity
from basketline.llm.common import dropped, fresh, identified, scratch, table, with_facts


def _with_text(documents: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, n_chars measured anew."""
    kind = documents.schema["n_chars"].dataType if "n_chars" in documents.columns else None
    size = F.length("text").cast(kind).alias("n_chars") if kind else None
    return documents.select(*[size if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of this table, does not call toxic; row by row."""
    score = toxicity.scorer(docs, table(spark, sf_dir, "labels"))
    return docs.where(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each class of alike lines stays; documents that had only others' lines go."""
    rows = line_dedup.deduplicated(docs)
    rows = rows.where(~((F.trim("text") == "") & (F.col(fresh(docs.columns, "n_removed")) > 0)))
    return _with_text(rows, docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each class of documents with a Jaccard similarity of 0.8 on five-word shingles stays.

    Rows without doc_id and further rows of a doc_id take part behind all others.
    """
    rows, key, _ = identified(docs)
    texts = rows.select(F.col(key).alias("doc_id"), "text")
    drop = fresh(rows.columns, "drop")
    copies = jaccard_join.jaccard_classes(texts, shingle=5, num=80, den=100).where("not kept").select(F.col("doc_id").alias(drop))
    return with_facts(rows, copies, key).where(F.col(drop).isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out."""
    return _with_text(substring_dedup.deduplicated(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

# A learned classifier, MinHash classes and a tokenizer: SQL has no equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written as Parquet and read again, and its input is deleted then."""
    given = docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch(spark) as keep:
            out = keep(stage(spark, docs, sf_dir))
        if docs is not given:
            dropped(docs)
        docs = out
    return docs
