"""BPE encoding and decoding of whole documents by a segment tree over adjacent pair ranks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketline.llm import textcodes as X
from basketline.llm.bpe import codec
from basketline.llm.common import document_rows


def bpe_digests(documents: DataFrame, tokenizer: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``tokenizer`` is the path of a BPE file with word ends, the same on every executor. Ids are those
    of the file's own library without special tokens; they are hashed as little-endian unsigned
    32-bit integers. Decoding joins the strings of the ids by spaces, as a file without decoder
    does. A null or empty text has no tokens and the hash of nothing. Every row counts: repeated
    rows give repeated results, a null doc_id stays null.
    """

    def run(batches):
        words = codec(tokenizer)
        for big in batches:
            for batch in X.slices(big, "text"):
                n, ids, decoded = [], [], []
                for slots in words.slots(batch.column("text").to_pylist()):
                    flat = words.expand(slots)
                    n.append(len(flat))
                    ids.append(hashlib.sha256(flat.astype("<u4").tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(b" ".join(words.names_of(slots))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return document_rows(documents).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encoded(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the ids themselves, as an array."""

    def run(batches):
        words = codec(tokenizer)
        for big in batches:
            for batch in X.slices(big, "text"):
                flat = [words.expand(s).astype(np.int32) for s in words.slots(batch.column("text").to_pylist())]
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in flat])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return document_rows(documents).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the text that the ids of ``encoded`` stand for: words apart by single spaces."""

    def run(batches):
        names = codec(tokenizer).names
        to_byte = codec(tokenizer).to_byte
        for batch in batches:
            out = []
            for row in batch.column("ids").to_pylist():
                shown = b"".join(names[i] for i in row or []).decode().replace("</w>", " ").rstrip(" ")
                out.append(b" ".join(bytes(to_byte[c] for c in w) for w in shown.split(" ")).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
