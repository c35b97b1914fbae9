"""Edit-aware token counts: segment trees over pre-tokens, re-encoded only where edits touch."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.bpe import Codec, codec
from basketline.llm.common import document_rows

# The pre-tokens of byte-level vocabularies, as published with them.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LOOK_AHEAD = 2  # characters after its end that can decide where a pre-token ends
LEAF = 64  # pre-tokens of a leaf when it is made; a leaf that edits blow up is split again


class TokenTree:
    """A segment tree over the pre-tokens of one text: each node has their characters and tokens.

    Leaves hold runs of pre-tokens (lengths and token counts). An edit finds its leaf by character
    sums, encodes anew from the last boundary that the edit cannot move to the first later boundary that
    old and new text share, and adds the differences to the nodes above.
    """

    def __init__(self, text: str, counts: PieceCounts):
        self.counts = counts
        self.encoded = 0  # characters encoded so far
        lengths, tokens = counts.of(text)
        self.encoded += len(text)
        self._build(lengths, tokens)
        self.text = Rope(text)

    def _build(self, lengths: np.ndarray, tokens: np.ndarray) -> None:
        cuts = range(LEAF, len(lengths), LEAF)
        self.lengths = np.split(lengths, cuts)
        self.tokens = np.split(tokens, cuts)
        self.width = 1 << max(0, (len(self.lengths) - 1).bit_length())
        self.chars = np.zeros(2 * self.width, np.int64)
        self.total = np.zeros(2 * self.width, np.int64)
        n = len(self.lengths)
        self.chars[self.width : self.width + n] = [x.sum() for x in self.lengths]
        self.total[self.width : self.width + n] = [x.sum() for x in self.tokens]
        level = self.width
        while level > 1:
            level //= 2
            for sums in (self.chars, self.total):
                sums[level : 2 * level] = sums[2 * level : 4 * level : 2] + sums[2 * level + 1 : 4 * level : 2]

    @property
    def n_tokens(self) -> int:
        return int(self.total[1])

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf with a character, and where the leaf begins; the last one for the end of the text."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if char - begin >= self.chars[node] and self.chars[node + 1]:
                begin += int(self.chars[node])
                node += 1
        return node - self.width, begin

    def set_leaf(self, leaf: int, lengths: np.ndarray, tokens: np.ndarray) -> None:
        self.lengths[leaf], self.tokens[leaf] = lengths, tokens
        node = leaf + self.width
        chars, total = int(lengths.sum()) - self.chars[node], int(tokens.sum()) - self.total[node]
        while node:
            self.chars[node] += chars
            self.total[node] += total
            node //= 2

    def edit(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` characters from ``start`` on; both are cut to the text."""
        start = min(max(start, 0), self.n_chars)
        length = min(max(length, 0), self.n_chars - start)
        first, begin = self.leaf_at(max(0, start - LOOK_AHEAD))
        # Boundaries in the first leaf that the edit cannot move.
        ends = begin + np.cumsum(self.lengths[first])
        keep = int(np.searchsorted(ends, start - LOOK_AHEAD, "right"))
        at = int(ends[keep - 1]) if keep else begin
        if not keep and first:  # the leaf before ends here; its last pre-token may join
            first -= 1
            begin -= int(self.chars[first + self.width])
            keep = max(0, len(self.lengths[first]) - 1)
            at = begin + int(self.lengths[first][:keep].sum())
        self.text.replace(start, length, insert)
        shift = len(insert) - length
        # Old boundaries from the end of the edit on, leaf by leaf.
        last, last_begin = self.leaf_at(min(start + length, max(0, self.n_chars - 1)))
        last, last_begin = max((last, last_begin), (first, begin))
        made: list[tuple[int, int]] = []
        position, old_end = at, self.n_chars
        bounds = {last_begin + int(e): i + 1 for i, e in enumerate(np.cumsum(self.lengths[last])) if last_begin + e >= start + length}
        if start + length <= last_begin:
            bounds[last_begin] = 0
        rest = 0
        for size, n in self.counts.stream(self.text, at):
            made.append((size, n))
            position += size
            old = position - shift
            while old > last_begin + self.chars[last + self.width] and last + 1 < len(self.lengths):
                last_begin += int(self.chars[last + self.width])
                last += 1
                bounds = {last_begin + int(e): i + 1 for i, e in enumerate(np.cumsum(self.lengths[last]))}
            if old >= start + length and old in bounds and old < old_end:
                rest = bounds[old]
                break
        else:
            last, rest = len(self.lengths) - 1, len(self.lengths[-1])
        self.encoded += position - at
        sizes = np.array([m[0] for m in made], np.int64)
        tokens = np.array([m[1] for m in made], np.int64)
        tail = (self.lengths[last][rest:], self.tokens[last][rest:])
        new = (
            np.concatenate([self.lengths[first][:keep], sizes, tail[0]]),
            np.concatenate([self.tokens[first][:keep], tokens, tail[1]]),
        )
        none = np.zeros(0, np.int64)
        for leaf in range(first + 1, last + 1):
            self.set_leaf(leaf, none, none)
        self.set_leaf(first, *new)
        if len(new[0]) > 16 * LEAF:  # keep leaves short
            self._build(np.concatenate(self.lengths), np.concatenate(self.tokens))


class Rope:
    """A text in chunks, so that an edit copies one chunk and not the text."""

    SIZE = 4096

    def __init__(self, text: str):
        self.chunks = [text[i : i + self.SIZE] for i in range(0, len(text), self.SIZE)] or [""]

    def _at(self, char: int) -> tuple[int, int]:
        for k, chunk in enumerate(self.chunks):
            if char < len(chunk):
                return k, char
            char -= len(chunk)
        return len(self.chunks) - 1, len(self.chunks[-1])

    def replace(self, start: int, length: int, insert: str) -> None:
        a, i = self._at(start)
        b, j = self._at(start + length)
        new = self.chunks[a][:i] + insert + self.chunks[b][j:]
        self.chunks[a : b + 1] = [new[k : k + self.SIZE] for k in range(0, len(new), self.SIZE)] or [""]

    def read(self, start: int, size: int) -> str:
        a, i = self._at(start)
        out = [self.chunks[a][i:]]
        have = len(out[0])
        while have < size and a + 1 < len(self.chunks):
            a += 1
            out.append(self.chunks[a])
            have += len(self.chunks[a])
        return "".join(out)[:size]

    def __str__(self) -> str:
        return "".join(self.chunks)


class PieceCounts:
    """Pre-tokens of a text and how many tokens each has."""

    def __init__(self, words: Codec):
        self.words = words

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Lengths in characters and token counts of all pre-tokens."""
        pieces = PATTERN.findall(text)
        return np.fromiter(map(len, pieces), np.int64, len(pieces)), self._tokens(pieces)

    def _tokens(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter((_tokens_of(self.words, p) for p in pieces), np.int64, len(pieces))

    def stream(self, text: Rope, start: int):
        """(length, tokens) of the pre-tokens from a boundary on, read as far as they are asked for."""
        size = 256
        while True:
            window = text.read(start, size)
            whole = len(window) < size
            done = 0
            for found in PATTERN.finditer(window):
                if not whole and found.end() + LOOK_AHEAD >= len(window):
                    break  # more text could move this end
                yield found.end() - found.start(), _tokens_of(self.words, found.group())
                done = found.end()
            if whole:
                return
            start += done
            size = size * 2 if not done else 256


@lru_cache(maxsize=1 << 18)
def _tokens_of(words: Codec, piece: str) -> int:
    return len(words.pieces.encode_single_piece(piece.encode()))


def edited_counts(documents: DataFrame, edits: DataFrame, tokenizer: str) -> DataFrame:
    """One row per document: doc_id, n_tokens before, n_edits, n_tokens_after, n_chars_after, n_encoded.

    ``edits`` has (doc_id, seq, start, length, insert): in the order of seq (then start, length, insert), ``length``
    characters from ``start`` on give way to ``insert``; positions are those of the text as it then is and are
    cut to it, nulls are 0 or empty. Token counts are those of a byte-level BPE file; strings of special
    tokens count as ordinary text. n_encoded is how many characters the edits made the tree encode
    again. Null texts are empty. Edits without a document are ignored; rows that share a doc_id
    each get all its edits.
    """
    one = F.struct(
        F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("seq"), F.coalesce(F.col("start").cast("long"), F.lit(0)).alias("start"),
        F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"), F.coalesce(F.col("insert").cast("string"), F.lit("")).alias("insert"),
    )
    lists = edits.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.sort_array(F.collect_list(one)).alias("edits"))
    return counted(document_rows(documents).join(lists, "doc_id", "left"), tokenizer)


def counted(rows: DataFrame, tokenizer: str) -> DataFrame:
    """As ``edited_counts``, for rows (doc_id, text, edits) that have their edits in order; nulls are 0 or empty here too."""

    def run(batches):
        counts = PieceCounts(codec(tokenizer))
        for big in batches:
            for batch in X.slices(big, "text"):
                out = []
                for doc, text, edits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "edits"))):
                    tree = TokenTree(text, counts)
                    before, read = tree.n_tokens, tree.encoded
                    for e in edits or []:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["insert"] or "")
                    out.append((doc, before, len(edits or []), tree.n_tokens, tree.n_chars, tree.encoded - read))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=_NAMES)

    return rows.select("doc_id", "text", "edits").mapInArrow(run, ", ".join(f"{n} long" for n in _NAMES))


_NAMES = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_encoded"]


def own_edits(documents: DataFrame) -> DataFrame:
    """doc_id, text and four edits of each document made from its own text.

    The word-like stretch in the middle goes, a piece from the first third is put in at two thirds, the
    beginning is replaced, and a stretch of white space and digits is appended. A null doc_id makes the
    edits of doc_id 0.
    """
    n = F.length("text")
    own = F.coalesce("doc_id", F.lit(0))
    third = F.floor(n / 3).cast("long")
    edit = lambda seq, start, length, insert: F.struct(
        F.lit(seq).cast("long").alias("seq"), start.cast("long").alias("start"), length.cast("long").alias("length"), insert.alias("insert")
    )
    edits = F.array(
        edit(1, F.floor(n / 2), F.pmod(own, F.lit(17)) + 1, F.lit("")),
        edit(2, third * 2, F.lit(0), F.substr("text", third + 1, F.pmod(own, F.lit(40)) + 5)),
        edit(3, F.lit(0), F.lit(3), F.concat(F.lit("Re: "), F.substr("text", F.lit(1), F.lit(2)))),
        edit(4, n * 2, F.lit(0), F.lit("  \n 2024 end")),
    )
    return document_rows(documents).select("doc_id", "text", edits.alias("edits"))
