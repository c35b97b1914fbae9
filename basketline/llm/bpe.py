"""Byte-pair encoding with the files of public tokenizers, a whole batch of texts at a time.

Texts are cut into pre-tokens by numpy over their code points; every distinct pre-token is encoded
once per worker and remembered by its hash. Texts with characters outside the tables, with
contractions or with the strings of special tokens are cut by the library itself.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from basketline.llm import textcodes as X

# Code points that normalisation maps one by one and never joins with their neighbours: Latin, Greek
# and Cyrillic letters, general punctuation.
SAFE = [range(0x0000, 0x0300), range(0x0370, 0x0483), range(0x2010, 0x2040)]
TABLE = 0x2041
LETTER, NUMBER, OTHER, SPACE, BORDER, UNSAFE = range(6)
PIECE = 1 << 20  # characters that are cut at once; longer texts are split where white space begins
REMEMBERED = 1_000_000  # pre-tokens a worker remembers before it starts anew


class SegmentTreeBPE:
    """Merges of many words at once, each with a segment tree over its adjacent pair ranks.

    A leaf holds rank * width + position of the pair that starts there, so the root is the leftmost
    pair of the lowest rank. A merge changes three leaves and the nodes above them.
    """

    NONE = np.iinfo(np.int64).max

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        byte_chars = _byte_chars()
        self.first = np.array([vocab[c] for c in byte_chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in byte_chars], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys, first = np.unique(left << 32 | right, return_index=True)
        self.keys, self.rank, self.made = keys, first.astype(np.int64), made[first]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NONE where it cannot merge, and its place in the merge table."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.NONE), at

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        length = np.array([len(w) for w in words], np.int64)
        # Words of one tree width go together; the widest come in small lots.
        width = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64))
        order, flat, count = [], [], []
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            step = max(1, (1 << 18) // w)
            for lo in range(0, len(own), step):
                part = own[lo : lo + step]
                ids, counts = self._merge([words[i] for i in part.tolist()], length[part], w)
                order.append(part)
                flat.append(ids)
                count.append(counts)
        if not order:
            return np.zeros(0, np.uint32), length
        order, flat, count = np.concatenate(order), np.concatenate(flat), np.concatenate(count)
        begin = np.cumsum(count) - count
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        count, begin = count[back], begin[back]
        return flat[np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())], count

    def _merge(self, words: list[bytes], length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        m = len(words)
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(m, width)
        column = np.arange(width)
        sym = self.first[raw]
        rows = np.arange(m)
        sym[rows, length - 1] = self.last[raw[rows, length - 1]]
        alive = column < length[:, None]
        following = np.where(column + 1 < length[:, None], column + 1, width)
        before = np.broadcast_to(column - 1, (m, width)).copy()
        tree = np.full((m, 2 * width), self.NONE)
        rank, _ = self._pairs(sym[:, :-1], sym[:, 1:])
        fits = (column[1:] < length[:, None]) & (rank != self.NONE)
        tree[:, width : 2 * width - 1] = np.where(fits, np.where(fits, rank, 0) * width + column[:-1], self.NONE)
        level = width
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        while True:
            rows = np.flatnonzero(tree[:, 1] != self.NONE)
            if not len(rows):
                break
            at = tree[rows, 1] % width
            right = following[rows, at]
            _, entry = self._pairs(sym[rows, at], sym[rows, right])
            sym[rows, at] = self.made[entry]
            alive[rows, right] = False
            after = following[rows, right]
            following[rows, at] = after
            more = after < width
            before[rows[more], after[more]] = at[more]
            self._set(tree, width, rows, right, np.full(len(rows), self.NONE))
            rank = np.full(len(rows), self.NONE)
            rank[more], _ = self._pairs(sym[rows[more], at[more]], sym[rows[more], after[more]])
            self._set(tree, width, rows, at, rank)
            prior = before[rows, at]
            has = prior >= 0
            rows, at, prior = rows[has], at[has], prior[has]
            rank, _ = self._pairs(sym[rows, prior], sym[rows, at])
            self._set(tree, width, rows, prior, rank)
        return sym[alive].astype(np.uint32), alive.sum(1)

    def _set(self, tree: np.ndarray, width: int, rows: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
        """Point updates: the leaf of one position in every row, then the nodes above it."""
        some = rank != self.NONE
        node = at + width
        tree[rows, node] = np.where(some, np.where(some, rank, 0) * width + at, self.NONE)
        while width > 1:
            node = node // 2
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            width //= 2


@lru_cache(maxsize=1)
def _byte_chars() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class Codec:
    """Pre-tokens and ids of one tokenizer file; one per worker process, see ``codec``."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.joined_space = not self.suffix  # a space belongs to the word after it
        self.single_numbers = bool(self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.tree = SegmentTreeBPE(model["vocab"], model["merges"], self.suffix) if self.suffix else None
        self.names = {i: t.encode() for t, i in [*model["vocab"].items(), *self.special.items()]}
        self.to_byte = {c: b for b, c in enumerate(_byte_chars())}
        if not self.tree:  # ranks of merges are ids here; special tokens take no part
            ranks = {bytes(self.to_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
            self.pieces = tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._tables()
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(1 << 16, X.U)  # open addressing, 0 is free
        self.slot = np.zeros(1 << 16, np.int32)
        self.by_name: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.texts: list[bytes] = []
        self.used = self.n = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of hashes, -1 where they are new."""
        mask = X.U(len(self.keys) - 1)
        at = (hashes & mask).astype(np.int64)
        got = self.keys[at]
        out = np.where(got == hashes, self.slot[at], -1).astype(np.int64)
        left = np.flatnonzero((got != hashes) & (got != 0))
        while len(left):
            at[left] = (at[left] + 1) & int(mask)
            got = self.keys[at[left]]
            same = got == hashes[left]
            out[left[same]] = self.slot[at[left[same]]]
            left = left[~same & (got != 0)]
        return out

    def _put(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        if 2 * (self.n + len(hashes)) > len(self.keys):
            used = np.flatnonzero(self.keys)
            hashes, slots = np.concatenate([self.keys[used], hashes]), np.concatenate([self.slot[used], slots])
            size = 1 << (2 * len(hashes)).bit_length()
            self.keys, self.slot = np.zeros(size, X.U), np.zeros(size, np.int32)
        mask = len(self.keys) - 1
        at = (hashes & X.U(mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = self.keys[at[left]] == 0
            _, one = np.unique(at[left], return_index=True)
            take = left[one[free[one]]]
            self.keys[at[take]] = hashes[take]
            self.slot[at[take]] = slots[take]
            left = left[self.keys[at[left]] != hashes[left]]
            at[left] = (at[left] + 1) & mask

    def _tables(self) -> None:
        norm = self.tok.normalizer
        pre = self.tok.pre_tokenizer

        def one(text: str) -> bool:
            got = pre.pre_tokenize_str(text)
            return len(got) == 1 and got[0][1][1] == len(text)

        self.kind = np.full(TABLE, UNSAFE, np.uint8)
        self.lower = np.arange(TABLE, dtype=np.uint32)
        for span in SAFE:
            for c in span:
                ch = chr(c)
                if norm:
                    made = norm.normalize_str(f"a{ch}a")
                    if len(made) != 3 or unicodedata.combining(ch):
                        continue
                    ch = made[1]
                    if ord(ch) >= TABLE:
                        continue
                    self.lower[c] = ord(ch)
                if one("a" + ch):
                    self.kind[c] = LETTER
                elif one("!" + ch):
                    self.kind[c] = OTHER
                elif len(pre.pre_tokenize_str("!" + ch)) == 2 if self.single_numbers else one("1" + ch):
                    self.kind[c] = NUMBER
                else:
                    self.kind[c] = SPACE
        self.random = X.random_codes(TABLE)

    def _remember(self, flat: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Slots of new pre-tokens, given their ids and how many each has."""
        n, to = self.n, self.n + len(count)
        while to > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(flat)), np.uint32)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.begin[n:to] = self.used + np.cumsum(count) - count
        self.count[n:to] = count
        self.used += len(flat)
        self.n = to
        return np.arange(n, to)

    def names_of(self, slots: np.ndarray) -> list[bytes]:
        """The token strings of each slot, joined by spaces as a tokenizer without decoder does."""
        for slot in range(len(self.texts), self.n):
            at = self.begin[slot]
            self.texts.append(b" ".join([self.names[i] for i in self.flat[at : at + self.count[slot]].tolist()]))
        return [self.texts[i] for i in slots.tolist()]

    def _encode(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens given as plain text."""
        raw = [n.encode("utf-8", "surrogatepass") for n in names]
        return self.tree(raw) if self.tree else _flat([self.pieces.encode_single_piece(b) for b in raw])

    def _encode_shown(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens in visible bytes, or of special tokens."""
        plain = [n for n in names if n not in self.special]
        raw = [bytes(self.to_byte[c] for c in n) for n in plain]
        flat, count = self.tree(raw) if self.tree else _flat([self.pieces.encode_single_piece(b) for b in raw])
        got = iter(np.split(flat, np.cumsum(count)[:-1]) if len(count) else [])
        return _flat([[self.special[n]] if n in self.special else next(got).tolist() for n in names])

    def _by_library(self, text: str) -> np.ndarray:
        """Slots of a text that the library cuts into pre-tokens."""
        shown: list[str] = []
        for part in self.split_special.split(text):
            if part in self.special:
                shown.append(part)
            elif part:
                part = self.tok.normalizer.normalize_str(part) if self.tok.normalizer else part
                shown += [t for t, _ in self.tok.pre_tokenizer.pre_tokenize_str(part)]
        new = list(dict.fromkeys(n for n in shown if n not in self.by_name))
        if new:
            self.by_name.update(zip(new, self._remember(*self._encode_shown(new)).tolist()))
        return np.fromiter((self.by_name[n] for n in shown), np.int64, len(shown))

    def _starts(self, kind: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin; borders begin one of their own."""
        start = np.ones(len(kind), bool)
        start[1:] = kind[1:] != kind[:-1]
        if self.single_numbers:
            start |= kind == NUMBER
        start |= kind == BORDER
        if self.joined_space:
            # The last white space before a word: a space joins it, anything else stands alone.
            at = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & (kind[1:] < SPACE)) + 1
            start[at - 1] = True
            start[at] = codes[at - 1] != 0x20
        return start

    def _cut(self, texts: list[str]) -> list[tuple[int, str]]:
        """(row, piece): long texts in pieces that begin with white space."""
        out = []
        for i, text in enumerate(texts):
            at = 0
            while len(text) - at > PIECE:
                found = _BREAK.search(text, at + PIECE)
                if not found:
                    break
                out.append((i, text[at : found.start() + 1]))
                at = found.start() + 1
            out.append((i, text[at:]))
        return out

    def slots(self, texts: list[str]) -> list[np.ndarray]:
        """The slots of the pre-tokens of every text; they index begin, count and texts."""
        if self.n > REMEMBERED:
            self.forget()
        rows: list[list[np.ndarray]] = [[] for _ in texts]
        pieces = self._cut(texts)
        lo = 0
        while lo < len(pieces):
            hi, size = lo, 0
            while hi < len(pieces) and (hi == lo or size + len(pieces[hi][1]) <= PIECE):
                size += len(pieces[hi][1]) + 1
                hi += 1
            for (row, _), got in zip(pieces[lo:hi], self._some([p for _, p in pieces[lo:hi]])):
                rows[row].append(got)
            lo = hi
        return [r[0] if len(r) == 1 else np.concatenate(r) for r in rows]

    def _some(self, texts: list[str]) -> Iterator[np.ndarray]:
        joined = "\0".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        at = np.minimum(codes, TABLE - 1)
        kind = self.kind[at]
        codes = self.lower[at]
        kind[ends] = BORDER
        odd = kind == UNSAFE
        for first, after in ("'", "stvmlrd"), ("<", "|"):
            here = np.flatnonzero(codes[:-1] == ord(first))
            odd[here] |= np.isin(codes[here + 1], [ord(c) for c in after])
        slow = np.zeros(len(texts), bool)
        slow[np.searchsorted(ends, np.flatnonzero(odd))] = True
        begin = np.flatnonzero(self._starts(kind, codes))
        to = np.append(begin[1:], len(codes))
        keep = kind[begin] < (BORDER if self.joined_space else SPACE)
        begin, to = begin[keep], to[keep]
        own = np.searchsorted(begin, ends)  # pre-tokens before the end of each text
        if slow.any():
            fast = ~slow[np.searchsorted(ends, begin)]
        else:
            fast = slice(None)
        (hashes,) = X.span_hashes(self.random[codes], begin[fast], to[fast])
        slot = self._find(hashes)
        new = np.flatnonzero(slot < 0)
        if len(new):
            distinct, first = np.unique(hashes[new], return_index=True)
            b, e = begin[fast][new[first]].tolist(), to[fast][new[first]].tolist()
            names = [codes[x:y].tobytes().decode("utf-32-le", "surrogatepass") for x, y in zip(b, e)]
            self._put(distinct, self._remember(*self._encode(names)))
            slot[new] = self._find(hashes[new])
        full = np.empty(len(begin), np.int64)
        full[fast] = slot
        before = 0
        for i, end in enumerate(own.tolist()):
            yield self._by_library(texts[i]) if slow[i] else full[before:end]
            before = end

    def expand(self, slots: np.ndarray) -> np.ndarray:
        """The ids behind slots, in order."""
        count = self.count[slots]
        total = np.cumsum(count)
        shift = np.repeat(self.begin[slots] - total + count, count)
        return self.flat[shift + np.arange(total[-1] if len(total) else 0)]


_BREAK = re.compile(r"[^\s](?=[ \t\n\r])")


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(count.sum())), count


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The codec of a tokenizer file, once per worker process."""
    return Codec(path)
