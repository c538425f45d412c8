"""Byte-level BPE by rank-synchronous array merging.

Pre-tokens that a worker meets for the first time are held together as one ragged numpy array of symbols. In each round every
sequence finds its lowest-rank adjacent pair and merges all its occurrences at once, until no sequence has a pair with a rank.
What remains are the tokens. Tokens are kept per distinct chunk (a word with what touches it) in a bounded store, so that a text costs
one split at its blanks and one look-up per chunk.

The merges come from a tokenizer's .json file; its added special strings, where a text holds them, are one token each.
"""

from __future__ import annotations

import json
from itertools import islice, repeat

import numpy as np
import regex

#: The published split of byte-level BPE, with white space as Unicode defines it.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Strings that a store holds; beyond it, only the first eighth stays.
STORE = 600_000


def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte in vocabulary files: itself if printable, else the next unused code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    signs, more = [], 256
    for b in range(256):
        signs.append(chr(b if b in plain else more))
        more += b not in plain
    return signs


_ODD_BLANK = regex.compile(r" \p{White_Space}").search


class _Store:
    """Token sequences by string, in flat arrays."""

    def __init__(self) -> None:
        self.known: dict[str | tuple[str], int] = {}
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.counts, self.begins = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def add(self, new: list, ids: np.ndarray, counts: np.ndarray) -> None:
        n, m = len(self.known), len(new)
        while n + m > len(self.counts):
            self.counts, self.begins = np.append(self.counts, np.zeros_like(self.counts)), np.append(self.begins, np.zeros_like(self.begins))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.empty_like(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.counts[n : n + m] = counts
        self.begins[n : n + m] = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        self.known.update(zip(new, range(n, n + m), strict=True))

    def at(self, items: list, learn) -> np.ndarray:
        found = np.fromiter(map(self.known.get, items, repeat(-1)), np.int64, len(items))
        if len(gaps := np.flatnonzero(found < 0)):
            learn(list(dict.fromkeys([items[i] for i in gaps.tolist()])))
            found[gaps] = [self.known[items[i]] for i in gaps.tolist()]
        return found

    def shrink(self, n: int) -> None:
        """Keep the n strings learnt first, among which are the frequent ones."""
        if len(self.known) > n:
            self.known = dict(islice(self.known.items(), n))
            self.used = int(self.begins[n - 1] + self.counts[n - 1]) if n else 0
            self.flat, self.counts, self.begins = self.flat[: max(self.used, 1)].copy(), self.counts[: max(n, 1)].copy(), self.begins[: max(n, 1)].copy()

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[at]
        ends = np.concatenate(([0], np.cumsum(counts)))
        return self.flat[np.repeat(self.begins[at] - ends[:-1], counts) + np.arange(ends[-1])], counts


class RankMerger:
    """Tokenizes UTF-8 pre-tokens in batches. Token numbers are those of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.first = np.array([vocab[s] for s in _byte_signs()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._hash(keys, made)
        self.byte_ranks = self.ranks(np.repeat(self.first, 256), np.tile(self.first, 256)).astype(np.int32)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._clear()

    def _hash(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Open addressing over arrays: a pair's rank by a few vectorised probes."""
        self.none = len(keys)
        self.bits = max(4, int(np.ceil(np.log2(len(keys) * 4 + 1))))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.full(1 << self.bits, self.none, np.int64)
        rank, at = np.arange(len(keys)), self._slot(keys)
        self.probes = 0
        while len(rank):
            self.probes += 1
            free = self.slots[at] < 0
            self.slots[at[free][::-1]] = keys[rank[free]][::-1]
            won = self.slots[at] == keys[rank]
            self.slot_rank[at[won]] = rank[won]
            rank, at = rank[~won], (at[~won] + 1) & ((1 << self.bits) - 1)
        self.made = np.append(made, -1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = self._slot(keys)
        found = np.where(self.slots[at] == keys, self.slot_rank[at], self.none)
        todo = np.flatnonzero((found == self.none) & (self.slots[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            hit = self.slots[at[todo]] == keys[todo]
            found[todo[hit]] = self.slot_rank[at[todo[hit]]]
            todo = todo[~hit & (self.slots[at[todo]] >= 0)]
        return found

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the pieces, one after the other, and each piece's number of tokens.

        A pair's rank is looked up when the pair comes to be, and kept until one of its sides is merged.
        """
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ids, seq = self.first[raw].astype(np.int32), np.repeat(np.arange(len(pieces), dtype=np.int32), lens)
        rank = np.full(len(ids), self.none, np.int32)
        if len(ids):
            rank[:-1] = self.byte_ranks[raw[:-1].astype(np.int32) * 256 + raw[1:]]
            rank[:-1][seq[:-1] != seq[1:]] = self.none
        ended_ids, ended_seq = [], []
        while len(ids):
            start = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            size = np.diff(np.append(start, len(ids)))
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == self.none
            if done.any():  # sequences without a ranked pair
                out = np.repeat(done, size)
                ended_ids.append(ids[out])
                ended_seq.append(seq[out])
                ids, seq, rank, lowest, size = ids[~out], seq[~out], rank[~out], lowest[~done], size[~done]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, size))
            # A pair of equal symbols can overlap with the next: of such a run every second one merges, from the left.
            run = np.concatenate(([True], np.diff(hit) > 1))
            if not run.all():
                first = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            ids[hit] = self.made[rank[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))  # where the merged symbols stand afterwards
            ids, seq, rank = ids[keep], seq[keep], rank[keep]
            fresh = np.concatenate((at, at[at > 0] - 1))
            fresh = fresh[fresh < len(ids) - 1]
            rank[at] = self.none
            rank[fresh] = np.where(seq[fresh] == seq[fresh + 1], self.ranks(ids[fresh].astype(np.int64), ids[fresh + 1]), self.none)
        if not ended_ids:
            return np.empty(0, np.int64), np.zeros(len(pieces), np.int64)
        ids, seq = np.concatenate(ended_ids), np.concatenate(ended_seq)
        return ids[np.argsort(seq, kind="stable")], np.bincount(seq, minlength=len(pieces))

    def _clear(self) -> None:
        self.chunks = _Store()

    def rest(self) -> None:
        """Give up most of the store, as between tasks."""
        self.chunks.shrink(STORE // 8)
        if self.chunks.used > 4 * STORE:
            self._clear()

    def _tokens(self, pieces: list[str | tuple[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the pre-tokens, one after the other, and each one's number of tokens; equal ones are merged once."""
        new = _Store()

        def learn(distinct: list[str | tuple[str]]) -> None:
            plain = [p for p in distinct if isinstance(p, str)]
            ids, counts = self.merge([p.encode() for p in plain])
            new.add(plain, ids, counts)
            added = [p for p in distinct if not isinstance(p, str)]
            new.add(added, np.array([self.special[p[0]] for p in added], np.int64), np.ones(len(added), np.int64))

        return new.gather(new.at(pieces, learn))

    def _split(self, text: str) -> list[str | tuple[str]]:
        """Pre-tokens; an added special string is a tuple, never equal to a pre-token of the same letters."""
        if self.cut is None or not (found := list(self.cut.finditer(text))):
            return _SPLIT.findall(text)
        out, at = [], 0
        for m in found:
            out += [*_SPLIT.findall(text[at : m.start()]), (m[0],)]
            at = m.end()
        return out + _SPLIT.findall(text[at:])

    def _learn_chunks(self, new: list[str | tuple[str]]) -> None:
        # Chunks that open with a blank are split as one text: each opens a pre-token there too.
        plain = [c for c in new if isinstance(c, str) and c[0] == " "]
        flat = _SPLIT.findall("".join(plain))
        ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)))
        held = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain))), "right")
        counts = np.diff(held, prepend=0).tolist()
        for c in new:
            if not isinstance(c, str) or c[0] != " ":
                own = _SPLIT.findall(c) if isinstance(c, str) else self._split(c[0])
                plain.append(c)
                flat += own
                counts.append(len(own))
        ids, sizes = self._tokens(flat)
        self.chunks.add(plain, ids, _sums(sizes, np.array(counts, np.int64)))

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Store numbers of the chunks of all texts, and how many each text has. They hold until the next call.

        A blank before a sign that is no white space always opens a pre-token, so texts are cut there into chunks that are
        tokenized by themselves. A text with other blanks, or with an added special string, is one chunk, held as a tuple.
        """
        chunks, sizes = [], []
        for text in texts:
            if not text:
                sizes.append(0)
            elif text[-1] == " " or _ODD_BLANK(text) or self.cut is not None and self.cut.search(text):
                chunks.append((text,))
                sizes.append(1)
            else:
                first, *rest = text.split(" ")
                n = len(chunks)
                if first:
                    chunks.append(first)
                chunks += map(" ".__add__, rest)
                sizes.append(len(chunks) - n)
        if len(self.chunks.known) > STORE or self.chunks.used > 16 * STORE:
            self.rest()
        return self.chunks.at(chunks, self._learn_chunks), np.array(sizes, np.int64)

    def count(self, texts: list[str | None]) -> np.ndarray:
        at, sizes = self.numbers(texts)
        return _sums(self.chunks.counts[at], sizes)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts, one after the other, as int32, and each text's number of tokens."""
        at, sizes = self.numbers(texts)
        ids, counts = self.chunks.gather(at)
        return ids, _sums(counts, sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends, cut = np.concatenate(([0], np.cumsum(values))), np.concatenate(([0], np.cumsum(sizes)))
    return ends[cut[1:]] - ends[cut[:-1]]


_mergers: dict[str, RankMerger] = {}


def merger(path: str) -> RankMerger:
    """One per file in each worker."""
    if path not in _mergers:
        _mergers[path] = RankMerger(path)
    return _mergers[path]
