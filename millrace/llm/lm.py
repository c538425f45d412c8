"""LM scoring by a probabilistic suffix tree.

Every sequence of up to `depth` + 1 words of the training texts that occurs LEAST times enters, whatever the corpus. A context is
retained if the divergence of its next-symbol counts from what the next shorter context predicts is worth its size; nothing else is
pruned. A token's probability is that of the longest retained suffix of what stands before it: the discounted share of the symbol plus
the discounted mass times the shorter suffix's probability, down to (c + 1) / (N + V + 1). Each distribution sums to 1 with one unseen
symbol.

The tree is never in one place. Every token, with the words before it, is a window, and all contexts that end in one word are a subtree:

1. Words are counted; the HEAD most frequent are numbered by rank in a broadcast table. Texts are written once as numbers, in steps of
   about STEP tokens. A step is told the counts of its rarer words by a join.
2. A context with more than `limit` windows is hot. Steps ask for the counts of their distinct (hot context, word) pairs, pairs are
   summed, and the answers go back to the steps; so no task holds a hot context's windows. This is repeated one word deeper as long
   as there are hot contexts. Of hot contexts, HOT at most, one line of statistics each is broadcast.
3. Windows go to the bucket of their shortest context that isn't hot, once, packed. A bucket counts, tests and scores its subtree, and
   returns sums by text.

Sums are of whole multiples of 2^-32, so reruns agree whatever the order.

Tokens: ASCII-lower-cased runs of `[^\\x20\\x09-\\x0D]`, then one end per text. A null or empty text is the end token alone. Words are
told apart by 63-bit hashes. Repeated rows are each counted and answered. Without training rows all scores are those of an empty count.
Null ids stay null; ids keep their type; other columns aren't read.
"""

from __future__ import annotations

import pickle
import struct
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_texts, crc_mod, give_back, materialize

LEAST, DISCOUNT, PENALTY = 2, 0.5, 2.0
HEAD, HOT = 2_000_000, 1_000_000
#: Tokens of a step, windows of a bucket on average, and windows that a bucket may get from one context.
STEP, BUCKET, LIMIT = 1_000_000, 1 << 20, 1 << 22
#: Windows that a bucket counts at once; only a single context of one word may bring more, LIMIT at most.
CHUNK = 1 << 19
#: Rows from which on a blob has a frame for each byte plane.
PLANES = 1000
#: Words that a worker remembers; beyond it, it starts anew. Most groups of steps that sums are collected by.
CACHE, SLOTS = 400_000, 4096
#: Sums that a worker adds at once.
SUMS = 1 << 20
SCALE = float(1 << 32)
_END, _ROWS = 2, 21


# ---- packed columns


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns as compressed byte planes; planes of zeros take nothing."""
    z, out = zstandard.ZstdCompressor(level=1), []
    for x in columns:
        planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
        out.append((x.dtype.str, len(x), [z.compress(p.tobytes()) if p.any() else b"" for p in planes]))
    return pickle.dumps(out, protocol=5)


def _unpack(blob: bytes) -> list[np.ndarray]:
    z, out = zstandard.ZstdDecompressor(), []
    for kind, n, planes in pickle.loads(blob):
        x = np.zeros((n, len(planes)), np.uint8)
        for i, p in enumerate(planes):
            if p:
                x[:, i] = np.frombuffer(z.decompress(p), np.uint8)
        out.append(x.reshape(-1).view(kind))
    return out


_SIZES = struct.Struct("<III")


def _pieces(columns: list[np.ndarray], edges: np.ndarray, more: np.ndarray, cuts: np.ndarray) -> Iterator[bytes]:
    """A blob for the rows between every two edges, with those of `more` (64-bit numbers) between the same two cuts.

    The byte planes are made once for all blobs, so that a blob of few rows costs little. It has a frame for each plane if it is large.
    """
    z, planes, used = zstandard.ZstdCompressor(level=1), [], []
    for x in columns:
        for plane in np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T:
            used.append(bool(plane.any()))
            if used[-1]:
                planes.append(plane)
    body, mask = np.array(planes, np.uint8).reshape(len(planes), len(columns[0])), np.packbits(used).tobytes()
    for lo, hi, a, b in zip(edges.tolist(), edges[1:].tolist(), cuts.tolist(), cuts[1:].tolist(), strict=False):
        if hi - lo < PLANES:
            frames = [z.compress(body[:, lo:hi].tobytes() + more[a:b].tobytes())]
        else:
            frames = [z.compress(x[lo:hi]) for x in body]
            frames.append(z.compress(more[a:b].tobytes()) if b > a else b"")
        yield b"".join((_SIZES.pack(hi - lo, (b - a) * more.shape[1], len(frames)), mask, struct.pack(f"<{len(frames)}I", *map(len, frames)), *frames))


def _joined(blobs: list[bytes | None], kinds: list[type]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The columns of all blobs, one after the other, each blob's number of rows, and `more`. Blobs are given back on the way."""
    z, width = zstandard.ZstdDecompressor(), [np.dtype(k).itemsize for k in kinds]
    plane_of = [(k, i) for k, n in enumerate(width) for i in range(n)]
    sizes = np.array([_SIZES.unpack_from(x)[0] for x in blobs], np.int64)
    total, out, more, at = int(sizes.sum()), [None] * len(kinds), [], 0
    for k, blob in enumerate(blobs):
        n, m, frames = _SIZES.unpack_from(blob)
        begin = _SIZES.size + -(-len(plane_of) // 8)
        mask = np.unpackbits(np.frombuffer(blob, np.uint8, begin - _SIZES.size, _SIZES.size))
        lengths = struct.unpack_from(f"<{frames}I", blob, begin)
        begin, parts = begin + 4 * frames, []
        for length in lengths:
            parts.append(z.decompress(blob[begin : begin + length]) if length else b"")
            begin += length
        one, used = b"".join(parts) if len(parts) > 1 else parts[0], np.flatnonzero(mask).tolist()
        for i, plane in enumerate(used):
            c, j = plane_of[plane]
            if out[c] is None:
                out[c] = np.zeros((total, width[c]), np.uint8)
            out[c][at : at + n, j] = np.frombuffer(one, np.uint8, n, i * n)
        if m:
            more.append(np.frombuffer(one, np.int64, m, len(used) * n))
        at, blobs[k] = at + n, None
    columns = [np.broadcast_to(np.dtype(k).type(0), total) if x is None else x.reshape(-1).view(k) for k, x in zip(kinds, out, strict=True)]
    return columns, sizes, np.concatenate(more) if more else np.zeros(0, np.int64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two numbers."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= b.astype(np.uint64) + np.uint64(0xD1B54A32D192ED03) + (x << np.uint64(6)) + (x >> np.uint64(2))
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> np.uint64(33)
        x *= np.uint64(m)
    return (x ^ (x >> np.uint64(33))).astype(np.int64)


def _bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return (key.astype(np.uint64) >> np.uint64(8)) % np.uint64(buckets)


# ---- words


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = int.from_bytes(xxhash.xxh64_digest(word), "big", signed=True) & -2
        return value


class Head(NamedTuple):
    """Frequent words: hashes sorted, the rank of each (from 1), and by rank the counts in training texts and in all."""

    hashes: np.ndarray
    rank: np.ndarray
    train: np.ndarray
    both: np.ndarray


class _Ranks(dict):
    """A frequent word's rank; another's number among the step's other words, behind all ranks."""

    def __init__(self, head: Head):
        super().__init__()
        self.hashes, self.rank = array("q", head.hashes.astype(np.int64).tobytes()), head.rank
        self.other: dict[int, int] = {}
        self.end = self.of(_END)

    def of(self, h: int) -> int:
        at = bisect_left(self.hashes, h)
        if at < len(self.hashes) and self.hashes[at] == h:
            return int(self.rank[at])
        return len(self.hashes) + 1 + self.other.setdefault(h, len(self.other))

    def __missing__(self, word: bytes) -> int:
        value = self.of(int.from_bytes(xxhash.xxh64_digest(word), "big", signed=True) & -2)
        if value <= len(self.hashes):
            if len(self) >= CACHE:
                self.clear()
            self[word] = value
        return value


def _tokens(raws: list[bytes | None], codes: dict, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts' tokens, and each text's number of tokens, its end included."""
    sizes, parts = np.empty(len(raws), np.int64), []
    for i, raw in enumerate(raws):
        words = raw.lower().split() if raw else []
        own = np.empty(len(words) + 1, np.int64)
        own[:-1] = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
        own[-1] = end
        parts.append(own)
        sizes[i] = len(own)
    return np.concatenate(parts), sizes


def _steps(raws: list[bytes | None]) -> Iterator[tuple[int, int]]:
    begin = n = 0
    for i, raw in enumerate(raws):
        n += len(raw or b"") // 6 + 1
        if n >= STEP:
            yield begin, i + 1
            begin, n = i + 1, 0
    if begin < len(raws):
        yield begin, len(raws)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        raws, train = byte_texts(batch.column(0)), np.asarray(batch.column(1))
        for a, b in _steps(raws):
            tokens, sizes = _tokens(raws[a:b], hashes, _END)
            words, counts = np.unique(tokens | np.repeat(train[a:b], sizes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words & -2), pa.array(counts * (words & 1)), pa.array(counts)], names=["w", "t", "a"])
    hashes.clear()
    give_back()


def _head(counted: DataFrame) -> tuple[Head, bool]:
    """The most frequent words, HEAD at most; and whether these are all that occur twice."""
    least, n, complete = 2, 0, True
    many = counted.filter("a > 1").groupBy("a").count().orderBy(F.desc("a"))
    for a, k in many.limit(HEAD + 1).toLocalIterator():
        if n + k > HEAD:
            least, complete = a + 1, False
            break
        n += k
    t = counted.filter(F.col("a") >= least).toArrow()
    w, train, both = (np.asarray(t.column(c)).astype(np.int64) for c in ("w", "t", "a"))
    order = np.lexsort((w, -both))
    w, train, both = w[order], train[order], both[order]
    by_hash = np.argsort(w)
    zero = np.zeros(1, np.int64)
    return Head(w[by_hash], (by_hash + 1).astype(np.int32), np.concatenate((zero, train)), np.concatenate((zero, both))), complete


def _write_steps(held, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, complete = held.value
        ranks, step = None, TaskContext.get().partitionId() << 20
        for batch in batches:
            raws, flags = byte_texts(batch.column(1)), np.asarray(batch.column(2))
            ranks = ranks or _Ranks(head)
            for a, b in _steps(raws):
                ranks.other.clear()
                ranks.end = ranks.of(_END)
                tokens, sizes = _tokens(raws[a:b], ranks, ranks.end)
                other = np.fromiter(ranks.other, np.int64, len(ranks.other))
                told = np.zeros(len(other), np.int64)
                if complete:  # each of them occurs once
                    at = np.flatnonzero(tokens > len(head.hashes))
                    told[tokens[at] - len(head.hashes) - 1] = np.repeat(flags[a:b], sizes)[at]
                ids = batch.column(0).slice(a, b - a)
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                columns = [pa.array([step]), one(ids), one(pa.array(sizes)), one(pa.array(flags[a:b])), pa.array([_pack([tokens.astype(np.uint32)])], pa.binary()), one(pa.array(other)), one(pa.array(told)), one(pa.array(np.ones(len(other), np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                step += 1
        if ranks:
            ranks.clear()
        give_back()

    return run


def _tell_rare(coded: DataFrame, counted: DataFrame) -> DataFrame:
    """Steps with the counts of their words outside the head."""
    asked = coded.select("step", F.posexplode("other").alias("i", "w"))
    told = asked.join(counted, "w").groupBy("step").agg(F.array_sort(F.collect_list(F.struct("i", "t", "a"))).alias("x"))
    out = coded.drop("other_t", "other_a").join(told, "step", "left")
    told = lambda c: F.coalesce(F.transform("x", lambda x: x[c]), F.array().cast("array<long>")).alias(f"other_{c}")
    return materialize(out.select(*coded.columns[:6], told("t"), told("a")), "lm-steps")


# ---- windows


class Hot(NamedTuple):
    """Of the hot contexts of one length: sorted keys, counts, and the mass left to the shorter suffix (1 where not retained)."""

    keys: np.ndarray
    n: np.ndarray
    keep: np.ndarray
    rest: np.ndarray


class Model(NamedTuple):
    head: Head
    total: int
    distinct: int
    depth: int
    limit: int
    buckets: int
    hot: list[Hot]
    asks: tuple[int, ...] = ()  # by length of hot contexts, the number of buckets of the questions


class Windows(NamedTuple):
    """Tokens with what stands before them. Words are ranks, or for others: in a step their hashes, in a bucket numbers behind all ranks."""

    row: np.ndarray  # of the text; in a bucket the distance to that of the window before, from 0 in each blob
    train: np.ndarray
    word: np.ndarray  # 0: occurs less than LEAST times
    before: list[np.ndarray]  # nearest first; 0: none
    told: list[np.ndarray]  # counts of the sequences after hot contexts
    hot: np.ndarray  # how many of the contexts are hot
    count: np.ndarray  # in training texts, of the word
    names: np.ndarray = np.zeros(0, np.int64)  # in a bucket, the others' hashes

    def named(self, words: np.ndarray, top: int) -> np.ndarray:
        """Words as numbers that mean the same everywhere."""
        return np.where(words > top, self.names[np.maximum(words - top - 1, 0)], words) if len(self.names) else words


def _base(t: np.ndarray, model: Model) -> np.ndarray:
    return (t + 1.0) / (model.total + model.distinct + 1)


def _keys(before: list[np.ndarray]) -> Iterator[np.ndarray]:
    key = np.zeros(len(before[0]), np.int64)
    for b in before:
        key = _mix(key, b)
        yield key


def _after_hot(w: Windows, model: Model, levels: int | None = None) -> np.ndarray:
    """Probabilities after the hot contexts."""
    p, key = _base(w.count, model), np.zeros(len(w.row) if model.hot[:levels] else 0, np.int64)
    for level, (stats, told, before) in enumerate(zip(model.hot[:levels], w.told, w.before, strict=False), 1):
        at = np.flatnonzero(w.hot >= level)
        if not len(at):
            break
        key[at] = _mix(key[at], w.named(before[at], len(model.head.hashes)))
        i = np.searchsorted(stats.keys, key[at])
        t = told[at]
        p[at] = np.where(stats.keep[i] & (t >= LEAST), (t.astype(float) - DISCOUNT) / stats.n[i], 0.0) + stats.rest[i] * p[at]
    return p


class Step:
    """A step's tokens, its hot contexts as far as they are told, and its windows."""

    def __init__(self, model: Model, row: dict):
        self.model, head = model, model.head
        (codes,) = _unpack(row["codes"])
        self.code, self.sizes = codes.astype(np.int64), np.array(row["size"], np.int64)
        self.step, self.train = row["step"], np.array(row["train"], bool)
        top = len(head.hashes)
        self.names = np.concatenate((np.arange(top + 1), np.array(row["other"], np.int64)))
        self.t = np.concatenate((head.train, np.array(row["other_t"], np.int64)))
        self.both = np.concatenate((head.both, np.array(row["other_a"], np.int64)))
        n, depth = len(self.code), model.depth
        place = np.arange(n) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        usable = self.t[self.code] >= LEAST
        name = self.names[self.code]
        word = np.where(usable, name, 0)
        before, ok = [], np.ones(n, bool)
        for k in range(1, depth + 1):
            ok[:k] = False
            ok[k:] &= (place[k:] >= k) & usable[:-k]
            b = np.zeros(n, np.int64)
            b[ok] = name[np.flatnonzero(ok) - k]
            before.append(b)
        told = [np.zeros(n, np.int64) for _ in range(depth)]
        count = self.t[self.code]
        self.windows = Windows(self.text, self.train[self.text], word, before, told, np.zeros(n, np.int64), count)
        self.next_hot = np.zeros(n, bool)
        self.next_hot[1:] = (before[0][1:] != 0) & (self.both[self.code[:-1]] > model.limit)
        self.weight = np.zeros(n, np.int64)  # windows of the context that is next
        self.weight[1:] = self.both[self.code[:-1]]
        self._keys = _keys(before)
        self._made: list[np.ndarray] = []
        for replies in (row[f"told{k}"] for k in range(1, depth + 1)):
            if replies is None:
                break
            self._tell(replies)

    def key(self, level: int) -> np.ndarray:
        """Of every position, the key of its context of that length."""
        while len(self._made) < level:
            self._made.append(next(self._keys))
        return self._made[level - 1]

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Distinct pairs of a next hot context and a word: the first position of each, bucket, counts, positions' pairs, and length."""
        level = int(self.windows.hot.max(initial=0)) + 1
        at = np.flatnonzero(self.next_hot)
        pair = _mix(self.key(level)[at], self.windows.word[at])
        _, first, which = np.unique(pair, return_index=True, return_inverse=True)
        first = at[first]
        spread = 1 + self.weight[first] // BUCKET
        part = np.abs(_mix(self.windows.word[first], np.full(1, 77))) % spread
        bucket = _bucket_of(_mix(self.key(level)[first], part), self.model.asks[level - 1])
        order = np.lexsort((self.windows.word[first], self.windows.before[0][first], bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        which = place[which]
        t = np.bincount(which, self.windows.train[at], len(first)).astype(np.int64)
        return first[order], bucket[order], t, np.bincount(which, minlength=len(first)), which, level

    def _tell(self, replies: list[dict]) -> None:
        first, bucket, _, _, which, level = self.asked()
        t, a = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        if replies:
            (told_t, told_a), sizes, _ = _joined([reply["blob"] for reply in replies], [np.uint32, np.uint32])
            begin = np.searchsorted(bucket, [reply["bucket"] for reply in replies])
            at = np.arange(len(told_t)) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
            t[at], a[at] = told_t, told_a
        at = np.flatnonzero(self.next_hot)
        self.windows.told[level - 1][at] = t[which]
        self.windows.hot[at] = level
        self.next_hot = np.zeros(len(self.code), bool)
        self.weight = np.zeros(len(self.code), np.int64)
        if level < self.model.depth:
            go = at[(a[which] > self.model.limit) & (at + 1 < len(self.code))]
            weight = dict(zip(at.tolist(), a[which].tolist(), strict=True)) if len(go) else {}
            go = go[self.windows.before[level][go + 1] != 0] + 1
            self.next_hot[go] = True
            self.weight[go] = [weight[i - 1] for i in go.tolist()]

    def packed(self, at: np.ndarray, bucket: np.ndarray, more: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        """(bucket, blob) of the windows at positions; bucket is sorted. Other words than ranks go as hashes with their counts."""
        if not len(at):
            return
        w, top = self.windows, len(self.model.head.hashes)
        code = np.array([np.where(x[at] == 0, 0, self.code[at - k]) for k, x in enumerate([w.word, *w.before])])
        start = np.concatenate(([True], bucket[1:] != bucket[:-1]))
        edges = np.append(np.flatnonzero(start), len(bucket))
        text = np.zeros(len(at), np.int64) if more else w.row[at]
        row = np.where(start, text, np.diff(text, prepend=0))
        window, k = np.nonzero(code.T > top)
        other = code[k, window]
        columns = [w.train[at].view(np.uint8), *np.minimum(code, top + 1), w.hot[at], *(t[at] for t in w.told), *more]
        columns = [row.astype(np.uint32), columns[0], *(x.astype(np.uint32) for x in columns[1:])]
        others = np.stack((self.names[other], self.t[other]), 1)
        yield from zip(bucket[edges[:-1]].tolist(), _pieces(columns, edges, others, np.searchsorted(window, edges)), strict=True)


def _opened(blobs: list[tuple[int, bytes]], model: Model, more: int = 0) -> tuple[Windows, list[np.ndarray], np.ndarray]:
    """The windows of (step, blob)s, further columns, and each blob's number of windows."""
    top, depth = len(model.head.hashes), model.depth
    kinds = [np.uint32, np.uint8, *[np.int32] * (depth + 1), np.uint32, *[np.uint32] * (depth + more)]
    own = [blob for _, blob in blobs]
    blobs[:] = [(step, None) for step, _ in blobs]
    (row, train, *columns), sizes, others = _joined(own, kinds)
    words, hot, told, more = columns[: depth + 1], columns[depth + 1], columns[depth + 2 : 2 * depth + 2], columns[2 * depth + 2 :]
    count = model.head.train[np.minimum(words[0], top)].astype(np.int32)
    names = others[::2]
    if len(others):
        names, number = np.unique(names, return_inverse=True)
        window, k = np.nonzero(np.array([x > top for x in words]).T)
        for i, x in enumerate(words):
            if (k == i).any():
                x[window[k == i]] = top + 1 + number[k == i]
        count[window[k == 0]] = others[1::2][k == 0]
    return Windows(row, train.view(bool), words[0], words[1:], told, hot, count, names), more, sizes


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Runs of rows (group, step, blob) of one group; the rows are sorted by group."""
    now, held = None, []
    for batch in batches:
        for group, step, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if group != now and held:
                yield now, held
                held = []
            now = group
            held.append((step, blob))
    if held:
        yield now, held


def _each_step(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Step, dict]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield Step(model, row), row


_BLOBS = "bucket long, step long, blob binary"


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["bucket", "step", "blob"])


def _ask(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, _ in _each_step(held.value, batches):
            first, bucket, t, a, _, _ = s.asked()
            yield _blobs([(b, s.step, blob) for b, blob in s.packed(first, bucket, [t, a])])
            del s, first, bucket, t, a
        give_back()

    return run


def _answer(held):
    """Replies (bucket, step, blob), and rows of statistics by context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = held.value
        level = len(model.hot) + 1
        for bucket, blobs in _gathered(batches):
            w, (t, a), sizes = _opened(blobs, model, 2)
            p = _after_hot(w, model)
            *_, key = _keys([w.named(x, len(model.head.hashes)) for x in w.before[:level]])
            _, first, which = np.unique(_mix(key, w.word), return_index=True, return_inverse=True)
            t, a = (np.bincount(which, x, len(first)).astype(np.int64) for x in (t, a))
            keys, c = np.unique(key[first], return_inverse=True)
            total = lambda x: np.bincount(c, x, len(keys))  # noqa: B023, E731
            n = total(t)
            t, a = (np.where(w.word[first] != 0, x, 0) for x in (t, a))
            most = np.zeros(len(keys), np.int64)
            np.maximum.at(most, c, a)
            edges = np.concatenate(([0], np.cumsum(sizes)))
            replies = _pieces([t[which].astype(np.uint32), a[which].astype(np.uint32)], edges, np.zeros((0, 1), np.int64), np.zeros_like(edges))
            rows = [(step, blob) for (step, _), blob in zip(blobs, replies, strict=True)]
            in_it, q = t >= LEAST, p[first]
            stats = [most, total(np.where(a > model.limit, a, 0)), n, total(in_it), total(t * in_it), total(np.where(in_it, t * np.log(np.maximum(t, 1) / q), 0.0)), total(np.where(in_it, q, 0.0))]
            m, k = len(rows), len(keys)
            columns = [pa.array([bucket] * m + [None] * k, pa.int64()), pa.array([r[0] for r in rows] + [None] * k, pa.int64()), pa.array([r[1] for r in rows] + [None] * k, pa.binary()), pa.array([None] * m + keys.tolist(), pa.int64())]
            columns += [pa.array([None] * m + x.astype(float).tolist(), pa.float64()) for x in stats]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "step", "blob", "key", "most", "heavy", "n", "rows", "seen", "g", "theirs"])
        give_back()

    return run


def _worth(n, rows, seen, g, theirs):
    """Whether contexts are retained, by the divergence of their counts from the shorter suffix's predictions."""
    seen_log = np.where(seen > 0, seen * np.log(np.maximum(n, 1)), 0.0)
    left = n - seen
    gain = g - seen_log + left * (np.log(np.maximum(1 - seen / np.maximum(n, 1), 1e-12)) - np.log(np.maximum(1 - theirs, 1e-12)))
    return (rows > 0) & (gain > PENALTY * np.maximum(rows, 1))


def _tell_hot(coded: DataFrame, model: Model) -> tuple[DataFrame, Model, bool]:
    """One length more of hot contexts: steps with their answers, the contexts' statistics, and whether there are longer ones."""
    level, sc = len(model.hot) + 1, coded.sparkSession.sparkContext
    held = sc.broadcast(model)
    asked = coded.drop("id").mapInArrow(_ask(held), _BLOBS).repartition(min(model.asks[level - 1], 20_000), "bucket").sortWithinPartitions("bucket")
    got = materialize(asked.mapInArrow(_answer(held), f"{_BLOBS}, key long, most double, heavy double, n double, rows double, seen double, g double, theirs double"), "lm-hot")
    sums = got.filter("key is not null").groupBy("key").agg(F.max("most"), *[F.sum(c) for c in ("heavy", "n", "rows", "seen", "g", "theirs")]).toArrow()
    order = np.argsort(np.asarray(sums.column(0)))
    key, most, heavy, n, rows, seen, g, theirs = (np.asarray(c)[order] for c in sums.columns)
    keep = _worth(n, rows, seen, g, theirs)
    hot = Hot(key, n, keep, np.where(keep, 1 - (seen - DISCOUNT * rows) / np.maximum(n, 1), 1.0))
    replies = got.filter("key is null").groupBy("step").agg(F.collect_list(F.struct("bucket", "blob")).alias("_told"))
    told = coded.join(replies, "step", "left").withColumn(f"told{level}", F.coalesce("_told", F.array().cast("array<struct<bucket:bigint,blob:binary>>"))).drop("_told")
    return materialize(told.select(*coded.columns), "lm-steps"), model._replace(hot=[*model.hot, hot], asks=(*model.asks, _asks(heavy.sum()))), bool((most > model.limit).any())


def _asks(windows: float) -> int:
    return int(windows) // BUCKET + 1


def _parts(model: Model) -> int:
    return min(model.buckets, 20_000)


def _send(held):
    """Every window to the bucket of its shortest context that isn't hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = held.value
        for s, _ in _each_step(model, batches):
            w = s.windows
            at = np.flatnonzero(w.before[0])
            key = s.key(1)[at]
            hot = w.hot[at]
            for level in range(1, model.depth + 1):
                here = hot == level
                if here.any():
                    there = at[here]
                    cold = (w.before[level][there] != 0) if level < model.depth else np.zeros(len(there), bool)
                    # Where the contexts end with a hot one, nothing is left to count, and any bucket will do.
                    key[here] = np.where(cold, s.key(min(level + 1, model.depth))[there], _mix(s.key(level)[there], there))
            bucket = _bucket_of(key, model.buckets)
            order = np.argsort(bucket.astype(np.min_scalar_type(model.buckets)), kind="stable")
            yield _blobs([(b, s.step, blob) for b, blob in s.packed(at[order], bucket[order], [])])
            del s, w, at, key, hot, bucket, order
        give_back()

    return run


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows by key, where each run begins in it, and the runs' numbers in that order."""
    order = np.argsort(key)
    x = key[order]
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return order, np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - np.int32(1)


def _paired(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One number for a context's and a word's."""
    if len(word) and (word.min() < 0 or word.max() >= 1 << 31):
        word = np.unique(word, return_inverse=True)[1]
    key = ctx.astype(np.int64)
    key <<= 32
    key |= word
    return key


def _descend(w: Windows, model: Model, p: np.ndarray, level: int, at: np.ndarray, ctx: np.ndarray, whole: bool = False) -> None:
    """Brings the contexts of that length and of longer ones into p. at: windows whose next shorter contexts, numbered in ctx, occur."""
    b = w.before[level - 1][at]
    ok = b != 0
    if not ok.all():
        at, ctx, b = at[ok], ctx[ok], b[ok]
    del ok
    if len(at) > CHUNK and not whole:  # by the word in front, so that a context stays in one part
        parts = len(at) // CHUNK + 1
        part = (((b.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(8)) % np.uint32(parts)).astype(np.min_scalar_type(parts))
        del b
        own = [at[part == i] for i in range(parts)]
        ctx = [ctx[part == i] for i in range(parts)]
        del at, part
        while own:
            _descend(w, model, p, level, own.pop(), ctx.pop(), True)
        return
    if not len(at):
        return
    order, start, ctx = _runs(_paired(ctx, b) if level > 1 else b)
    at = at[order]
    del b, order
    mine = w.hot[at] < level
    n = np.add.reduceat(w.train[at], start, dtype=np.int64)
    # Sequences: the context and the word, of which only those with a number can occur LEAST times.
    can = np.flatnonzero(mine & (w.word[at] != 0) & (n[ctx] >= LEAST)).astype(np.int32)
    size = len(start)
    share, rest = np.zeros(len(at)), np.ones(size)
    if len(can):
        order, begin, seq = _runs(_paired(ctx[can], w.word[at[can]]))
        where = can[order]
        del order
        c = np.add.reduceat(w.train[at[where]], begin, dtype=np.int64)
        head = where[begin]
        owner, q, in_it = ctx[head], p[at[head]], c >= LEAST
        total = lambda x: np.bincount(owner, x, size)
        seen, rows = total(c * in_it), total(in_it)
        g, theirs = total(np.where(in_it, c * np.log(np.maximum(c, 1) / q), 0.0)), total(np.where(in_it, q, 0.0))
        keep = _worth(n, rows, seen, g, theirs)
        rest = np.where(keep, 1 - (seen - DISCOUNT * rows) / np.maximum(n, 1), 1.0)
        cut = np.where(in_it & keep[owner], (c - DISCOUNT) / np.maximum(n[owner], 1), 0.0)
        share[where] = cut[seq]
        del can, where, seq, begin, c, head, owner, q, in_it, cut
    p[at] = np.where(mine, share + rest[ctx] * p[at], p[at])
    del share
    if level < model.depth:
        alive = ~mine | (n[ctx] >= LEAST)
        at, ctx = at[alive], ctx[alive]
        del mine, n, rest, alive
        _descend(w, model, p, level + 1, at, ctx)


def subtree(w: Windows, model: Model) -> np.ndarray:
    """Logarithm of each window's probability over that without context. All windows of the contexts that aren't hot are here."""
    p = _after_hot(w, model)
    _descend(w, model, p, 1, np.arange(len(w.word), dtype=np.int32), np.zeros(len(w.word), np.int32))
    p /= _base(w.count, model)
    return np.log10(p, out=p)


def _score_buckets(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = held.value
        slots = _slots(model)
        for _, blobs in _gathered(batches):
            blobs.sort(key=lambda x: x[0])
            w, _, sizes = _opened(blobs, model)
            gain = np.rint(subtree(w, model) * SCALE).astype(np.int64)
            begin = np.cumsum(sizes) - sizes
            new = w.row != 0
            new[begin] = True
            start = np.flatnonzero(new)  # of a text's windows in a blob
            gain, own = np.add.reduceat(gain, start), np.searchsorted(start, begin)
            row = np.cumsum(w.row[start], dtype=np.int64)
            sizes = np.diff(np.append(own, len(start)))
            step = np.repeat(np.array([x for x, _ in blobs], np.int64), sizes)
            row += (step << _ROWS) + np.repeat(w.row[start[own]].astype(np.int64) - row[own], sizes)
            del w, new, start
            slot = _bucket_of(_mix(step, np.zeros(1, np.int64)), slots).astype(np.min_scalar_type(slots))
            slot[gain == 0] = slots
            order = np.argsort(slot, kind="stable")[: int((gain != 0).sum())]
            gain, row, slot = gain[order], row[order], slot[order].astype(np.int64)
            if len(order):
                new = np.concatenate(([True], slot[1:] != slot[:-1]))
                edges = np.append(np.flatnonzero(new), len(slot))
                blobs = _pieces([np.where(new, row, np.diff(row, prepend=0)), gain], edges, np.zeros((0, 1), np.int64), np.zeros_like(edges))
                yield _blobs([(i, 0, blob) for i, blob in zip(slot[edges[:-1]].tolist(), blobs, strict=True)])
            give_back()

    return run


def _slots(model: Model) -> int:
    """Groups of steps that sums are collected by: fewer than buckets, as every bucket has a blob for each."""
    return min(max(model.buckets // 4, 12), SLOTS)


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, blobs in _gathered(batches):
        row = gain = np.zeros(0, np.int64)
        while blobs:
            own, n = [], 0
            while blobs and n < SUMS:  # a few at a time: what is held grows with the texts, not with the buckets
                own.append(blobs.pop()[1])
                n += _SIZES.unpack_from(own[-1])[0]
            (distance, more), sizes, _ = _joined(own, [np.int64, np.int64])
            begin, sums = np.cumsum(sizes) - sizes, np.cumsum(distance)
            row = np.concatenate((row, sums + np.repeat(distance[begin] - sums[begin], sizes)))
            order, start, _ = _runs(row)
            row, gain = row[order][start], np.add.reduceat(np.concatenate((gain, more))[order], start)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(gain)], names=["row", "gain"])


def _texts(held, names: list[str]):
    """One row for each text: what needs no context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = held.value
        for batch in batches:
            ids = batch.column(0)
            for i, row in enumerate(batch.select(range(1, batch.num_columns)).to_pylist()):
                (codes,) = _unpack(row["codes"])
                t = np.concatenate((model.head.train, np.array(row["other_t"], np.int64)))[codes.astype(np.int64)]
                sizes = np.array(row["size"], np.int64)
                start = np.cumsum(sizes) - sizes
                add = lambda x: pa.array(np.add.reduceat(x, start))  # noqa: B023, E731
                rows = pa.array((row["step"] << _ROWS) + np.arange(len(sizes)))
                yield pa.RecordBatch.from_arrays([ids[i].values, rows, pa.array(row["train"], pa.bool_()), pa.array(sizes), add((t > 0).astype(np.int64)), add(np.log10(_base(t, model)))], names=names)
        give_back()

    return run


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", depth: int = 3, limit: int | None = None) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score), one row per row; the rows that `train` marks are learnt from.

    A null mark is no mark. base_score is without contexts, score that of the tree with contexts of up to `depth` words.
    """
    if depth < 1:
        raise ValueError("depth must be at least 1")
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counts = rows.select("text", "train").mapInArrow(_count_words, "w long, t long, a long").groupBy("w")
    counted = materialize(counts.agg(F.sum("t").alias("t"), F.sum("a").alias("a")), "lm-words")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    total, distinct, everything = counted.agg(zero("t"), zero((F.col("t") > 0).cast("int")), zero("a")).first()
    head, complete = _head(counted)
    kind = rows.schema["id"].dataType.simpleString()
    names = ["step", "id", "size", "train", "codes", "other", "other_t", "other_a"]
    schema = f"step long, id array<{kind}>, size array<long>, train array<boolean>, codes binary, other array<long>, other_t array<long>, other_a array<long>"
    coded = materialize(rows.mapInArrow(_write_steps(sc.broadcast((head, complete)), names), schema), "lm-steps")
    if not complete:
        coded = _tell_rare(coded, counted)
    for level in range(1, depth + 1):
        coded = coded.withColumn(f"told{level}", F.lit(None).cast("array<struct<bucket:bigint,blob:binary>>"))
    limit = max(limit or LIMIT, everything // HOT)
    model = Model(head, total, distinct, depth, limit, max(1, -(-everything // BUCKET)), [], (_asks(head.both[head.both > limit].sum()),))
    hot_next = bool((head.both[1:] > limit).any())
    while hot_next and len(model.hot) < depth:
        coded, model, hot_next = _tell_hot(coded, model)
    held = sc.broadcast(model)
    sent = coded.drop("id").mapInArrow(_send(held), _BLOBS).repartition(_parts(model), "bucket").sortWithinPartitions("bucket")
    sums = sent.mapInArrow(_score_buckets(held), _BLOBS).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sum_rows, "row long, gain long")
    names = ["doc_id", "row", "train", "n_tokens", "n_known", "base_score"]
    texts = coded.select("id", "step", "size", "train", "codes", "other_t").mapInArrow(_texts(held, names), f"doc_id {kind}, row long, train boolean, n_tokens long, n_known long, base_score double")
    out = texts.join(materialize(sums, "lm-sums"), "row", "left")
    gain = F.coalesce(F.col("gain") / F.lit(SCALE), F.lit(0.0))
    return out.select("doc_id", "train", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", (F.col("base_score") + gain).alias("score"))


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, 7) == 2


def digest(docs: DataFrame) -> DataFrame:
    out = score(docs, ~held_out(F.col("doc_id")))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
