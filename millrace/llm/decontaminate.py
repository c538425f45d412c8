"""Benchmark decontamination by a generalised suffix automaton.

The test items, as sequences of word numbers, are put in one automaton. Each document's words are streamed through it; the
longest matching length at every word says which words lie inside an occurrence of a window (`window` consecutive item words,
or a whole item of fewer). `remove_spans` cuts those spans out of the texts and drops documents over a coverage limit.

Words: ASCII-lower-cased runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`. Null and empty texts have no words and no hits. Items without
words match nothing; an item whose id is null still marks words, but is not listed. Repeated rows are each answered.
Items are split into shards of `shard_words` words, one automaton each. The documents are read once: a worker holds one automaton and
streams the texts it has buffered through one shard after another, so its memory is bounded whatever the size of the benchmark, which
is itself sent to all executors.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_texts, carried, give_back, unpacked

BUFFER = 64_000_000

_WORD = re.compile(rb"\S+")
#: Word bytes stay (capitals become small), all others become blanks.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class ItemAutomaton:
    """Suffix automaton of several items, with the items that own each window."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        seqs = []
        for name, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in text.translate(_FOLD).split()]
            if ids:
                seqs.append((name, ids))
                self._add(ids)
        self.least = min((min(len(ids), window) for _, ids in seqs), default=0)
        self._mark(seqs)
        self._pairs(seqs)

    def _add(self, ids: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in ids:
            if c in nxt[last] and length[nxt[last][c]] == length[last] + 1:
                last = nxt[last][c]
                continue
            if c in nxt[last]:
                last = self._split(last, c)
                continue
            cur = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, c)
            last = cur

    def _split(self, p: int, c: int) -> int:
        """The state of the longest word of p followed by c, cut off from the longer words of its class."""
        q = self.next[p][c]
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _step(self, v: int, n: int, c: int) -> tuple[int, int]:
        while v and c not in self.next[v]:
            v = self.link[v]
            n = self.length[v]
        return (self.next[v][c], n + 1) if c in self.next[v] else (0, 0)

    def _up(self, v: int, n: int) -> int:
        """The suffix state that holds the word's last n symbols."""
        while self.length[self.link[v]] >= n:
            v = self.link[v]
        return v

    def _mark(self, seqs: list[tuple[str | None, list[int]]]) -> None:
        self.owners: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str | None]]] = {}
        for name, ids in seqs:
            v = n = 0
            for c in ids:
                v, n = self._step(v, n, c)
                if n >= self.window and name is not None:
                    self.owners.setdefault(self._up(v, self.window), set()).add(name)
            if len(ids) < self.window:
                short.setdefault(self._up(v, len(ids)), []).append((len(ids), name))
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if found := short.get(v, []) + self.short.get(self.link[v], []):
                self.short[v] = found

    def _pairs(self, seqs: list[tuple[str | None, list[int]]]) -> None:
        """A bit table of the items' adjacent words: stretches without such pairs can't match and are not streamed."""
        size = 1 << max(16, (8 * sum(len(ids) for _, ids in seqs)).bit_length())
        self.bits, self.mask = np.zeros(size, bool), size - 1
        for _, ids in seqs:
            a = np.asarray(ids, np.int64)
            self.bits[self._code(a)] = True

    def _code(self, ids: np.ndarray) -> np.ndarray:
        return ((ids[:-1] * 0x9E3779B1) ^ (ids[1:] * 0x85EBCA77)) & self.mask

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Runs of at least `least` words that are known and adjacent in some item, perhaps."""
        if len(ids) < self.least:
            return []
        known = ids >= 0
        if self.least == 1:
            joined, more = known, 0
        else:
            joined = known[:-1] & known[1:]
            at = np.flatnonzero(joined)
            joined[at] = self.bits[(((ids[at] * 0x9E3779B1) ^ (ids[at + 1] * 0x85EBCA77)) & self.mask)]
            more = 1
        edge = np.diff(np.concatenate(([0], joined.view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - start + more >= self.least
        return list(zip(start[long].tolist(), (end[long] + more).tolist(), strict=True))

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words, end exclusive, and the items with an occurring window."""
        if not self.least or len(words) < self.least:
            return [], set()
        get = self.vocab.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        for a, b in self.stretches(ids):
            v = n = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                v, n = self._step(v, n, c)
                reach = 0
                if n >= self.window:
                    reach = self.window
                    names |= self.owners.get(self._up(v, self.window), set())
                if v in self.short:
                    for m, name in self.short[v]:
                        if m <= n:
                            reach = max(reach, m)
                            if name is not None:
                                names.add(name)
                if reach:
                    at = i + 1 - reach
                    while spans and spans[-1][1] >= at:
                        at = min(at, spans.pop()[0])
                    spans.append((at, i + 1))
        return spans, names


_built: dict[tuple, ItemAutomaton] = {}


def _automaton(shard, number: tuple, window: int) -> ItemAutomaton:
    """Built once in each Python worker, if there is one shard; else the last one is held."""
    if number not in _built:
        _built.clear()
        _built[number] = ItemAutomaton(shard.value, window)
    return _built[number]


class _Items:
    """The test items in shards, each a broadcast of bounded size, and all texts of a task streamed through every shard's automaton.

    Texts are held until they fill BUFFER bytes (with one shard, for no longer than a batch), so an automaton is built once for as many.
    """

    def __init__(self, benchmark: DataFrame, item_id: str, item_text: str, window: int, shard_words: int):
        if window < 1:
            raise ValueError("window must be at least 1")
        sc = benchmark.sparkSession.sparkContext
        self.window, self.name = window, uuid.uuid4().hex
        self.shards = [sc.broadcast(s) for s in _shards(benchmark, item_id, item_text, shard_words)]

    def buffers(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if len(self.shards) == 1 or size >= BUFFER:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def find(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Of each text's words, the merged spans of hit words and the items with an occurring window, over all shards."""
        found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
        for number, shard in enumerate(self.shards):
            auto = _automaton(shard, (self.name, number), self.window)
            for i, words in enumerate(texts):
                spans, names = auto.find(words)
                if spans:
                    found[i] = (_union(found[i][0], spans), found[i][1] | names)
        return found


def _shards(benchmark: DataFrame, item_id: str, item_text: str, shard_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    shard, words = [], 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text")).distinct()
    for name, text in rows.sort("name", "text").toLocalIterator():
        raw = (text or "").encode()
        n = len(raw.translate(_FOLD).split())
        if shard and words + n > shard_words:
            yield shard
            shard, words = [], 0
        shard.append((name, raw))
        words += n
    yield shard


def _union(one: list[tuple[int, int]], other: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if not one:
        return other
    merged: list[tuple[int, int]] = []
    for a, b in sorted([*one, *other]):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return merged


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, shard_words: int = 200_000) -> DataFrame:
    """The documents' rows with hit_spans array<int> (start, end, start, end ... in words), hit_items array<string> and hit_words long (count of words).

    Columns of docs of these names are replaced.
    """
    items = _Items(benchmark, item_id, item_text, window, shard_words)
    rows = carried(docs, text, text=F.col(text))
    names = ["hit_spans", "hit_items", "hit_words"]
    out = rows.select("row", "text", F.array().cast("array<int>").alias(names[0]), F.array().cast("array<string>").alias(names[1]), F.lit(0).cast("long").alias(names[2]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items.buffers(batches):
            texts = [(raw or b"").translate(_FOLD).split() for raw in byte_texts(batch.column(1))]
            found = items.find(texts)
            spans = pa.array([[x for span in s for x in span] for s, _ in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans, pa.array([sorted(n) for _, n in found], pa.list_(pa.string())), pa.array([len(t) for t in texts], pa.int64())], names=["row", "text", *names])
        give_back()

    return rows.mapInArrow(scan, out.schema).select(*unpacked(docs.columns, **{n: F.col(n) for n in [text, *names]} | {text: F.col("text")}))


def cut_words(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans; a line feed stands where each was."""
    at = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    return b"\n".join([*out, raw[done:]])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, max_coverage: float = 0.5, shard_words: int = 200_000) -> DataFrame:
    """The documents, with their columns, without spans of item windows; those with more than max_coverage of their words hit are dropped.

    A cut can bring words together that form a window, so it repeats until no row has one. Null texts stay.
    """
    items = _Items(benchmark, item_id, item_text, window, shard_words)
    rows = carried(docs, text, text=F.col(text))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items.buffers(batches):
            raws = byte_texts(batch.column(1))
            kept, left, first = [True] * len(raws), list(range(len(raws))), True
            while left:
                texts = [(raws[i] or b"").translate(_FOLD).split() for i in left]
                found, again = items.find(texts), []
                for i, words, (spans, _) in zip(left, texts, found, strict=True):
                    if first and sum(b - a for a, b in spans) > max_coverage * len(words):
                        kept[i] = False
                    elif spans:
                        raws[i] = cut_words(raws[i], spans)
                        again.append(i)
                left, first = again, False
            fixed = pa.array(raws, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), fixed], names=["row", "text"]).filter(pa.array(kept, pa.bool_()))
        give_back()

    return rows.mapInArrow(clean, rows.schema).select(*unpacked(docs.columns, **{text: F.col("text")}))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: word, hit and item counts, and the hash of the hit items."""
    found = find_hits(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    pairs = F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.size("hit_spans"), F.lit(2)) - 2), lambda i: (i % 2 == 0) & (F.size("hit_spans") > 0)), lambda i: F.get("hit_spans", i + 1) - F.get("hit_spans", i))
    n_hit = F.aggregate(pairs, F.lit(0).cast("long"), lambda t, x: t + x)
    return found.select(
        "doc_id",
        F.col("hit_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
