"""String similarities of 0 to 100, as pandas UDFs, and the nearest names of labels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def indel(a: str, b: str) -> float:
    """100 * 2 * longest common subsequence / both lengths, by a bit vector; two empty strings are equal."""
    if not a and not b:
        return 100.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask = (1 << len(a)) - 1
    v = mask
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & mask
    return 200.0 * (len(a) - v.bit_count()) / (len(a) + len(b))


def token_set(a: str, b: str) -> float:
    """The best of the common words against each side and of the sides against one another; 0 where a side has no word, 100 where one holds the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_x or not only_y):
        return 100.0
    left, right = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    return max(indel(left, right), *([indel(both, left), indel(both, right)] if both else [0.0]))


def _udf(f):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


def ratio(a, b):
    return _udf(indel)(a, b)


def token_set_ratio(a, b):
    return _udf(token_set)(a, b)


class Names:
    """Names in small letters, held so that a label is compared with all of them at once."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.small = [n.lower() for n in names]
        sets = [sorted(set(n.split())) for n in self.small]
        plain = [" ".join(words) for words in sets]
        self.lengths = np.array([len(p) for p in plain], dtype=np.int64)
        self.letters = {c: i for i, c in enumerate(sorted(set("".join(plain))), 1)}
        # One row for each position in a name, 0 beyond its end, the longest names first.
        self.order = np.argsort(-self.lengths, kind="stable")
        self.codes = np.zeros((int(self.lengths.max(initial=0)), len(plain)), dtype=np.int32)
        for at, i in enumerate(self.order):
            self.codes[: self.lengths[i], at] = [self.letters[c] for c in plain[i]]
        self.still = [int((self.lengths[self.order] > j).sum()) for j in range(len(self.codes))]
        self.where: dict[str, list[int]] = {}
        for i, words in enumerate(sets):
            for w in words:
                self.where.setdefault(w, []).append(i)
        self.plain = plain

    def indels(self, label: str) -> np.ndarray:
        """indel of the label and each name's sorted words, in blocks of 64 letters of the label with a carry between them."""
        size, n = max(1, -(-len(label) // 64)), len(self.names)
        masks = np.zeros((size, len(self.letters) + 1), dtype=np.uint64)
        for i, c in enumerate(label):
            if c in self.letters:
                masks[i // 64, self.letters[c]] |= np.uint64(1 << (i % 64))
        v = np.full((size, n), np.uint64(0xFFFFFFFFFFFFFFFF))
        for j, live in enumerate(self.still):
            carry = np.zeros(live, dtype=np.uint64)
            for k in range(size):
                old = v[k, :live]
                u = old & masks[k][self.codes[j, :live]]
                total = old + u
                more = total < old
                total += carry
                carry = (more | (total < carry)).astype(np.uint64)
                v[k, :live] = total | (old - u)
        common = np.zeros(n, dtype=np.int64)
        for k in range(size):
            inside = np.uint64((1 << min(64, len(label) - 64 * k)) - 1) if len(label) > 64 * k else np.uint64(0)
            common += np.bitwise_count(~v[k] & inside).astype(np.int64)
        out = np.empty(n)
        out[self.order] = common
        return 200.0 * out / np.maximum(1, self.lengths + len(label))

    def nearest(self, label: str, least: float, keep: int) -> list[tuple[str, float]]:
        small = label.lower()
        words = set(small.split())
        if not words:
            return []
        # Without a common word the score is that of the sorted words; only names that share one need the other forms.
        scores = np.round(self.indels(" ".join(sorted(words))), 6)
        scores[self.lengths == 0] = 0.0
        for i in {i for w in words for i in self.where.get(w, ())}:
            scores[i] = round(token_set(small, self.small[i]), 6)
        found = np.flatnonzero(scores >= least)
        return sorted(((self.names[i], float(scores[i])) for i in found), key=lambda x: (-x[1], x[0]))[:keep]


def shortlist(labels: DataFrame, names: DataFrame, least: float = 55.0, keep: int = 5, label_rows: int = 2000, name_rows: int = 20000) -> DataFrame:
    """(label, name, score, place): of each distinct label the `keep` nearest names that score `least` or more; ties to the smaller name.

    `labels` has label, `names` has name; nulls and words of blanks take no part. Each label is compared with every name, as no filter on
    words or letters is complete at this score: parts of the labels meet blocks of the names, and a block passes on its `keep` best.
    """
    left, right = labels.select("label").filter("label is not null").distinct(), names.select("name").filter("name is not null").distinct()
    parts, blocks = -(-left.count() // label_rows) or 1, -(-right.count() // name_rows) or 1
    dealt = left.select("label", F.pmod(F.xxhash64("label"), F.lit(parts)).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    held = right.select("name", F.pmod(F.xxhash64("name"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))

    def run(asked: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        block = Names(sorted(given["name"]))
        return pd.DataFrame([(label, *hit) for label in asked["label"] for hit in block.nearest(label, least, keep)] if len(given) else [], columns=["label", "name", "score"])

    scored = dealt.groupBy("part", "block").cogroup(held.groupBy("part", "block")).applyInPandas(run, "label string, name string, score double")
    by = Window.partitionBy("label").orderBy(F.desc("score"), "name")
    return scored.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= keep)
