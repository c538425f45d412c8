"""Quality classifier by positive-unlabelled learning.

Trusted positives are the rows labelled 1 in the training folds; the unlabelled are documents of the training folds as they come.
The class prior is estimated from the two score distributions of a positive-against-unlabelled model, as the least ratio of their
tails over thresholds with an allowance for sampling error. The final model minimises the non-negative unbiased risk with that
prior: the unlabelled's risk of the negative class, less the prior's share of the positives', never counts below zero.

Inputs are figures of the text only (FEATURES). The fit uses SAMPLE positives and SAMPLE unlabelled at most, the first in the order
of a hash of doc_id; scoring covers every whole text. A null or empty text has the figures of no text and is scored by them. Without
a positive or unlabelled training row every score is 0.5. Repeated rows are each answered.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_texts, carried, crc_mod, give_back, unpacked

SAMPLE, FOLDS, CUT = 20_000, 5, 0.3
FEATURES = 22
_CLASS = np.full(256, 7, np.int64)  # 0 small, 1 capital, 2 digit, 3 blank, 4 line feed, 5 sentence signs, 6 other ASCII, 7 beyond
_CLASS[:128] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 3, 4
_CLASS[[44, 46, 33, 63, 59, 58, 39, 34]] = 5


def features(raw: bytes | None) -> list[float]:
    if not raw:
        return [0.0] * FEATURES
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) / len(raw)
    words = raw.split()
    n = max(len(words), 1)
    lines = raw.split(b"\n")
    marks = raw.count(b"!"), raw.count(b"|"), raw.count(b"#") + raw.count(b"$") + raw.count(b"%") + raw.count(b"&") + raw.count(b"*")
    same = sum(map(eq, words, words[1:]))
    distinct = len(set(words))
    return [
        *kinds.tolist(),
        np.log1p(len(words)),
        len(raw) / n / 10,
        distinct / n,
        np.log1p(distinct) / np.log1p(n),
        same / n,
        *(min(m / n, 2.0) for m in marks),
        sum(map(bytes.isupper, words)) / n,
        sum(map(bytes.istitle, words)) / n,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        (raw.count(b". ") + raw.count(b".\n")) / n,
        float(bool(kinds[0] > 0)),
    ]


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [np.array(features(raw), np.float64).tobytes() for raw in byte_texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], names=["id", "figures"])


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    """The figures of n rows at most, first in the order of a hash."""
    total = rows.count()
    if not total:
        return np.empty((0, FEATURES))
    h = F.xxhash64(F.col("id"), F.lit(11))
    some = rows if total <= n else rows.filter(F.pmod(h, F.lit(1_000_000)) < 1_200_000 * n / total)
    got = some.select("id", "text").mapInArrow(_figures, f"id {rows.schema['id'].dataType.simpleString()}, figures binary").withColumn("h", F.xxhash64("id")).orderBy("h", "id", "figures").limit(n).select("figures").toArrow().column(0).to_pylist()
    return np.frombuffer(b"".join(got)).reshape(-1, FEATURES)


def _expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -6, 6)
    return np.column_stack((z, z * z, np.ones(len(z))))


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -40, 40)))


def _adam(gradient, size: int, rounds: int = 600, rate: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        g = gradient(w) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio of the two shares of scores at or above a threshold, with an allowance that grows as the shares thin out."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.95, 60)))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    slack = np.sqrt(np.log(200) / 2 / len(positive)) + np.sqrt(np.log(200) / 2 / len(unlabelled))
    best = np.argmin((u + slack) / p)
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


class PUModel:
    """Logistic scores of expanded figures."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray):
        both = np.concatenate((positive, unlabelled))
        self.mean, self.scale = (both.mean(0), both.std(0) + 1e-3) if len(both) else (np.zeros(FEATURES), np.ones(FEATURES))
        self.w, self.prior = np.zeros(2 * FEATURES + 1), 0.5
        if len(positive) < 2 or len(unlabelled) < 2:
            return
        p, u = _expand(positive, self.mean, self.scale), _expand(unlabelled, self.mean, self.scale)

        def against(a: np.ndarray, b: np.ndarray):
            return lambda w: -(a.T @ _sigmoid(-a @ w)) / len(a) + (b.T @ _sigmoid(b @ w)) / len(b)

        # Two folds: each half is scored by the model of the other.
        sp, su = np.zeros(len(p)), np.zeros(len(u))
        for k in (0, 1):
            w = _adam(against(p[k::2], u[k::2]), p.shape[1], 200)
            sp[1 - k :: 2], su[1 - k :: 2] = p[1 - k :: 2] @ w, u[1 - k :: 2] @ w
        self.prior = estimate_prior(sp, su)
        prior = self.prior

        def risk(w: np.ndarray) -> np.ndarray:
            s, t = p @ w, u @ w
            negative = np.logaddexp(0, t).mean() - prior * np.logaddexp(0, s).mean()
            push = (u.T @ _sigmoid(t)) / len(u) - prior * (p.T @ _sigmoid(s)) / len(p)
            if negative < 0:  # below zero the fit has gone too far: step back
                return -push
            return -prior * (p.T @ _sigmoid(-s)) / len(p) + push

        self.w = _adam(risk, p.shape[1])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(_expand(x, self.mean, self.scale) @ self.w)


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, FOLDS) == 0


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> PUModel:
    """From training-fold rows only."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(~held_out(F.col("id")))
    trusted = labels.filter((F.col(quality) == 1) & ~held_out(F.col(doc_id))).select(F.col(doc_id).alias("id")).distinct()
    # The same hash thins both sides of the join to what the sample may take.
    total = trusted.count()
    if total > SAMPLE:
        trusted = trusted.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) < 1_200_000 * SAMPLE / total)
    return PUModel(_sample(rows.join(F.broadcast(trusted), "id", "left_semi"), SAMPLE), _sample(rows, SAMPLE))


def _scored(docs: DataFrame, model: PUModel, text: str) -> DataFrame:
    """(row, text, score): row is a struct of the other columns."""
    held, rows = docs.sparkSession.sparkContext.broadcast(model), carried(docs, text, text=F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(raw) for raw in byte_texts(batch.column(1))]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held.value.score(x), pa.float64())], names=["row", "text", "score"])
        give_back()

    return rows.mapInArrow(run, rows.withColumn("score", F.lit(0.5)).schema)


def score(docs: DataFrame, model: PUModel, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) added; a column of docs of that name is replaced."""
    return _scored(docs, model, text).select(*unpacked(docs.columns, **{text: F.col("text"), "score": F.col("score")}))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with their columns, that the classifier doesn't reject."""
    scored = _scored(docs, fit(docs, labels, doc_id, text), text)
    return scored.filter(F.col("score") >= CUT).select(*unpacked(docs.columns, **{text: F.col("text")}))
