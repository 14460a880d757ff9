"""Toxic passages: maximum-scoring segments over token log-odds.

Training: words and their beginnings (hashed to 2 ** ``BITS`` buckets) are
counted once a document in toxic and other labelled documents; a bucket's value is its log-odds
with an informative Dirichlet prior (the joint counts), used only where its
z-score is significant.  A word scores by the most significant of itself and its
beginnings, so inflected and compound forms that were never seen still count,
minus a small drift that makes the expected score of ordinary text negative.
All maximal scoring segments of a text are found in one pass (Ruzzo and Tompa).
A segment's expected number of chance occurrences follows the extreme-value
law, E = K n exp(-lambda S): lambda solves sum p exp(lambda s) = 1 over the
ordinary documents' words, K is fitted to their best segments.  The evidence of
a text's segments is aggregated and mapped to a probability by a logistic curve
fitted on the training documents.

The classifier is fitted on a bounded sample: at most ``TRAIN_ROWS`` labelled
documents a class, drawn by a hash of the id (the sample's share is corrected
by weights).  Scoring covers all documents and whole texts.

Defined results: null and empty texts score like a text without evidence; rows
with a null label are not learned; without both classes every score is 0; a
document that is labelled twice counts twice; repeated rows score equally; texts
of any length are read whole; a table without rows gives none; other columns of any
name are kept, except those called as the results, whose names can be chosen.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawhouse.llm.common import alnum_words, map_texts
from rawhouse.session import discard, materialize

BITS = 20
TRAIN_ROWS = 20_000
PRIOR_SHARE = 0.05  # weight of the joint counts as prior
PREFIXES = (5, 6, 7, 8)  # bytes
MIN_Z = 4.0
MIN_ODDS = 1.0
SIGNIFICANT = 0.05
CACHE_WORDS = 400_000  # words a task remembers before it starts anew


def _units(word: bytes, bits: int) -> list[int]:
    """Buckets of a word and of its beginnings."""
    shift = 32 - bits
    parts = [word, *(word[:k] + b"*" for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(p) >> shift for p in parts]


class _WordScores(dict):
    """Score of a word, worked out when it is first met."""

    def __init__(self, model: dict) -> None:
        super().__init__()
        self.bits, self.value, self.z, self.drift = model["bits"], model["value"], model["z"], model["drift"]

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        units = _units(word, self.bits)
        best = max(units, key=self.z.__getitem__)
        got = float(self.value[best if self.z[best] > 0 else units[0]]) - self.drift
        self[word] = got
        return got


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score), left to right,
    in time linear in the number of scores."""
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    at = np.flatnonzero(scores > 0)
    first: list[int] = []
    last: list[int] = []
    low: list[float] = []  # sum before the segment
    high: list[float] = []  # sum up to its end
    link: list[int] = []  # nearest segment before it with a smaller ``low``
    for i, before, after in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist()):
        start, end = i, i + 1
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= before:
                j = link[j]
            if j < 0 or high[j] >= after:
                first.append(start)
                last.append(end)
                low.append(before)
                high.append(after)
                link.append(j)
                break
            start, before = first[j], low[j]
            del first[j:], last[j:], low[j:], high[j:], link[j:]
    return [(a, b, h - l) for a, b, l, h in zip(first, last, low, high)]


def _sample(labels: DataFrame, value: int, rows: int) -> tuple[DataFrame, float]:
    """At most ``rows`` labelled ids of a class, and how many each stands for."""
    own = labels.where(F.col("toxic") == value).withColumn("h", F.xxhash64("id"))
    n = own.count()
    if n > rows:
        own = own.where(F.pmod("h", F.lit(-(-n // rows))) == 0).orderBy("h").limit(rows)
    return own.select("id", "toxic"), float(n)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = TRAIN_ROWS,
    bits: int = BITS,
) -> dict:
    """Fit on ``labels`` (id, 0/1) of ``docs``; returns plain arrays to broadcast."""
    spark, size = docs.sparkSession, 1 << bits
    given = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where("id IS NOT NULL")
    ones, n_ones = _sample(given, 1, rows)
    zeros, n_zeros = _sample(given, 0, rows)
    drawn = ones.union(zeros)  # 2 * rows small rows at most
    text = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # Three passes read the sample: it is written once, not drawn from all documents again.
    learn = materialize(text.join(F.broadcast(drawn), "id").select("toxic", "text"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size), np.int64)
        for batch in batches:
            seen = (Counter(), Counter())
            for label, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[label].update(set(alnum_words(one.as_py())))  # once a document
            for label in (0, 1):
                for word, n in seen[label].items():
                    for unit in _units(word, bits):
                        sums[label, unit] += n
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], names=["bucket", "n0", "n1"]
        )

    counted = learn.mapInArrow(count, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = counted.toArrow()  # at most one row a bucket
    y = np.zeros((2, size))
    at = got["bucket"].to_numpy()
    y[0, at], y[1, at] = got["n0"].to_numpy(), got["n1"].to_numpy()
    model = {
        "bits": bits, "value": np.zeros(size, np.float32), "z": np.zeros(size, np.float32), "drift": 1.0, "lam": 1.0, "k": 1.0,
        "curve": None,
    }
    if not y[0].any() or not y[1].any():
        discard(learn)
        return model
    n = y.sum(axis=1)
    alpha = PRIOR_SHARE * y.sum(axis=0) + 1e-9
    odds = [np.log((y[c] + alpha) / ((1 + PRIOR_SHARE) * n[c] - y[c])) for c in (0, 1)]
    delta = odds[1] - odds[0]
    z = delta / np.sqrt(1 / (y[0] + alpha) + 1 / (y[1] + alpha))
    strong = (z >= MIN_Z) & (delta >= MIN_ODDS)
    against = np.where(z <= -MIN_Z, np.clip(delta, -1.0, 0.0), 0.0)
    model["value"] = np.where(strong, np.minimum(delta, 8.0), against).astype(np.float32)
    model["z"] = np.where(strong, z, 0.0).astype(np.float32)

    # Distribution of the scores of ordinary words, for the drift and lambda:
    # counted by value (to two decimals) over the sampled documents.
    model["drift"] = 0.0
    first = spark.sparkContext.broadcast(model)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, sums = _WordScores(first.value), Counter()
        for batch in batches:
            for label, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                if label == 0:
                    words = alnum_words(one.as_py())
                    sums.update(np.rint(100 * np.fromiter(map(scores.__getitem__, words), np.float64, len(words))).astype(int).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["v", "n"]
        )

    values = learn.mapInArrow(spread, "v long, n long").groupBy("v").agg(F.sum("n").alias("n")).toArrow()
    usual, score = values["n"].to_numpy().astype(float), values["v"].to_numpy() / 100.0
    usual /= usual.sum()
    model["drift"] = max(0.05, float(usual @ score) + 0.05)
    model["lam"] = _root(usual, score - model["drift"])

    # Second pass over the same documents: the best segments of ordinary texts
    # give K, all texts give the curve.
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _WordScores(shared.value)
        for batch in batches:
            best, length, whole = [], [], []
            for one in batch.column(1):
                found, words = _segments(one.as_py(), scores)
                best.append(max((s for _, _, s in found), default=0.0))
                whole.append(sum(s for _, _, s in found))
                length.append(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.float64()), pa.array(whole, pa.float64()), pa.array(length, pa.int64())],
                names=["toxic", "best", "whole", "n"],
            )

    seen = learn.mapInArrow(measure, "toxic int, best double, whole double, n long").toArrow()
    discard(learn)
    label, best, length = (seen[c].to_numpy() for c in ("toxic", "best", "n"))
    plain = (label == 0) & (length > 0)
    lam = model["lam"]
    centred = lam * best[plain] - np.log(length[plain])
    model["k"] = float(np.clip(np.exp(np.mean(centred) - 0.5772), 1e-6, 1.0)) if plain.any() else 1.0
    x = np.stack([_evidence(b, w, n, model) for b, w, n in zip(best, seen["whole"].to_numpy(), length)])
    share = {c: v / max(1, (label == c).sum()) for c, v in ((0, n_zeros), (1, n_ones))}
    weight = np.where(label == 1, share[1], share[0])
    model["curve"] = _logistic(x, label.astype(float), weight / weight.sum())
    return model


def _root(p: np.ndarray, s: np.ndarray) -> float:
    """The positive solution of sum p exp(lambda s) = 1 (1 without a positive score)."""
    if s.max() <= 0:
        return 1.0
    lo, hi = 0.0, 1.0
    while p @ np.exp(np.minimum(hi * s, 500.0)) < 1 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if p @ np.exp(np.minimum(mid * s, 500.0)) < 1 else (lo, mid)
    return max(hi, 1e-3)


def _segments(text: str | None, scores: _WordScores) -> tuple[list[tuple[int, int, float]], int]:
    words = alnum_words(text)
    own = np.fromiter(map(scores.__getitem__, words), np.float64, len(words))
    return (maximal_segments(own) if (own > 0).any() else []), len(words)


def _evidence(best: float, whole: float, n: int, model: dict) -> np.ndarray:
    """Log evidence of the best segment and of all together, and of their density."""
    floor = math.log(max(model["k"] * n, 1e-9)) if n else 0.0
    top = model["lam"] * best - floor if best > 0 else 0.0
    every = model["lam"] * whole - floor if whole > 0 else 0.0
    return np.array([1.0, float(best > 0), np.log1p(max(top, 0.0)), np.log1p(max(every, 0.0)), math.sqrt(whole / n) if n else 0.0])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w = w + move * min(1.0, 2.0 / max(1e-9, float(np.abs(move).max())))
        if np.abs(move).max() < 1e-8:
            break
    return w


def score_toxicity(
    df: DataFrame,
    model: dict,
    text_col: str = "text",
    keep: list[str] | None = None,
    score_out: str = "score",
    passages_out: str = "passages",
) -> DataFrame:
    """Columns ``keep`` with the probability of toxicity and the significant
    passages as ``start:end`` in words (end exclusive)."""
    names = {score_out.lower(), passages_out.lower()}
    kept = keep if keep is not None else [c for c in df.columns if c.lower() not in names]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def factory():
        m = shared.value
        scores = _WordScores(m)

        def run(texts):
            score, passages = [], []
            for text in texts:
                found, n = _segments(text, scores)
                best, whole = max((s for _, _, s in found), default=0.0), sum(s for _, _, s in found)
                z = float(_evidence(best, whole, n, m) @ m["curve"]) if m["curve"] is not None else -math.inf
                score.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))) if z > -math.inf else 0.0)
                passages.append(
                    [f"{a}:{b}" for a, b, s in found if m["k"] * n * math.exp(-min(700.0, m["lam"] * s)) < SIGNIFICANT]
                )
            return {score_out: score, passages_out: passages}

        return run

    return map_texts(df, text_col, kept, {score_out: "double", passages_out: "array<string>"}, factory)


__all__ = ["maximal_segments", "score_toxicity", "train"]
