"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams in Spark (one pass, counts per task summed by a
shuffle); the model is one log-probability matrix, ``2 ** bits`` rows by one
column a language, whose size does not depend on the corpus.  It is broadcast,
and texts are scored in sparse batches: the matrix rows of all n-grams of a batch
of texts are gathered at once and summed text by text with one segmented sum.

Text is lower-cased and every run of characters that are not letters becomes
one space, so digits, punctuation and markup say nothing about the language.

Defined results: a null text or one without a letter is ``und`` with score 0;
a null label is never learned; without any labelled row every text is ``und``;
the smallest language name wins an exact tie; repeated rows get equal results;
a table without rows gives none; other columns of any name are kept, except those
called as the results, whose names can be chosen.  Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawhouse.llm.common import map_texts

UND = "und"
ORDERS = (1, 2, 3)
BITS = 15
PIECE_CHARS = 1 << 20  # characters hashed at a time; longer texts go in overlapping pieces


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter (built on the driver, broadcast)."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _codes(text: str, letters: np.ndarray) -> np.ndarray:
    """Code points with every run of non-letters as one space, one at either end."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters[raw]
    codes = np.full(len(raw) + 2, 32, np.uint32)
    codes[1:-1] = np.where(letter, raw, 32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def _ids(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Buckets of the n-grams of one code array, all orders together."""
    shift = np.uint64(64 - bits)
    wide = codes.astype(np.uint64)
    out = []
    for n in orders:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = (h + wide[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        if n == 1:  # lone spaces carry nothing
            h = h[wide != 32]
        out.append(((h * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def _grams(text: str | None, letters: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Bucket arrays of a whole text, in pieces that overlap by the n-gram length."""
    if not text:
        return
    codes = _codes(text, letters)
    if len(codes) <= 1:
        return
    if len(codes) <= PIECE_CHARS:
        yield _ids(codes, orders, bits)
        return
    for n in orders:
        for at in range(0, len(codes), PIECE_CHARS):
            piece = _ids(codes[at : at + PIECE_CHARS + n - 1], (n,), bits)
            if len(piece):
                yield piece


@dataclass(frozen=True)
class LanguageModel:
    """Language names in order and the log-probability matrix (bucket x language)."""

    langs: tuple[str, ...]
    logp: np.ndarray
    prior: np.ndarray
    orders: tuple[int, ...]
    bits: int


def train_language_model(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    orders: tuple[int, ...] = ORDERS,
    bits: int = BITS,
    alpha: float = 0.5,
) -> LanguageModel:
    """Fit the model on every row of ``df`` with a label.

    Each task adds up one count vector a language; those are summed by bucket
    in Spark.  The driver receives the finished matrix only: one number for a
    bucket and language.
    """
    size = 1 << bits
    rows = df.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).where("lang IS NOT NULL")
    letters = df.sparkSession.sparkContext.broadcast(letter_table())
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang not in sums:
                    sums[lang] = np.zeros(size + 1, np.int64)
                sums[lang][size] += 1
                for ids in _grams(text.as_py(), letters.value, orders, bits):
                    if len(ids) * 8 < size:
                        np.add.at(sums[lang], ids, 1)
                    else:
                        sums[lang][:size] += np.bincount(ids, minlength=size)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    counts = (
        rows.mapInArrow(count, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    )
    langs = tuple(sorted(counts["lang"].unique())) if len(counts) else ()
    table = np.zeros((size + 1, len(langs)))
    if langs:
        column = counts["lang"].map({v: i for i, v in enumerate(langs)}).to_numpy()
        table[counts["bucket"].to_numpy(), column] = counts["n"].to_numpy()
    docs, grams = table[size], table[:size]
    smooth = grams + alpha
    logp = np.log(smooth) - np.log(smooth.sum(axis=0, keepdims=True)) if langs else grams
    prior = np.log(docs / docs.sum()) if langs else docs
    return LanguageModel(langs, logp.astype(np.float32), prior, orders, bits)


def _batch_grams(texts: list[str], letters: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text each belongs to) of a batch of texts, an order at a time: the
    texts stand in one array, and no n-gram reaches over a border."""
    lowered = [t.lower() for t in texts]
    size = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 2
    start = np.cumsum(size) - size
    inner = np.ones(int(size.sum()), bool)
    inner[start] = inner[start + size - 1] = False
    raw = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.full(len(inner), 32, np.uint32)
    codes[inner] = np.where(letters[raw], raw, 32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    keep[start] = True
    codes, owner = codes[keep], np.repeat(np.arange(len(texts), dtype=np.int32), size)[keep]
    for n in orders:
        if len(codes) < n:
            continue
        inside = owner[: len(owner) - n + 1] == owner[n - 1 :]
        if n == 1:
            inside &= codes != 32  # as _ids leaves lone spaces out
            yield _ids(codes, (1,), bits)[inside[codes != 32]], owner[inside]
        else:
            yield _ids(codes, (n,), bits)[inside], owner[: len(inside)][inside]


def _totals(texts: list[str | None], logp, orders, bits, letters) -> tuple[np.ndarray, np.ndarray]:
    """Summed log-probabilities, and number of n-grams, of every text."""
    totals, counts = np.zeros((len(texts), logp.shape[1])), np.zeros(len(texts), np.int64)
    batch: list[int] = []

    def flush() -> None:
        if not batch:
            return
        rows = np.array(batch)
        for ids, owner in _batch_grams([texts[i] for i in batch], letters, orders, bits):
            if len(ids):
                first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                at = rows[owner[first]]
                totals[at] += np.add.reduceat(logp.take(ids, axis=0), first, axis=0, dtype=np.float64)
                counts[at] += np.diff(np.concatenate((first, [len(ids)])))
        batch.clear()

    used = 0
    for i, text in enumerate(texts):
        if text and len(text) > PIECE_CHARS:  # alone, in overlapping pieces
            for ids in _grams(text, letters, orders, bits):
                totals[i] += logp.take(ids, axis=0).sum(axis=0, dtype=np.float64)
                counts[i] += len(ids)
        elif text:
            if used + len(text) > PIECE_CHARS:
                flush()
                used = 0
            batch.append(i)
            used += len(text)
    flush()
    return totals, counts


def _scorer(langs, logp, prior, orders, bits, letters) -> Callable[[list[str | None]], tuple[list, list]]:
    def score(texts: list[str | None]) -> tuple[list, list]:
        if not langs:
            return [UND] * len(texts), [0.0] * len(texts)
        totals, counts = _totals(texts, logp, orders, bits, letters)
        totals += prior
        best = totals.argmax(axis=1)
        apart = np.exp(np.minimum(totals - totals[np.arange(len(texts)), best][:, None], 0)).sum(axis=1)
        conf = np.where(counts > 0, np.minimum(1.0, 1.0 / apart), 0.0)
        return [langs[b] if n else UND for b, n in zip(best.tolist(), counts.tolist())], conf.tolist()

    return score


def identify_language(
    df: DataFrame,
    model: LanguageModel,
    text_col: str = "text",
    keep: list[str] | None = None,
    lang_out: str = "lang_pred",
    score_out: str = "score",
) -> DataFrame:
    """Columns ``keep`` (default: all but the outputs' names) with the predicted
    language and its posterior probability."""
    names = {lang_out.lower(), score_out.lower()}
    kept = keep if keep is not None else [c for c in df.columns if c.lower() not in names]
    shared = df.sparkSession.sparkContext.broadcast(
        (model.langs, model.logp, model.prior, model.orders, model.bits, letter_table())
    )

    def factory():
        score = _scorer(*shared.value)
        return lambda texts: dict(zip((lang_out, score_out), score(texts)))

    return map_texts(df, text_col, kept, {lang_out: "string", score_out: "double"}, factory)


__all__ = ["LanguageModel", "UND", "identify_language", "train_language_model"]
