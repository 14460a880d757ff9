"""Benchmark decontamination by winnowing, in DataFrame functions only.

A document's word k-grams are hashed (64 bits) and the minimum hash of every
window of consecutive k-grams is kept as fingerprint, so any span as long as a
window that a document shares with a benchmark item carries the same
fingerprint on both sides.  Documents list one row a run of windows with the
same minimum, together with the gram hashes of the run; those rows join the
benchmark's fingerprints, and a hit is extended over its run by comparing the
two gram hashes that together cover every word of a window.

An item window has ``window`` words; an item with fewer words is one window of
its own length, for which the same construction runs at that length.

The text of a document never leaves the scan: joins carry hashes.  The
benchmark's fingerprints are broadcast only where their counted number is at
most ``BROADCAST_ROWS``; beyond it the same join shuffles both sides.

Defined results: a null text has no words; items without words or id match
nothing; equal item ids are one item; a null document id is a value of its own;
repeated rows are reported each; whole texts are used; without documents there
are no rows, without items nothing is contaminated; extra columns of any name do
no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawhouse.llm.common import free_name
from rawhouse.session import materialize

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 1_000_000  # benchmark windows, about 100 bytes each once hashed

_UPPER = "".join(map(chr, range(0x41, 0x5B)))
_SPLIT = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _SPLIT, _UPPER.lower() + " " * len(_SPLIT))
    return F.array_remove(F.split(plain, " +"), "")


def count_words(text: Column) -> Column:
    """Number of words (splitting is cheaper than a pattern's count)."""
    return F.size(words_of(text)).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def _span(window: int, gram: int) -> tuple[int, int]:
    """k-gram length and number of k-grams of a window."""
    k = min(gram, window)
    if window > 2 * k:
        raise ValueError("two grams must cover a window: gram >= window / 2")
    return k, window - k + 1


def _gram_hashes(words: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, k)))


def _runs(words: Column, window: int, gram: int) -> Column:
    """Array of runs of windows with one minimum: (t, start, fp, grams)."""
    k, w = _span(window, gram)

    def listed(hashes: Column) -> Column:
        # Minima by place: no slice is built for a window.
        lows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - w), lambda i: F.least(*[F.get(hashes, i + j) for j in range(w)])
        ) if w > 1 else hashes

        def runs(low: Column) -> Column:
            starts = F.filter(
                F.sequence(F.lit(1), F.size(low)),
                lambda i: (i == 1) | (F.get(low, i - 1) != F.get(low, i - 2)),
            )
            return _let(
                F.concat(starts, F.array(F.size(low) + 1)),
                lambda at: F.transform(
                    F.sequence(F.lit(0), F.size(at) - 2),
                    lambda j: F.struct(
                        F.lit(window).alias("t"),
                        F.get(at, j).alias("start"),
                        F.get(low, F.get(at, j) - 1).alias("fp"),
                        F.slice(hashes, F.get(at, j), F.get(at, j + 1) - F.get(at, j) + (w - 1)).alias("grams"),
                    ),
                ),
            )

        return _let(lows, runs)

    none = F.expr("CAST(array() AS array<struct<t:int,start:int,fp:bigint,grams:array<bigint>>>)")
    return F.when(F.size(words) >= window, _let(_gram_hashes(words, k), listed)).otherwise(none)


def benchmark_windows(
    items: DataFrame, id_col: str, text_col: str, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct item windows (t, fp, head, tail, items_key), the item lists
    (items_key, items), and the window lengths that occur.  ``head`` and
    ``tail`` hash the first and last k words, which cover the window."""
    worded = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), words_of(F.col(f"`{text_col}`")).alias("ws"))
    worded = worded.where("item IS NOT NULL AND size(ws) > 0").withColumn("t", F.least(F.size("ws"), F.lit(window)))
    lengths = sorted(r["t"] for r in worded.select("t").distinct().collect())  # at most ``window`` numbers
    parts = []
    for t in lengths:
        k, w = _span(t, gram)
        runs = worded.where(F.col("t") == t).select("item", F.explode(_runs(F.col("ws"), t, gram)).alias("r"))
        parts.append(_windows_of(runs.select("item", "r.*"), w).select("item", "t", "fp", "head", "tail"))
    if not parts:
        empty = worded.select("item", "t", F.lit(0).cast("long").alias("fp"), F.lit(0).cast("long").alias("head"), F.lit(0).cast("long").alias("tail"))
        parts = [empty.where("false")]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    listed = rows.groupBy("t", "fp", "head", "tail").agg(F.sort_array(F.collect_set("item")).alias("items"))
    # Counted, joined and listed below: worked out once.
    keyed = materialize(listed.withColumn("items_key", F.md5(F.concat_ws("\u0000", "items"))), "benchmark-windows")
    lists = keyed.groupBy("items_key").agg(F.first("items").alias("items"))
    return keyed.drop("items"), lists, lengths


def _windows_of(runs: DataFrame, w: int) -> DataFrame:
    """One row a window of each run of one window length: its start and two hashes."""
    return runs.withColumn("j", F.explode(F.sequence(F.lit(0), F.size("grams") - w))).select(
        "*",
        (F.col("start") + F.col("j")).alias("at"),
        F.get("grams", F.col("j")).alias("head"),
        F.get("grams", F.col("j") + (w - 1)).alias("tail"),
    )


def found_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """(hit_id, hit_hash, n_hit, items) of the documents that hold a window of an
    item: words inside such windows and the sorted item ids (as strings)."""
    benchmark, lists, lengths = benchmark_windows(items, item_id_col, item_text_col, window, gram)
    small = benchmark.count() <= BROADCAST_ROWS
    rows = _keyed(docs, id_col, text_col)
    worded = rows.select("id", "text_hash", words_of(F.col("text")).alias("ws"))
    each = F.concat(*[_runs(F.col("ws"), t, gram) for t in lengths or [window]])
    runs = worded.select("id", "text_hash", F.explode(each).alias("r")).select("id", "text_hash", "r.*")
    # Hits: join the fingerprints, then extend over the windows of the run.
    met = runs.join(F.broadcast(benchmark) if small else benchmark, ["t", "fp"])
    reach = F.col("t") - F.least(F.lit(gram), F.col("t"))  # from a window's first gram to its last
    hits = (
        met.withColumn("j", F.explode(F.sequence(F.lit(0), F.size("grams") - reach - 1)))
        .where((F.get("grams", F.col("j")) == F.col("head")) & (F.get("grams", F.col("j") + reach) == F.col("tail")))
        .select("id", "text_hash", (F.col("start") + F.col("j")).alias("at"), "t", "items_key")
    )
    per_doc = hits.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("at", "t"))).alias("spans"), F.collect_set("items_key").alias("keys")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["at"] + s["t"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["at"] + s["t"] - F.greatest(s["at"], acc["end"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return (
        per_doc.select("id", "text_hash", covered.alias("n_hit"), F.explode("keys").alias("items_key"))
        .join(lists, "items_key")
        .groupBy("id", "text_hash", "n_hit")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .select(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "n_hit", "items")
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, text_hash, n_words, n_hit, items, contaminated) for every document
    row; ``how`` takes the other parameters of ``found_items``."""
    base = _keyed(docs, id_col, text_col).select("id", "text_hash", count_words(F.col("text")).alias("n_words"))
    found = found_items(docs, items, id_col, text_col, **how)
    joined = base.join(
        found, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left"
    )
    return joined.select(
        "id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without any window of an item, all columns unchanged."""
    bad_id, bad_hash = free_name(docs, "bad_id"), free_name(docs, "bad_hash")
    bad = found_items(docs, items, id_col, text_col, **how).select(
        F.col("hit_id").alias(bad_id), F.col("hit_hash").alias(bad_hash)
    )
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(bad_id)) & (
        F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col(bad_hash)
    )
    return docs.join(bad, same, "left_anti")


__all__ = ["benchmark_windows", "contamination", "count_words", "drop_contaminated", "found_items", "words_of"]
