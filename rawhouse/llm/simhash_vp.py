"""SimHash near-duplicates: 64-bit fingerprints linked at a few differing bits,
found with vantage-point trees.

Fingerprint: a text's word shingles are hashed with XXH64; a bit is 1 if it is
set in over half of the hashes (repeats count).

Search: equal fingerprints are merged first.  A vantage-point tree over a
bounded sample cuts Hamming space into shards; a fingerprint goes to every
shard whose region it comes within half the search radius of (the triangle
bound prunes the others).  Two fingerprints within the radius have a point
between them within half of it of both, and both are sent to the shard of that
point, so every pair within the radius meets in some shard.  Inside a shard the
same recursion goes on in numpy down to small leaves that are compared exactly.

A region that distances cannot cut (very many fingerprints within a few bits of
each other) is not compared pair by pair: there every fingerprint is listed
under itself and its 64 one-bit neighbours, and two fingerprints share such a
key exactly if they differ in at most two bits.  A key has 65 fingerprints at
most, so this way has no hot group and no cap.

Only links to a local representative leave a shard; components over all shards
come from ``components.connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawhouse.llm.common import LOWER_TABLE, free_name, map_texts
from rawhouse.llm.components import connected_components, merge_labels
from rawhouse.session import materialize

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
SAMPLE = 2_000_000  # most fingerprints the shard tree is built from (16 MB); every one is searched
SAMPLE_SHARE = 8  # and at most one in so many
SHARD_ROWS = 4096
LEAF_ROWS = 256
_PIECE = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 without words."""
    words = text.encode().translate(LOWER_TABLE).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _PIECE):
        hashes = np.array(
            [digest(line[s:e], seed) for s, e in zip(first[at : at + _PIECE].tolist(), last[at : at + _PIECE].tolist())],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def simhash(
    df: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    out: str = "fp",
    shingle: int = SHINGLE_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Columns ``keep`` with the fingerprint of each whole text as a long."""
    kept = keep if keep is not None else [c for c in df.columns if c.lower() != out.lower()]

    def factory():
        def run(texts):
            fps = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64)
            return {out: fps.view(np.int64)}

        return run

    return map_texts(df, text_col, kept, {out: "long"}, factory)


# --- the tree --------------------------------------------------------------


def _distance(fps: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(fps ^ to)


def _cut(fps: np.ndarray, half: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """A vantage point and threshold that cut ``fps`` best, or None where no
    cut leaves both sides clearly smaller."""
    best, found = 0.85 * len(fps), None
    for vantage in rng.choice(fps, size=min(8, len(fps)), replace=False):
        d = np.sort(_distance(fps, vantage))
        t = int(d[(len(d) - 1) // 2])
        for limit in (t - 1, t, t + 1):
            left = np.searchsorted(d, limit + half, side="right")
            right = len(d) - np.searchsorted(d, limit + 1 - half, side="left")
            if max(left, right) < best and min(left, right) > 0:
                best, found = max(left, right), (vantage, limit)
    return found


@dataclass(frozen=True)
class ShardTree:
    """Inner nodes: vantage point, threshold, children (left, right).  A child
    below zero is the shard ``-child - 1``; dense shards could not be cut."""

    vantage: np.ndarray
    limit: np.ndarray
    child: np.ndarray
    half: int
    n_shards: int
    dense: tuple[int, ...]

    def shards(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) for every shard a fingerprint has to visit."""
        rows, out_rows, out_shards = np.arange(len(fps)), [], []
        todo = [(0 if len(self.vantage) else -1, rows)]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                out_rows.append(at)
                out_shards.append(np.full(len(at), -node - 1, np.int64))
                continue
            d = _distance(fps[at], self.vantage[node]).astype(np.int64)
            todo.append((int(self.child[node, 0]), at[d <= self.limit[node] + self.half]))
            todo.append((int(self.child[node, 1]), at[d >= self.limit[node] + 1 - self.half]))
        if not out_rows:
            return rows, rows
        return np.concatenate(out_rows), np.concatenate(out_shards)


def build_tree(sample: np.ndarray, scale: float, shard_rows: int, half: int, seed: int = SEED) -> ShardTree:
    """Cut until a shard is expected to hold ``shard_rows`` of all fingerprints
    (each sampled one stands for ``scale``)."""
    rng = np.random.default_rng(seed)
    vantage, limit, child, dense, shards = [], [], [], [], 0

    def grow(fps: np.ndarray) -> int:
        nonlocal shards
        cut = None
        if len(fps) * scale > shard_rows and len(fps) > 16:
            cut = _cut(fps, half, rng)
            if cut is None and len(fps) * scale > 4 * shard_rows:
                dense.append(shards)
        if cut is None:
            shards += 1
            return -shards
        at = len(vantage)
        vantage.append(cut[0])
        limit.append(cut[1])
        child.append((0, 0))
        d = _distance(fps, cut[0]).astype(np.int64)
        child[at] = (grow(fps[d <= cut[1] + half]), grow(fps[d >= cut[1] + 1 - half]))
        return at

    grow(sample)
    return ShardTree(
        np.array(vantage, np.uint64), np.array(limit, np.int64), np.array(child, np.int64).reshape(-1, 2), half, shards, tuple(dense)
    )


# --- inside a shard ---------------------------------------------------------


def _by_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that join all fingerprints within two bits, by one-bit neighbours."""
    flips = np.concatenate(([np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)))
    keys = (fps[:, None] ^ flips[None, :]).ravel()
    owner = np.repeat(np.arange(len(fps)), 65)
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    same = keys[1:] == keys[:-1]
    return owner[:-1][same], owner[1:][same]


def link_shard(fps: np.ndarray, max_bits: int = MAX_BITS, seed: int = SEED) -> np.ndarray:
    """For each of the distinct fingerprints of a shard the index of the smallest
    member of its group of fingerprints linked at ``max_bits`` or fewer bits."""
    half, rng = (max_bits + 1) // 2, np.random.default_rng(seed)
    left, right, todo = [], [], [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        own = fps[at]
        cut = _cut(own, half, rng) if len(at) > LEAF_ROWS else None
        if cut is not None:
            d = _distance(own, cut[0]).astype(np.int64)
            todo += [at[d <= cut[1] + half], at[d >= cut[1] + 1 - half]]
        elif max_bits == 2 and len(at) > 8 * LEAF_ROWS:
            i, j = _by_keys(own)
            left.append(at[i])
            right.append(at[j])
        else:
            for row in range(0, len(at), LEAF_ROWS):
                near = np.bitwise_count(own[row : row + LEAF_ROWS, None] ^ own[None, :]) <= max_bits
                i, j = np.nonzero(near)
                ahead = j > i + row
                left.append(at[i[ahead] + row])
                right.append(at[j[ahead]])
    label = np.arange(len(fps))
    return merge_labels(label, np.concatenate(left), np.concatenate(right)) if left else label


def _edges_of_shards(sharded: DataFrame, max_bits: int) -> DataFrame:
    def link(table: pa.Table) -> pa.Table:
        fps = np.sort(table.column("fp").to_numpy()).view(np.uint64)
        label = link_shard(fps, max_bits)
        moved = np.flatnonzero(label != np.arange(len(fps)))
        return pa.table({"a": fps[moved].view(np.int64), "b": fps[label[moved]].view(np.int64)})

    return sharded.groupBy("shard").applyInArrow(link, "a long, b long")


def _edges_of_keys(fps: DataFrame) -> DataFrame:
    """Links at two bits or fewer by one-bit neighbours, in Spark (dense shards)."""
    keys = fps.select(
        "fp",
        F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])).alias("key"),
    )
    low = keys.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    return keys.join(low, "key").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def hamming_components(
    fps: DataFrame,
    col: str = "fp",
    max_bits: int = MAX_BITS,
    sample: int = SAMPLE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(fp, root) for every distinct fingerprint (a long): ``root`` is one
    fingerprint of its component under links at ``max_bits`` or fewer bits.

    The tree is built from one fingerprint in ``SAMPLE_SHARE``, ``sample`` at most,
    and cut while a shard is expected to hold more than ``shard_rows`` and 32 of the
    sample: shards are of one size up to ``sample / 32 * shard_rows`` distinct
    fingerprints (256 million as set), beyond it they grow with n / 62,500.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    spark = fps.sparkSession
    alone = materialize(fps.select(F.col(col).alias("fp")).where("fp IS NOT NULL").distinct(), "fingerprints")
    if max_bits == 0:
        return alone.select("fp", F.col("fp").alias("root"))
    n = alone.count()
    wanted = min(sample, n // SAMPLE_SHARE) if n > shard_rows else 0  # one shard needs no tree
    drawn = np.zeros(0, np.uint64)
    if wanted:
        taken = alone.where(F.pmod(F.xxhash64("fp"), F.lit(max(1, n // wanted))) == 0)
        drawn = taken.limit(2 * wanted).toArrow().column("fp").to_numpy().view(np.uint64)
    scale = n / max(1, len(drawn))
    tree = build_tree(np.sort(drawn), scale, max(shard_rows, int(32 * scale)), (max_bits + 1) // 2)
    shared = spark.sparkContext.broadcast(tuple(vars(tree).values()))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = ShardTree(*shared.value)
        for batch in batches:
            own = batch.column(0).to_numpy()
            row, shard = cuts.shards(own.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(shard)], names=["fp", "shard"])

    visits = alone.mapInArrow(visit, "fp long, shard long")
    dense = list(tree.dense) if max_bits == 2 else []
    edges = _edges_of_shards(visits.where(~F.col("shard").isin(dense)) if dense else visits, max_bits)
    if dense:
        edges = edges.union(_edges_of_keys(visits.where(F.col("shard").isin(dense)).select("fp").distinct()))
    linked = connected_components(edges)
    return alone.join(linked, alone["fp"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("root")
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    shingle: int = SHINGLE_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(id, fp, component_id) for every row: ``component_id`` is the smallest id
    reachable over links at ``max_bits`` or fewer differing bits.

    Defined results: a null or wordless text has fingerprint 0 and links like
    any other; ids that are null never name a component unless no other id is in
    it (then it is null); repeated rows are reported each; whole texts are used;
    no rows give no rows.
    """
    prints = materialize(
        simhash(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "text", ["id"], "fp", shingle, seed),
        "simhash",
    )
    groups = prints.groupBy("fp").agg(F.min("id").alias("low"))
    roots = hamming_components(prints, "fp", max_bits)
    member = groups.join(roots, "fp")
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(member.join(lowest, "root").select("fp", "component_id"), "simhash-components")
    return prints.join(named, "fp").select("id", "fp", "component_id")


def keep_first(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    shingle: int = SHINGLE_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row with
    the smallest id stays, all columns unchanged.

    A component without any id keeps one of its rows.  Rows that share the kept
    id with another row of the component (repeated rows) are reduced to one by
    the smallest hash of the row, so exactly one row of each component is left;
    rows that are equal in every column (maps aside) count as one.
    """
    ident, text, names = F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), df.columns
    others = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    row_key = F.xxhash64(F.coalesce(text.cast("string"), F.lit("")), text.isNull(), *others)
    prints = materialize(
        simhash(
            df.select(ident.alias("id"), text.alias("text"), row_key.alias("h")), "text", ["id", "h"], "fp", shingle, seed
        ),
        "simhash",
    )
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    groups = prints.groupBy("fp").agg(F.min(first).alias("first"))
    roots = hamming_components(prints, "fp", max_bits)
    winners = groups.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first"))
    win_id, win_h, own_h = (free_name(df, c) for c in ("win_id", "win_h", "own_h"))
    winners = materialize(winners.select(F.col("first.id").alias(win_id), F.col("first.h").alias(win_h)), "simhash-winners")
    kept = df.withColumn(own_h, row_key).join(
        winners, ident.eqNullSafe(F.col(win_id)) & (F.col(own_h) == F.col(win_h)), "left_semi"
    )
    if prints.groupBy("id", "h").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates([id_col, own_h])
    return kept.select(*[f"`{c}`" for c in names])


__all__ = ["ShardTree", "build_tree", "fingerprint", "hamming_components", "keep_first", "link_shard", "near_duplicates", "simhash"]
