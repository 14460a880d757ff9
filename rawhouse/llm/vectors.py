"""Embedding near-duplicates: random-hyperplane sign hashing in several tables,
exact cosine verification, distributed connected components.

Equal vectors are merged first (their links are counted, not listed).  Each
table hashes a unit vector to the signs of its products with ``bits`` random
hyperplanes; vectors with a common code meet in that table's bucket.  The
number of tables follows from the wanted recall: at the threshold cosine c a
bit agrees with probability 1 - arccos(c) / pi, so
tables = ln(1 - recall) / ln(1 - p ** bits).

Inside a bucket every pair is verified by its cosine in double precision, in
blocks of matrix products.  A pair is counted in the first table in which it
meets only, so a vector's number of links is a sum over buckets and no pair is
ever written.  Large buckets are cut into blocks that meet pairwise in separate
tasks.  What leaves a bucket is one row a vector: its links there and the
smallest vector it is linked with; components follow from those rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawhouse.llm.components import connected_components, merge_labels
from rawhouse.session import materialize

RECALL = 0.9999
BLOCK_ROWS = 2048
SEED = 42


def _plan(n: int, cosine: float, recall: float) -> tuple[int, int]:
    """Bits and tables for n distinct vectors: codes sparse enough that vectors
    without a near neighbour mostly sit alone in their bucket."""
    bits = max(8, min(40, round(math.log2(max(n, 2))) + 2))
    agree = 1 - math.acos(cosine) / math.pi
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree**bits)))


class _Buckets:
    """Links inside the buckets of one batch: rows sorted by bucket, one dimension."""

    def __init__(self, flat, dim, node, copies, cosine, codes_of) -> None:
        self.x = flat.reshape(-1, dim).astype(np.float64)
        self.unit = self.x / np.sqrt((self.x * self.x).sum(axis=1))[:, None]
        self.node, self.copies, self.cosine, self.codes_of = node, copies, cosine, codes_of
        self.links = np.zeros(len(node), np.int64)
        self.label = np.arange(len(node))

    def _exact(self, i: np.ndarray, j: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Whether pairs reach the threshold; close calls by one fixed formula,
        so that every table decides a pair alike."""
        ok = s >= self.cosine
        close = np.flatnonzero(np.abs(s - self.cosine) < 1e-9)
        for c in close.tolist():
            a, b = sorted((int(i[c]), int(j[c])), key=lambda r: self.node[r])
            u, v = self.x[a], self.x[b]
            ok[c] = math.fsum(u * v) / math.sqrt(math.fsum(u * u) * math.fsum(v * v)) >= self.cosine
        return ok

    def _first_met(self, i: np.ndarray, j: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Whether no table before ``table`` has brought a pair together."""
        if not len(i):
            return np.ones(0, bool)
        rows, place = np.unique(np.concatenate((i, j)), return_inverse=True)
        codes = np.concatenate([self.codes_of(self.x[rows[a : a + 4096]]) for a in range(0, len(rows), 4096)])
        out = np.empty(len(i), bool)
        for a in range(0, len(i), 1 << 15):
            p, q = place[: len(i)][a : a + (1 << 15)], place[len(i) :][a : a + (1 << 15)]
            same = codes[p] == codes[q]
            out[a : a + (1 << 15)] = same.argmax(axis=1) == table[a : a + (1 << 15)]
        return out

    def _count(self, i: np.ndarray, j: np.ndarray, table: np.ndarray) -> None:
        first = self._first_met(i, j, table)
        i, j = i[first], j[first]
        np.add.at(self.links, i, self.copies[j])
        np.add.at(self.links, j, self.copies[i])
        self.label = merge_labels(self.label, i, j)

    def small(self, start: np.ndarray, size: np.ndarray, table: np.ndarray) -> None:
        """Many small buckets at once: every pair at distance d in the row order."""
        end = np.repeat(start + size, size)
        row = np.concatenate([np.arange(a, a + n) for a, n in zip(start.tolist(), size.tolist())]) if len(start) else start
        tab = np.repeat(table, size)
        for d in range(1, int(size.max(initial=0))):
            on = row + d < end
            row, end, tab = row[on], end[on], tab[on]
            for a in range(0, len(row), 1 << 15):
                i = row[a : a + (1 << 15)]
                s = np.einsum("ij,ij->i", self.unit[i], self.unit[i + d])
                hit = self._exact(i, i + d, s)
                self._count(i[hit], i[hit] + d, tab[a : a + (1 << 15)][hit])

    def large(self, left: np.ndarray, right: np.ndarray, table: int) -> None:
        """One bucket (left is right) or a pair of its blocks, by matrix products."""
        for a in range(0, len(left), 256):
            p = left[a : a + 256]
            s = self.unit[p] @ self.unit[right].T
            i, j = np.nonzero(s >= self.cosine - 1e-9)
            value, i, j = s[i, j], p[i], right[j]
            if left is right:
                ahead = i < j
                value, i, j = value[ahead], i[ahead], j[ahead]
            hit = self._exact(i, j, value)
            self._count(i[hit], j[hit], np.full(int(hit.sum()), table))

    def found(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.links)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.node[some]), pa.array(self.links[some]), pa.array(self.node[self.label[some]])],
            names=["node", "n", "peer"],
        )


def distinct_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec, low, copies) of the usable vectors: the smallest id and number of rows of each."""
    v = F.col("vec")
    usable = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    own = own.where(v.isNotNull()).where(usable & F.exists(v, lambda x: x != 0))
    # A zero has two signs; adding 0.0 leaves one.
    own = own.withColumn("vec", F.transform(v, lambda x: x + F.lit(0.0)))
    return own.groupBy("vec").agg(F.min("id").alias("low"), F.count("*").alias("copies"))


def near_duplicate_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    recall: float = RECALL,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_links, component_id) for every row: how many other rows are linked
    directly at ``cosine`` or above, and the smallest id reachable.

    Defined results: vectors that are null, empty, zero or hold null or
    non-finite components link with nothing (0 links, own id as component), and
    so do vectors of different lengths with each other; equal rows link; a null
    id never names a component that has another id; no rows give no rows.
    """
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    spark = df.sparkSession
    merged = materialize(
        distinct_vectors(df, id_col, vector_col).withColumn("node", F.monotonically_increasing_id()), "vectors"
    )
    n = merged.count()
    bits, tables = _plan(n, cosine, recall)
    single = df.schema[vector_col].dataType.simpleString() == "array<float>"  # exact as floats

    planes: dict[int, np.ndarray] = {}  # by dimension, drawn from the seed where needed

    def codes_of(flat: np.ndarray, dim: int) -> np.ndarray:
        if dim not in planes:
            planes[dim] = np.random.default_rng(seed).standard_normal((dim, tables * bits))
        signs = (flat.reshape(-1, dim).astype(np.float64) @ planes[dim] >= 0).reshape(-1, tables, bits)
        return signs @ (1 << np.arange(bits, dtype=np.int64))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, node = batch.column(0), batch.column(1).to_numpy()
            dims = pa.compute.list_value_length(vec).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                flat = np.asarray(vec.take(pa.array(at)).flatten())
                codes = codes_of(flat, int(dim))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node[at]),
                        pa.array(np.full(len(at), dim, np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, tables), pa.int32()), pa.array(codes.ravel())),
                    ],
                    names=["node", "dim", "codes"],
                )

    coded = merged.select("vec", "node").mapInArrow(hashed, "node long, dim int, codes array<long>")
    met = coded.select("node", "dim", F.posexplode("codes").alias("tab", "code"))
    # Only buckets with company are fetched with their vectors.
    sizes = met.groupBy("dim", "tab", "code").agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / F.lit(block_rows)).cast("int")
    seats = met.join(sizes, ["dim", "tab", "code"]).select(
        "node", "dim", "tab", "code", blocks.alias("nb"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("mine")
    )
    # Every block meets every block: the pair (x, y), x <= y, holds the rows of both.
    seats = seats.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "node", "dim", "tab", "code", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine"
    )
    bucket = ["dim", "tab", "code", "x", "y"]
    loaded = (
        seats.join(merged.select("node", F.col("vec").cast("array<float>").alias("vec") if single else "vec", "copies"), "node")
        .select(*bucket, "node", "mine", "copies", "vec")
        .repartition(*bucket)
        .sortWithinPartitions(*bucket, "node")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            keys = np.stack([table[c].to_numpy() for c in bucket])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            last = int(edges[-1]) if len(edges) else 0  # the last bucket may go on
            rest = table.slice(last)
            yield from _done(table.slice(0, last))
        if rest is not None:
            yield from _done(rest)

    def _done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        dims = table["dim"].to_numpy()
        for dim in np.unique(dims).tolist():
            part = table.filter(pa.array(dims == dim))
            keys = np.stack([part[c].to_numpy() for c in bucket])
            start = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1))
            size = np.diff(np.concatenate((start, [keys.shape[1]])))
            flat = np.asarray(part["vec"].combine_chunks().flatten())
            work = _Buckets(
                flat, dim, part["node"].to_numpy(), part["copies"].to_numpy(), cosine, lambda x: codes_of(x, int(dim))
            )
            tab, x, y, mine = keys[1], keys[3], keys[4], part["mine"].to_numpy()
            few = (size <= 32) & (x[start] == y[start])
            work.small(start[few], size[few], tab[start[few]])
            for a, n in zip(start[~few].tolist(), size[~few].tolist()):
                rows = np.arange(a, a + n)
                if x[a] == y[a]:
                    work.large(rows, rows, int(tab[a]))
                else:
                    work.large(rows[mine[rows] == x[a]], rows[mine[rows] == y[a]], int(tab[a]))
            yield work.found()

    found = materialize(loaded.mapInArrow(verify, "node long, n long, peer long"), "vector-links")
    return _labelled(df, merged, found, id_col, vector_col)


def _labelled(df: DataFrame, merged: DataFrame, found: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    linked = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    named = merged.join(linked, "node", "left").join(roots, "node", "left").select(
        "vec", "low", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("root")
    )
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select(
        F.col("vec").alias("own_vec"), (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    own = own.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
    return own.join(named, own["vec"] == named["own_vec"], "left").select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.when(F.col("own_vec").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


__all__ = ["distinct_vectors", "near_duplicate_vectors"]
