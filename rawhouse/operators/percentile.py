"""Exact grouped percentiles by rank-verified selection.

``percentile(v, p)`` keeps every value of a group in one task; a group holding a
third of the table would sit in one task's memory.  Here a group's values are
gathered only once they are at most ``GATHER``:

1. groups of at most ``GATHER`` rows are gathered, sorted and read at their two
   positions around ``(n - 1) * p``;
2. every other group is narrowed by counting.  A round deals the values that may
   still hold a wanted rank into buckets by a monotone function of the value (its
   sign and binary exponent first, equal parts of the bracket later), counts each
   bucket with its smallest and largest value (combined on the map side), and
   keeps the one bucket whose counts enclose the rank.  Counts below are exact,
   so a rank cannot be missed; a bracket that would not enclose its rank raises.
   Rounds end when a bracket holds one value or at most ``GATHER`` rows, which are
   then gathered.  Each round of equal parts divides the bracket's width by
   ``PARTS``, so a handful of rounds exhausts any doubles.

Large groups thus cost a few scans of their own rows, small ones none.  The frame
is written once to the shared folder first (unless the caller has stored it), so
all passes see the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawhouse.session import materialize

ACCURACY = 10_000  # of method='approx': the sketch's rank error is n / ACCURACY at most
GATHER = 100_000  # most rows of one group that are gathered
PARTS = 4096  # buckets of a round that divides a bracket


def _same(a: DataFrame, b: DataFrame, left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[p].eqNullSafe(b[q]) for p, q in zip(left, right)], F.lit(True))


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    specs: Sequence[tuple[str, str, float]],
    method: str = "exact",
    accuracy: int = ACCURACY,
    stored: bool = False,
    gather: int = GATHER,
) -> DataFrame:
    """Exact interpolated percentiles per group, one row for every group.

    ``specs`` is a list of ``(output name, value column, p)``.  NULL values are
    ignored; a group whose values are all NULL for a column gets NULL; NaN counts
    as the largest value.  Equal neighbours give exactly their value.  ``stored``
    says that ``df`` is read from files, so it need not be written before it is
    read more than once.  ``gather`` bounds the rows of one group that one task
    holds.  ``method='approx'`` gives the ``percentile_approx`` sketch itself (rank
    error about n / accuracy, one pass).
    """
    by = list(by)
    if method == "approx":
        return df.groupBy(*by).agg(*[
            F.percentile_approx(F.col(c).cast("double"), float(p), accuracy).alias(n) for n, c, p in specs
        ])
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")
    cols = list(dict.fromkeys(c for _, c, _ in specs))
    keys = [f"_g{i}" for i in range(len(by))]
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)],
        *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)],
    )
    if not stored:
        rows = materialize(rows, "percentile-input")
    places = [(cols.index(c), float(p)) for _, c, p in specs]
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > gather).select(*keys)
    if large.isEmpty():
        found = _gathered(rows, keys, len(cols), places)
    else:
        large = materialize(large, "percentile-large")
        few = rows.join(large, _same(rows, large, keys, keys), "left_anti")
        many = rows.join(large, _same(rows, large, keys, keys), "left_semi")
        found = _gathered(few, keys, len(cols), places).unionByName(_selected(many, large, keys, len(cols), places, gather))
    return found.select(
        *[F.col(k).alias(c) for k, c in zip(keys, by)], *[F.col(f"_p{j}").alias(n) for j, (n, _, _) in enumerate(specs)]
    )


def _between(n: Column, p: float, at: Callable[[Column], Column]) -> Column:
    """Spark's interpolation between the values ``at`` the positions around (n - 1) p."""
    position = (n - 1) * F.lit(p)
    low, high = at(F.floor(position)), at(F.ceil(position))
    mixed = (F.ceil(position) - position) * low + (position - F.floor(position)) * high
    return F.when((F.floor(position) == F.ceil(position)) | (low == high), low).otherwise(mixed)


def _gathered(rows: DataFrame, keys: list[str], n_cols: int, places: list[tuple[int, float]]) -> DataFrame:
    """Percentiles of groups whose values fit a list: (keys, _p0, _p1, ...)."""
    lists = rows.groupBy(*keys).agg(*[F.sort_array(F.collect_list(f"_v{i}")).alias(f"_l{i}") for i in range(n_cols)])
    out = []
    for j, (i, p) in enumerate(places):
        n = F.size(f"_l{i}")
        value = _between(n, p, lambda at, i=i: F.get(f"_l{i}", at.cast("int")))
        out.append(F.when(n > 0, value).alias(f"_p{j}"))
    return lists.select(*keys, *out)


def _scale(v: Column) -> Column:
    """A bucket that grows with the value: sign and binary exponent."""
    exponent = F.floor(F.log2(F.abs(v))) + 1200
    top = F.lit(5000).cast("long")
    return (
        F.when(F.isnan(v), top + 1).when(v == float("inf"), top).when(v == float("-inf"), -top)
        .when(v == 0, F.lit(0).cast("long")).when(v > 0, exponent).otherwise(-exponent)
    )


def _share(v: Column, low: Column, high: Column) -> Column:
    """Which of ``PARTS`` equal parts of a finite bracket a value lies in."""
    return F.least(F.floor((v - low) / (high - low) * PARTS), F.lit(PARTS - 1).cast("long"))


def _selected(many: DataFrame, large: DataFrame, keys: list[str], n_cols: int, places, gather: int) -> DataFrame:
    """Percentiles of groups of any size: (keys, _p0, _p1, ...).

    A target is one wanted rank of one column of one group: the bracket
    [_lo, _hi] that holds it, the number of values below and inside.
    """
    spread = F.posexplode(F.array(*[F.col(f"_v{i}") for i in range(n_cols)])).alias("_c", "_v")
    values = materialize(many.select(*keys, spread).where(F.col("_v").isNotNull()), "percentile-values")
    on = [*keys, "_c"]

    def targets() -> DataFrame:
        """Two ranks a place, from the exact counts of the first round."""
        asked = F.array(*[
            F.struct(F.lit(j).alias("_j"), F.lit(i).alias("_at"), F.lit(p).alias("_p"), F.lit(side).alias("_side"))
            for j, (i, p) in enumerate(places) for side in (0, 1)
        ])
        counts = values.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        each = counts.select(*on, "_n", F.inline(asked)).where("_at = _c")
        position = (F.col("_n") - 1) * F.col("_p")
        rank = F.when(F.col("_side") == 0, F.floor(position)).otherwise(F.ceil(position))
        return each.select(*on, "_j", "_side", "_n", rank.alias("_rank"))

    state = targets().select(
        *on, "_j", "_side", "_n", "_rank", F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_inside"),
        F.lit(float("-inf")).alias("_lo"), F.lit(float("nan")).alias("_hi"),
    )
    state, first, done = materialize(state, "percentile-targets"), True, None
    while True:
        going = state if first else state.where((F.col("_inside") > gather) & (F.col("_lo") < F.col("_hi")))
        if not first and going.isEmpty():
            break
        rest = None if first else state.where(~((F.col("_inside") > gather) & (F.col("_lo") < F.col("_hi"))))
        done = rest if done is None else done.unionByName(rest)
        state, first = materialize(_narrowed(values, going, keys, first), "percentile-targets"), False
    done = state if done is None else done.unionByName(state)
    bad = done.where((F.col("_rank") < F.col("_below")) | (F.col("_rank") >= F.col("_below") + F.col("_inside")))
    if not bad.isEmpty():
        raise RuntimeError("a percentile's bracket does not hold its rank")
    return _settled(values, done, large, keys, places)


def _narrowed(values: DataFrame, going: DataFrame, keys: list[str], first: bool) -> DataFrame:
    """The targets with the bucket that holds their rank as bracket."""
    on = [*keys, "_c"]
    t = going.select(*[F.col(c).alias(f"t{c}") for c in on], "_j", "_side", "_n", "_rank", "_below", "_lo", "_hi")
    met = values.join(t, _same(values, t, on, [f"t{c}" for c in on]))
    if first:
        bucket = _scale(F.col("_v"))
    else:
        met = met.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        bucket = _share(F.col("_v"), F.col("_lo"), F.col("_hi"))
    fixed = ["_j", "_side", "_n", "_rank", "_below"]
    counted = met.groupBy(*on, *fixed, bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("_inside"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    # One row a bucket: at most PARTS (or twice the exponents) a target.
    upto = Window.partitionBy(*on, "_j", "_side").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_end", F.col("_below") + F.sum("_inside").over(upto))
    hit = placed.where((F.col("_end") - F.col("_inside") <= F.col("_rank")) & (F.col("_rank") < F.col("_end")))
    return hit.select(
        *on, "_j", "_side", "_n", "_rank", (F.col("_end") - F.col("_inside")).alias("_below"), "_inside", "_lo", "_hi"
    )


def _settled(values: DataFrame, done: DataFrame, large: DataFrame, keys: list[str], places) -> DataFrame:
    """Values at the targets' ranks, interpolated."""
    on = [*keys, "_c"]
    sure = done.where(F.col("_lo").eqNullSafe(F.col("_hi"))).select(*keys, "_j", "_side", "_n", F.col("_lo").alias("_value"))
    open_ = done.where(~F.col("_lo").eqNullSafe(F.col("_hi")))
    t = open_.select(*[F.col(c).alias(f"t{c}") for c in on], "_j", "_side", "_n", "_rank", "_below", "_lo", "_hi")
    met = values.join(t, _same(values, t, on, [f"t{c}" for c in on])).where("_v >= _lo AND _v <= _hi")
    lists = met.groupBy(*keys, "_j", "_side", "_n", "_rank", "_below").agg(F.sort_array(F.collect_list("_v")).alias("_l"))
    read = lists.select(*keys, "_j", "_side", "_n", F.get("_l", (F.col("_rank") - F.col("_below")).cast("int")).alias("_value"))
    each = sure.unionByName(read).groupBy(*keys).agg(*[
        F.max(F.when((F.col("_j") == j) & (F.col("_side") == side), F.col(c))).alias(name)
        for j in range(len(places))
        for name, c, side in ((f"_n{j}", "_n", 0), (f"_a{j}", "_value", 0), (f"_z{j}", "_value", 1))
    ])
    full = large.select(*[F.col(k).alias(f"l{k}") for k in keys])
    full = full.join(each, _same(full, each, [f"l{k}" for k in keys], keys), "left")
    out = []
    for j, (_, p) in enumerate(places):
        low, high = F.col(f"_a{j}"), F.col(f"_z{j}")
        position = (F.col(f"_n{j}") - 1) * F.lit(p)
        mixed = (F.ceil(position) - position) * low + (position - F.floor(position)) * high
        out.append(F.when((F.floor(position) == F.ceil(position)) | (low == high), low).otherwise(mixed).alias(f"_p{j}"))
    return full.select(*[F.col(f"l{k}").alias(k) for k in keys], *out)


__all__ = ["ACCURACY", "GATHER", "percentiles"]
