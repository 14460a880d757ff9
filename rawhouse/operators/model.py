"""Dimensional modelling: dictionaries, foreign keys, source merging, bridges.

None of these funnels a table through one task: dense ids come from range
partitions plus per-partition offsets, "first row per key" is a mergeable
``min`` over a struct (partial aggregation before the shuffle), and the
right side of every enrichment join is made unique on its key first so a
left join can never multiply rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from rawhouse.functions.text import reciprocal_fill
from rawhouse.session import default_parallelism, materialize

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position


def _and(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def build_dictionary(
    df: DataFrame,
    *cols: str,
    index_col: str = "id",
    drop_nulls: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Distinct tuples of ``cols`` with a dense 1-based id in sort order
    (ascending, NULLs first).  ``drop_nulls`` removes tuples holding a NULL.

    Same ids as ``row_number() OVER (ORDER BY cols)`` without a
    single-partition window: the distinct tuples are range-partitioned and
    sorted inside each partition; a tuple's id is the number of tuples in the
    earlier partitions (one small count per partition) plus its position in
    its own partition.  The numbered tuples are written once into the
    session's checkpoint folder so the count and the numbering read the very
    same rows, also when executors are lost and stages re-run.  The range
    exchange has an explicit partition count, so AQE keeps its partitions as
    they are, and the per-partition sort over distinct tuples is total, so a
    retried task numbers its rows identically.
    """
    spark = df.sparkSession
    n = num_partitions or default_parallelism(spark)
    order = [F.col(c).asc_nulls_first() for c in cols]
    d = df.select(*cols).distinct()
    if drop_nulls:
        d = d.where(_and([F.col(c).isNotNull() for c in cols]))
    numbered = (
        d.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    numbered = materialize(numbered)
    numbered = numbered.select(
        *cols,
        F.shiftright("_mid", _POS_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"),
    )
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: a tiny table, so an unpartitioned window is fine
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_off"))
    return numbered.join(F.broadcast(offsets), "_pid").select(
        *cols, (F.col("_off") + F.col("_pos") + 1).alias(index_col)
    )


def normalize(
    df: DataFrame,
    dictionary: DataFrame,
    cols: Sequence[str],
    index_col: str = "id",
    null_safe: bool = False,
    fill_reciprocal: bool = False,
    keep_cols: bool = False,
) -> DataFrame:
    """Replace the tuple columns by the dictionary id (left join: rows
    without a match keep a NULL id).

    ``null_safe`` matches NULL to NULL (for dictionaries built with
    ``drop_nulls=False``).  ``fill_reciprocal`` first fills each of two
    columns from the other when it is NULL.  The dictionary is unique on its
    tuple, so the row count never changes.
    """
    cols = list(cols)
    if fill_reciprocal:
        if len(cols) != 2:
            raise ValueError("fill_reciprocal needs exactly two columns")
        a, b = reciprocal_fill(cols[0], cols[1])
        df = df.withColumns({cols[0]: a, cols[1]: b})
    dic = dictionary.select(*[F.col(c).alias(f"_d_{c}") for c in cols], F.col(index_col))
    eq = (lambda l, r: l.eqNullSafe(r)) if null_safe else (lambda l, r: l == r)
    cond = _and([eq(df[c], dic[f"_d_{c}"]) for c in cols])
    out = df.join(dic, cond, "left").drop(*[f"_d_{c}" for c in cols])
    return out if keep_cols else out.drop(*cols)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one smallest in ``order`` then in the remaining
    columns (a total order, so the pick is deterministic).

    ``min(struct(...))`` is a mergeable aggregate: every map task keeps one
    row per key before the shuffle, so a hot key costs one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = list(order) + rest
    packed = F.struct(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)])
    g = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return g.select(*keys, *[F.col(f"_first._f{i}").alias(c) for i, c in enumerate(fields)]).select(*df.columns)


def merge_sources(a: DataFrame, b: DataFrame, key: str, order_by: Sequence[str] = ("name",)) -> DataFrame:
    """Merge two overlapping sources into one row per key, from whole records.

    Each source first picks one record per key (smallest ``order_by``, then the
    source's other columns).  The columns both sources have come from the
    smaller of the two picks (by ``order_by``, then source ``a`` before ``b``);
    columns only one source has come from that source's pick.  Values of
    different records of a source are never mixed.  One aggregation: both
    sources' picks are mergeable minima, one row per key and task.
    """
    common = [c for c in a.columns if c in b.columns]
    if key not in common:
        raise ValueError(f"both sources need the key column {key}")
    order = [c for c in order_by if c != key]
    sides = []
    for src, df in ((0, a), (1, b)):
        rest = [c for c in df.columns if c != key and c not in order]
        sides.append((src, df, [*order, *rest]))

    def packed(side: tuple) -> Column:
        return F.struct(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(side[2])])

    rows = [
        df.select(F.col(key), packed(side).alias(f"_r{src}")) for side in sides for src, df in [side[:2]]
    ]
    picks = (
        rows[0]
        .unionByName(rows[1], allowMissingColumns=True)
        .groupBy(key)
        .agg(F.min("_r0").alias("_r0"), F.min("_r1").alias("_r1"))
    )

    def field(side: tuple, c: str) -> Column:
        return F.col(f"_r{side[0]}._f{side[2].index(c)}")

    shared = [c for c in common if c != key]
    first = F.least(*[
        F.when(
            F.col(f"_r{side[0]}").isNotNull(),
            F.struct(
                *[field(side, c).alias(f"_o{i}") for i, c in enumerate(order)],
                F.lit(side[0]).alias("_src"),
                *[field(side, c).alias(f"_c{i}") for i, c in enumerate(shared)],
            ),
        )
        for side in sides
    ])
    merged = picks.withColumn("_first", first)
    return merged.select(
        *[F.col(key) if c == key else F.col(f"_first._c{shared.index(c)}").alias(c) for c in common],
        *[field(side, c).alias(c) for side in sides for c in side[1].columns if c not in common],
    )


# from_json options of the list-like text columns (Python list literals)
LIST_OPTIONS = {"allowBackslashEscapingAnyCharacter": "true", "allowSingleQuotes": "true"}


def parse_list(c: Column | str) -> Column:
    """``"['a', 'b']"`` -> ``array('a', 'b')``; malformed text -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.from_json(c, ArrayType(StringType(), containsNull=False), LIST_OPTIONS)


def explode_zipped(
    df: DataFrame,
    id_col: str,
    lists: dict[str, str],
    pad: bool = True,
    drop_null: str | None = None,
    pos_col: str | None = "pos",
) -> DataFrame:
    """Parse list-text columns and explode them side by side.

    ``lists`` maps output name -> list-text column.  Lists of unequal length
    are padded with NULL.  With ``pad`` a NULL or malformed list counts as an
    empty one, so the other lists still produce rows (without it such a row
    vanishes).  ``drop_null`` drops exploded rows whose named field is NULL.
    """
    parsed = {}
    for name, src in lists.items():
        arr = parse_list(src)
        parsed[name] = F.coalesce(arr, F.array().cast(ArrayType(StringType(), False))) if pad else arr
    staged = df.select(F.col(id_col), *[v.alias(k) for k, v in parsed.items()])
    zipped = F.arrays_zip(*[F.col(k) for k in lists])
    if pos_col:
        ex = staged.select(id_col, F.posexplode(zipped).alias(pos_col, "_t"))
        out = ex.select(id_col, pos_col, *[F.col(f"_t.{k}").alias(k) for k in lists])
    else:
        ex = staged.select(id_col, F.explode(zipped).alias("_t"))
        out = ex.select(id_col, *[F.col(f"_t.{k}").alias(k) for k in lists])
    if drop_null:
        out = out.where(F.col(drop_null).isNotNull())
    return out


def build_dimension(
    bridge_rows: DataFrame,
    attrs: DataFrame,
    ext_id: str = "a_ext_id",
    name: str = "a_name",
    index_col: str = "a_id",
    attr_name: str = "artists",
    attr_list: str = "genres",
    out_attr: str = "genres",
    fact_id: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """Entity dimension and bridge from exploded (fact, name, external id) rows.

    Returns ``(dimension, bridge)``: the dimension numbers the distinct
    ``(ext_id, name)`` tuples (NULLs kept) and attaches the attribute list
    found for the name (the attribute source is made unique per name first);
    the bridge maps each fact to the entity id with a NULL-safe join, so
    entities with a NULL external id keep their id.
    """
    dic = build_dictionary(bridge_rows, ext_id, name, index_col=index_col, drop_nulls=False)
    dim = _with_attributes(dic, attrs, name, attr_name, attr_list, out_attr).select(index_col, ext_id, name, out_attr)
    bridge = normalize(bridge_rows.select(fact_id, ext_id, name), dic, [ext_id, name], index_col, null_safe=True)
    return dim, bridge.select(F.col(fact_id).alias("track_id"), F.col(index_col).alias("artist_id"))


def _with_attributes(dic: DataFrame, attrs: DataFrame, name: str, attr_name: str, attr_list: str, out_attr: str) -> DataFrame:
    attr = first_per_key(
        attrs.select(F.col(attr_name).alias("_an"), F.col(attr_list).alias("_al")).where(F.col("_an").isNotNull()),
        "_an",
        ["_al"],
    ).select("_an", parse_list("_al").alias(out_attr))
    return dic.join(attr, dic[name] == attr["_an"], "left")


def build_dimension_from_texts(
    facts: DataFrame,
    attrs: DataFrame,
    names: str = "artists",
    ext_ids: str = "artist_ids",
    fact_id: str = "id",
    ext_id: str = "a_ext_id",
    name: str = "a_name",
    index_col: str = "a_id",
    attr_name: str = "artists",
    attr_list: str = "genres",
    out_attr: str = "genres",
) -> tuple[DataFrame, DataFrame]:
    """:func:`build_dimension` of facts that carry list texts, as
    :func:`explode_zipped` followed by it would give, but every distinct pair of
    texts is parsed and numbered once: facts of one album repeat their texts.

    The distinct texts (combined on the map side) are written once with a number
    each; the dictionary and each text's entity ids come from them, and facts get
    their ids by a NULL-safe join on the texts (unique on that side, so a text that
    very many facts share is an ordinary skewed join key).
    """
    texts = facts.select(F.col(names).alias("_names"), F.col(ext_ids).alias("_ext_ids")).distinct()
    texts = materialize(texts.withColumn("_text", F.monotonically_increasing_id()), "list-texts")
    credits = explode_zipped(texts, "_text", {name: "_names", ext_id: "_ext_ids"})
    dic = build_dictionary(credits, ext_id, name, index_col=index_col, drop_nulls=False)
    dim = _with_attributes(dic, attrs, name, attr_name, attr_list, out_attr).select(index_col, ext_id, name, out_attr)
    ids = normalize(credits.select("_text", ext_id, name), dic, [ext_id, name], index_col, null_safe=True)
    per_text = ids.groupBy("_text").agg(F.collect_list(index_col).alias("_ids")).withColumnRenamed("_text", "_of")
    known = texts.join(per_text, texts["_text"] == per_text["_of"]).select("_names", "_ext_ids", "_ids")
    own = facts.select(F.col(fact_id).alias("track_id"), F.col(names).alias("_n"), F.col(ext_ids).alias("_e"))
    met = own.join(known, own["_n"].eqNullSafe(known["_names"]) & own["_e"].eqNullSafe(known["_ext_ids"]))
    return dim, met.select("track_id", F.explode("_ids").alias("artist_id"))


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every column renamed to ``prefix + name`` except ``keep`` (one plan
    node, not one per column)."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def distinct_profile(
    df: DataFrame,
    *cols: str,
    drop_nulls: bool = False,
    limit: int | None = None,
    count_col: str = "n_rows",
) -> DataFrame:
    """Distinct tuples of ``cols`` with how many rows carry each.

    The number of distinct tuples is this frame's row count; nothing is
    collected to the driver.  ``limit`` keeps the first tuples in sort order
    (a preview; a per-partition top-n, not a global sort).
    """
    d = df
    if drop_nulls:
        d = d.where(_and([F.col(c).isNotNull() for c in cols]))
    out = d.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
    if limit is not None:
        out = out.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(limit)
    return out
