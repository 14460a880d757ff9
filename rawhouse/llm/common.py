"""Helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text bytes one call of an operator's numpy code works on: a task's memory is
# bounded by this and the longest single text, not by the Arrow batch.
CHUNK_BYTES = 4 << 20

_ARROW = {
    "long": (T.LongType(), pa.int64()),
    "int": (T.IntegerType(), pa.int32()),
    "double": (T.DoubleType(), pa.float64()),
    "boolean": (T.BooleanType(), pa.bool_()),
    "string": (T.StringType(), pa.string()),
    "array<int>": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "array<long>": (T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    "array<string>": (T.ArrayType(T.StringType()), pa.list_(pa.string())),
}

# A-Z to a-z and every ASCII byte outside 0-9 A-Z a-z to a space; bytes of
# multi-byte characters stay.
ALNUM_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
# A-Z to a-z only.
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def alnum_words(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.encode().translate(ALNUM_TABLE).split() if text else []


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or a variant of it that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _slices(batch: pa.RecordBatch, text: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(offset, length) ranges of at most ``limit`` text bytes, one row at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(text), 0).to_pylist()
    start, used = 0, 0
    for i, size in enumerate(sizes):
        if i > start and used + size > limit:
            yield start, i - start
            start, used = i, 0
        used += size
    if sizes:
        yield start, len(sizes) - start


def map_texts(
    df: DataFrame,
    text_col: str,
    keep: list[str],
    out: dict[str, str],
    factory: Callable[[], Callable[[list[str | None]], dict[str, list]]],
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Columns ``keep`` of ``df`` plus the ``out`` columns (name -> type).

    ``factory`` runs once a task and returns a function from a list of texts to
    the lists of the out columns; it is called on slices of bounded size.  Rows
    are independent, so a lost executor only repeats its own partitions.
    """
    clash = {c.lower() for c in keep} & {c.lower() for c in out}
    if clash:
        raise ValueError(f"output columns clash with kept columns: {sorted(clash)}")
    inner = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    source = df.select(*inner, F.col(f"`{text_col}`").cast("string").alias("t"))
    schema = T.StructType(
        [T.StructField(f"k{i}", source.schema[i].dataType) for i in range(len(keep))]
        + [T.StructField(f"o{i}", _ARROW[t][0]) for i, t in enumerate(out.values())]
    )
    types, names, n_keep = [_ARROW[t][1] for t in out.values()], list(out), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = factory()
        labels = [f"k{i}" for i in range(n_keep)] + [f"o{i}" for i in range(len(names))]
        for batch in batches:
            text = batch.column(n_keep)
            for start, length in _slices(batch, text, chunk_bytes):
                part = batch.slice(start, length)
                got = fn(part.column(n_keep).to_pylist())
                arrays = [part.column(i) for i in range(n_keep)]
                arrays += [got[n] if isinstance(got[n], pa.Array) else pa.array(got[n], type=t) for n, t in zip(names, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=labels)

    return source.mapInArrow(run, schema).toDF(*keep, *names)


__all__ = ["ALNUM_TABLE", "CHUNK_BYTES", "LOWER_TABLE", "alnum_words", "free_name", "map_texts"]
