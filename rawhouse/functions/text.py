"""Column expressions for cleaning text fields.  All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens a raw source uses to mean "no value".
NULL_TOKENS = ("", "N/A")

# Timestamp layouts of raw post lines -- day/month first, and
# the ISO-like form a collector writes when it stringifies timestamps.
POST_TS_FORMAT = "d/M/yyyy H:mm"
ISO_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Letter runs and non-letter runs, alternating.
_RUNS = r"(\p{L}+|[^\p{L}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """NULL when the value is one of ``tokens``; NULL stays NULL."""
    c = _col(c)
    return F.when(~c.isin(*list(tokens)), c)


def title_case(c: Column | str) -> Column:
    """Python ``str.title`` semantics: a letter after any non-letter is upper.

    ``initcap`` only capitalises after white space (``O'fallon``); here the
    string is cut into alternating letter / non-letter runs and each run is
    capitalised on its own, so ``o'fallon st-denis 3m`` -> ``O'Fallon St-Denis 3M``.
    """
    runs = F.regexp_extract_all(_col(c), F.lit(_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def after_last(c: Column | str, sep: str = ",") -> Column:
    """Text after the last ``sep`` (the whole text when there is none)."""
    return F.substring_index(_col(c), sep, -1)


def before_last(c: Column | str, sep: str = ",") -> Column:
    """Text before the last ``sep`` (the whole text when there is none)."""
    if len(sep) != 1:
        raise ValueError("sep must be one character")
    esc = "\\" + sep if not sep.isalnum() else sep
    return F.regexp_replace(_col(c), F.lit(f"(?s){esc}[^{esc}]*$"), F.lit(""))


def split_get(c: Column | str, pattern: str, index: int, limit: int = -1) -> Column:
    """``split(c, pattern)[index]`` returning NULL when out of range (ANSI safe)."""
    return F.get(F.split(_col(c), pattern, limit), index)


def parse_timestamp(c: Column | str, formats: Sequence[str] = (POST_TS_FORMAT,)) -> Column:
    """First format that parses wins; unparsable text gives NULL.

    The result is a zone-free ``timestamp_ntz`` so it does not move with the
    session time zone.
    """
    c = _col(c)
    parsed = [F.try_to_timestamp(c, F.lit(f)) for f in formats]
    ts = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    return ts.cast("timestamp_ntz")


def parse_date(c: Column | str, formats: Sequence[str] | None = None) -> Column:
    """``try_to_date``; partial dates such as ``1999`` or ``1999-05`` give the
    first day, like a CSV date column does."""
    c = _col(c)
    if not formats:
        return F.try_to_date(c)
    return F.coalesce(*[F.try_to_date(c, F.lit(f)) for f in formats])


def int_flag(c: Column | str) -> Column:
    """0/1 integer flag as boolean; NULL stays NULL."""
    return _col(c) == 1


def reciprocal_fill(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """(a, b) with each one's NULL filled from the other, from the same row."""
    a, b = _col(a), _col(b)
    return F.coalesce(a, b), F.coalesce(b, a)


def pct_change(new: Column | str, base: Column | str) -> Column:
    """``(new - base) / base * 100``; NULL when base is 0 (ANSI safe)."""
    new, base = _col(new), _col(base)
    return F.try_divide(new - base, base) * F.lit(100.0)
