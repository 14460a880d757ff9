"""Decoding small integer codes and flags into labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 12 pitch classes, code 0 .. 11 in this order.
PITCH_CLASSES = (
    "C", "C#/Db", "D", "D#/Eb", "E", "F", "F#/Gb", "G", "G#/Ab", "A", "A#/Bb", "B",
)
UNKNOWN = "Unknown"


def decode_code(code: Column | str, labels: Sequence[str] = PITCH_CLASSES, default: str = UNKNOWN) -> Column:
    """Label of a 0-based code; out-of-range codes and NULL give ``default``."""
    code = F.col(code) if isinstance(code, str) else code
    arr = F.array(*[F.lit(x) for x in labels])
    in_range = code.isNotNull() & (code >= 0) & (code < len(labels))
    return F.when(in_range, F.element_at(arr, code.cast("int") + 1)).otherwise(F.lit(default))


def flag_label(flag: Column | str, true_label: str = "Major", false_label: str = "Minor") -> Column:
    """Boolean to one of two labels; NULL takes the false label."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(flag, F.lit(true_label)).otherwise(F.lit(false_label))


def trend_label(short: Column, long: Column, precision: int = 9) -> Column:
    """'up' when the short mean is strictly above the long one, else 'down'.

    Both means are rounded first so that summation order cannot turn a tie
    into a flip.  Ties and NULLs give 'down'.
    """
    return F.when(F.round(short, precision) > F.round(long, precision), F.lit("up")).otherwise(F.lit("down"))
