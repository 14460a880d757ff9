"""Value mappings: unify spellings of the same entity.

Lookups are literal maps inside the plan (a few hundred entries at most), so
no join and no Python worker is involved.  Unmapped values pass through.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from rawhouse.functions.countries import COUNTRY_NAMES, OTHER_NAMES

# Exchange-name variants and their canonical name.
EXCHANGE_NAMES = {
    "NYSE": "New York Stock Exchange",
    "NYSEArca": "NYSE Arca",
    "AMEX": "NYSE American",
    "NasdaqCM": "NASDAQ Capital Market",
    "NasdaqGM": "NASDAQ Global Market",
    "NasdaqGS": "NASDAQ Global Select",
    "Nasdaq Global Select": "NASDAQ Global Select",
}

def _spellings(name: str) -> set[str]:
    """Spellings of an English country name by rule: "&", "and" or "and the", "St."
    or "Saint", a bracketed name on its own or in brackets of either kind, with and
    without accents."""
    out = {name}
    bracket = re.fullmatch(r"(.+?)\s*\((.+)\)", name)
    if bracket:
        out |= {bracket[1], bracket[2], f"{bracket[1]} [{bracket[2]}]"}
    out |= {re.sub(r"\bSt\.? ", "Saint ", n) for n in out}
    out |= {n.replace(" & ", joint) for n in out for joint in (" and ", " and the ")}
    out |= {n.replace("\u2019", "'") for n in out}
    out |= {"".join(c for c in unicodedata.normalize("NFKD", n) if not unicodedata.combining(c)) for n in out}
    out |= {n.replace(" SAR China", "") for n in out}
    return out


def country_codes(spark=None) -> dict[str, str]:
    """Country name -> ISO 3166 alpha-2 code, for every ISO code.

    The names are the package's own table (:mod:`rawhouse.functions.countries`),
    with variant spellings by rule; neither the Java
    runtime nor a file of the driver's machine is asked (``spark`` is not used).
    """
    out: dict[str, str] = {}
    for names in (COUNTRY_NAMES, OTHER_NAMES):
        for name, code in sorted(names.items(), key=lambda item: (item[1], item[0])):
            for spelling in sorted(_spellings(name)):
                out.setdefault(spelling, code)
    return out


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A ``map<string,string>`` literal column."""
    items: list[Column] = []
    for k, v in sorted(mapping.items()):
        items.extend([F.lit(k.strip()), F.lit(v)])
    return F.create_map(*items)


def map_or_keep(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Mapped value of ``c`` (keys compared trimmed), else ``c`` unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_element_at(literal_map(mapping), F.trim(c)), c)
