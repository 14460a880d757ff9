"""Parsers for raw text rows: posts, key/value profiles, HTML cells, and
code search in posts.  All row-local JVM expressions (no Python workers, no
shuffle) except :func:`match_posts`, which joins tokens with the code list.
"""

from __future__ import annotations

import html.entities
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawhouse.functions.mapping import EXCHANGE_NAMES, country_codes, map_or_keep
from rawhouse.functions.text import (
    NULL_TOKENS,
    POST_TS_FORMAT,
    after_last,
    before_last,
    null_if_token,
    parse_date,
    parse_timestamp,
    split_get,
    title_case,
)


def parse_posts(
    df: DataFrame,
    col: str = "value",
    ts_formats: Sequence[str] = (POST_TS_FORMAT,),
) -> DataFrame:
    """``code,date,content (may hold commas and newlines),author`` lines.

    The date is the second field; the author is what follows the last comma
    (quotes removed) and the content what lies between the date and that
    comma (trimmed, newlines written as a literal ``\\n``).  Lines whose date
    does not parse, such as a header line, are dropped.
    """
    parts = F.split(F.col(col), ",", 3)
    rest = F.get(parts, 2)
    out = df.select(
        F.trim(F.get(parts, 0)).alias("t_code"),
        parse_timestamp(F.get(parts, 1), ts_formats).alias("t_date"),
        F.replace(after_last(rest), F.lit('"'), F.lit("")).alias("t_author"),
        F.trim(F.replace(before_last(rest), F.lit("\n"), F.lit("\\n"))).alias("t_content"),
    )
    return out.where(F.col("t_date").isNotNull())


def parse_kv_profile(
    df: DataFrame,
    fields: Mapping[str, int],
    col: str = "value",
    null_tokens: Sequence[str] = NULL_TOKENS,
    keep_commas: Sequence[str] = (),
) -> DataFrame:
    """Wide rows from key,value texts: field ``name`` is the value on line
    ``fields[name]`` (0-based).  Missing lines, ``''`` and ``'N/A'`` give
    NULL.  Values are cut at their first comma unless the field is listed in
    ``keep_commas``."""
    lines = F.split(F.col(col), "\n")
    cols = []
    for name, idx in fields.items():
        line = F.get(lines, idx)
        if name in keep_commas:
            value = F.when(F.instr(line, ",") > 0, F.substring(line, F.instr(line, ",") + 1, 1 << 30))
        else:
            value = split_get(line, ",", 1)
        cols.append(null_if_token(value, null_tokens).alias(name))
    return df.select(*cols)


def clean_profile(
    df: DataFrame,
    title_cols: Sequence[str] = ("city", "sector", "industry"),
    country_col: str | None = "country",
    exchange_col: str | None = "exchange",
    date_cols: Sequence[str] = ("ipo_date",),
    countries: Mapping[str, str] | None = None,
    exchanges: Mapping[str, str] = EXCHANGE_NAMES,
) -> DataFrame:
    """Unify spellings: ISO country codes, canonical exchange names, title
    case (``str.title`` rules), typed dates.  Columns not present are skipped."""
    present = set(df.columns)
    repl: dict[str, Column] = {}
    for c in title_cols:
        if c in present:
            repl[c] = title_case(c)
    if country_col and country_col in present:
        repl[country_col] = map_or_keep(country_col, countries or country_codes())
    if exchange_col and exchange_col in present:
        repl[exchange_col] = map_or_keep(exchange_col, exchanges)
    for c in date_cols:
        if c in present:
            repl[c] = parse_date(c)
    return df.withColumns(repl)


# Character references by name, the ones without an end sign ("eacute" beside
# "eacute;") included, and the numbers that parsers read as Windows-1252.  The
# frequent ones come first: a literal map is searched from its start.
_FREQUENT = ("amp;", "quot;", "lt;", "gt;", "apos;", "nbsp;", "middot;", "copy;", "ndash;", "mdash;", "hellip;", "lsquo;", "rsquo;")
_LATIN = [name + end for name in html.entities.name2codepoint for end in (";", "") if name + end in html.entities.html5]
NAMED_REFERENCES = {n: html.entities.html5[n] for n in (*_FREQUENT, *_LATIN, *html.entities.html5)}
_WINDOWS = {f"#{i:X}": text for i in range(0x80, 0xA0) if (text := bytes([i]).decode("cp1252", "ignore"))}
_OPEN_NAMES = "|".join(sorted((n for n in NAMED_REFERENCES if not n.endswith(";")), key=lambda n: (-len(n), n)))
_REFERENCE = "&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);?"

_TAG = r"<(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"


def decode_references(c: Column) -> Column:
    """Text with its character references decoded as a parser does, in one pass
    from left to right: decimal, hexadecimal and all names of HTML
    (:data:`NAMED_REFERENCES`); others stay as they are."""
    table = F.str_to_map(
        F.lit("\x01".join(f"{name}\x02{text}" for name, text in (NAMED_REFERENCES | _WINDOWS).items())), F.lit("\x01"), F.lit("\x02")
    )

    def char(number: Column) -> Column:
        digits = F.regexp_extract(number, "^(?:[xX]0*|0*)([0-9A-Fa-f]*)$", 1)
        point = F.when(number.rlike("^[xX]"), F.upper(digits)).otherwise(F.hex(digits.try_cast("bigint")))
        long = F.lpad(point, 8, "0")
        valid = (F.length(digits) <= 8) & (long <= "0010FFFF") & ~long.rlike("^0000D[89A-F]") & (long > "00000000")
        return F.when(valid, F.coalesce(F.element_at(table, F.concat(F.lit("#"), point)), F.decode(F.unhex(long), "UTF-32")))

    def text(ref: Column) -> Column:
        number = F.regexp_extract(ref, "^&#([^;]+);?$", 1)
        name = F.substring(ref, 2, 1 << 30)
        begins = F.regexp_extract(name, f"^(?:{_OPEN_NAMES})", 0)  # "&notx" is read as "&not" and an x
        rest = F.when(begins != "", F.concat(F.element_at(table, begins), F.substr(name, F.length(begins) + 1)))
        return F.when(number != "", F.coalesce(char(number), F.lit("\ufffd"))).otherwise(F.coalesce(F.element_at(table, name), rest, ref))

    between = F.split(c, _REFERENCE, -1)
    found = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    pieces = F.zip_with(between, found, lambda plain, ref: F.concat(plain, F.when(ref.isNull(), "").otherwise(text(ref))))
    return F.when(F.contains(c, F.lit("&")), F.array_join(pieces, "")).otherwise(c)


def html_cell_pairs(
    df: DataFrame,
    html_col: str,
    id_cols: Sequence[str] = (),
    tag: str = "td",
    names: tuple[str, str] = ("code", "name"),
) -> DataFrame:
    """Consecutive ``<tag>`` cell texts paired up: cells 0-1, 2-3, ...

    Comments are dropped first; a tag may hold ``>`` in a quoted attribute.
    Cell text is the inner text with tags removed, character references decoded
    and spaces trimmed.  Every complete pair is kept (the last one too); a
    trailing unpaired cell is not reported.  Pairs are built inside each row, so
    there is no shuffle.
    """
    cell_re = rf"(?is)<{tag}(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*)?>(.*?)</{tag}\s*>"
    plain = F.regexp_replace(F.col(html_col), "(?s)<!--.*?-->", "")
    cells = F.transform(
        F.regexp_extract_all(plain, F.lit(cell_re), F.lit(1)),
        lambda c: F.trim(decode_references(F.regexp_replace(c, _TAG, ""))),
    )
    staged = df.select(*id_cols, cells.alias("_cells"))
    n_pairs = F.floor(F.size("_cells") / 2).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), n_pairs - 1),
        lambda i: F.struct(
            i.alias("pair"),
            F.element_at("_cells", i * 2 + 1).alias(names[0]),
            F.element_at("_cells", i * 2 + 2).alias(names[1]),
        ),
    )
    guarded = F.when(n_pairs > 0, pairs).otherwise(F.array())
    return staged.select(*id_cols, F.inline(guarded))


def match_posts(
    posts: DataFrame,
    codes: DataFrame,
    text_col: str,
    id_cols: Sequence[str],
    code_col: str = "code",
    prefix: str = "$",
    lang_col: str | None = None,
    lang: str | None = None,
    date_col: str | None = None,
    since=None,
    exclude_reposts: bool = True,
) -> DataFrame:
    """Posts mentioning a code: one row per (code, post).

    A mention is ``prefix`` followed by a token of letters and digits that may
    hold single ``.``, ``-`` or ``/`` inside (``$BRK.B``).  A token names the
    longest code it begins with, whole parts only (``$BRK.B`` names BRK.B, or
    BRK where BRK.B is no code; ``$ABCD`` never names ABC).  Punctuation at the
    ends of tokens and codes does not count.  Reposts (text starting with
    ``RT ``), other languages and posts before ``since`` are skipped.  Each
    post's distinct tokens are joined with the distinct codes; Spark sizes the
    join at run time (broadcast when the code list is small).
    """
    p = posts
    if lang_col and lang is not None:
        p = p.where(F.col(lang_col) == F.lit(lang))
    if date_col and since is not None:
        p = p.where(F.col(date_col) >= F.lit(since))
    if exclude_reposts:
        p = p.where(~F.col(text_col).startswith("RT "))
    esc = "".join("\\" + ch if not ch.isalnum() else ch for ch in prefix)
    token_re = rf"{esc}([\p{{L}}\p{{N}}]+(?:[./-][\p{{L}}\p{{N}}]+)*)"
    found = F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(token_re), F.lit(1)))
    tokens = p.select(*id_cols, F.explode(found).alias("_tok"))
    # A token and its shorter forms, the longest first; most have one form.  The
    # parts are split once; a form is as long as its parts with a sign between each.
    parts = F.split(F.col("_tok"), "[./-]")
    shorter = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.substr(F.col("_tok"), F.lit(1), F.length(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - i), "."))),
    )
    compound = F.contains("_tok", F.lit(".")) | F.contains("_tok", F.lit("-")) | F.contains("_tok", F.lit("/"))
    forms = F.when(compound, shorter).otherwise(F.array("_tok"))
    tried = tokens.select(*id_cols, "_tok", F.posexplode(forms).alias("_cut", "_form"))
    codes_in = codes.select(F.col(code_col).alias("_code")).where(F.col("_code").isNotNull()).distinct()
    wanted = codes_in.select("_code", F.regexp_replace("_code", r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "").alias("_bare"))
    hits = tried.join(wanted.where("_bare <> ''"), tried["_form"] == wanted["_bare"])
    longest = Window.partitionBy(*id_cols, "_tok")
    best = hits.withColumn("_least", F.min("_cut").over(longest)).where("_cut = _least")
    return best.select(F.col("_code").alias(code_col), *id_cols).distinct()
