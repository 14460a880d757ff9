"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from rawhouse.llm.license_templates import PHRASES, TEMPLATES
from rawhouse.llm.licenses import parse
from rawhouse.llm.secrets_index import BASE_KINDS, RULES

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_ALNUM}')"


def _pattern(elements: list) -> str:
    """A template as a regular expression over a line of words, each followed by a space."""
    out = ""
    for e in elements:
        if isinstance(e, bytes):
            out += e.decode() + " "
        elif e[0] == "optional":
            out += f"(?:{_pattern(e[1])})?"
        else:
            out += f"(?:[^ ]+ ){{{e[1]},{'' if e[2] is None else e[2]}}}"
    return out


def _license_sql() -> str:
    rows = [(k, True, parse(v)) for k, v in PHRASES.items()] + [(k, False, parse(v)) for k, v in TEMPLATES]
    found = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, {base} AS base, {sum(isinstance(e, bytes) for e in elements)} AS m "
        f"FROM line WHERE regexp_matches(words, ' {_pattern(elements)}')"
        for label, base, elements in rows
    )
    places = " UNION ALL ".join(
        f"SELECT doc_id, i FROM word_at WHERE array_to_string(w[i + 1:i + {len(e)}], ' ') = '{b' '.join(e).decode()}'"
        for _, base, e in rows
        if base
    )
    return f"""
        WITH doc AS (SELECT doc_id, {_words("text")} AS w FROM documents),
        line AS (SELECT doc_id, ' ' || array_to_string(w, ' ') || ' ' AS words FROM doc),
        found AS ({found}),
        kinds AS (
            SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
                   coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
                   max(m) AS m
            FROM found GROUP BY doc_id),
        word_at AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM doc),
        place AS (
            SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word
            FROM ({places}) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               coalesce(1.0 - power(2.0, -m / 4.0), 0.0) AS score
        FROM doc LEFT JOIN kinds USING (doc_id) LEFT JOIN place USING (doc_id)"""


def _secret_sql() -> str:
    """Spans of every rule: the texts between its matches and the matches follow
    one another, so a match starts where the lengths before it end."""
    rows = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, regexp_split_to_array(text, {_quoted(r.pattern)}) AS gap,
                   regexp_extract_all(text, {_quoted(r.pattern)}) AS hit, regexp_extract_all(text, {_quoted(r.pattern)}, {r.group}) AS part
            FROM doc"""
        for k, r in enumerate(RULES)
    )
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in BASE_KINDS)
    return f"""
        WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        rule AS ({rows}),
        place AS (SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM rule),
        span AS (
            SELECT doc_id, k, kind, length(hit[i]) AS n, length(part[i]) AS n_part, least,
                   list_sum(list_transform(gap[:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(hit[:i - 1], lambda x: length(x))), 0) AS s
            FROM place),
        kept AS (
            SELECT doc_id, k, kind, CAST(s AS BIGINT) AS s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT) AS word
            FROM span WHERE n_part >= least),
        found AS (
            SELECT doc_id, {counts}, string_agg(word, ',' ORDER BY s, k) AS words,
                   string_agg(word, ',' ORDER BY s, k) FILTER (WHERE k < {len(BASE_KINDS)}) AS base
            FROM kept GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in BASE_KINDS)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(words, '') AS spans
        FROM doc LEFT JOIN found USING (doc_id)"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# CRC-32 of a decimal number, bit by bit (reversed polynomial).
_CRC = """xor(4294967295, list_reduce(
    list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda acc, b: list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(acc, b)),
    CAST(4294967295 AS BIGINT)))"""

SQL: dict[str, str] = {
    "op11_prefix_trie": f"""
        WITH conv AS (
            SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        part AS (SELECT c, own, {_CRC.format("c")} % 9 AS h FROM conv),
        rebuilt AS (
            SELECT part.c, list_concat(coalesce(head.own, part.own[:0])[:part.h], part.own[part.h + 1:]) AS turns
            FROM part LEFT JOIN conv AS head ON head.c = part.c - part.c % 5),
        step AS (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt),
        node AS (
            SELECT d, turns[:d] AS prefix, min(c) AS c, count(*) AS n,
                   string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(turns) = d) AS ends
            FROM step GROUP BY d, turns[:d]),
        child AS (SELECT prefix[:d - 1] AS prefix, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1),
        known AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN child ON node.prefix = child.prefix),
        below AS (
            SELECT prefix[:k] AS prefix, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves,
                   sum(CASE WHEN d > 0 THEN (n - 1) * strlen(prefix[d].text) ELSE 0 END) AS saved
            FROM (SELECT *, unnest(range(d + 1)) AS k FROM known) GROUP BY 1)
        SELECT known.c AS conv_id, CAST(known.d AS BIGINT) AS depth, above.c AS parent_conv_id, known.n AS n_convs,
               known.kids AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
               sha256(coalesce(known.ends, '')) AS ends_sha256
        FROM known JOIN below ON known.prefix = below.prefix
        LEFT JOIN known AS above ON known.d = above.d + 1 AND known.prefix[:known.d - 1] = above.prefix""",
    "op13_secret_scans": _secret_sql(),
    "op1_licenses": _license_sql(),
    "op3_decontamination": f"""
        WITH doc AS (SELECT doc_id, {_words("text")} AS w FROM documents),
        item AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
        item_window AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words
            FROM (SELECT item_id, w, least(len(w), 10) AS n,
                         unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
                  FROM item WHERE len(w) > 0)),
        place AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)),
        hit AS (SELECT doc_id, i, place.n, item_id FROM place JOIN item_window USING (n, words)),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
}
