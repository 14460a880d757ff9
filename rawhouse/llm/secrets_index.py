"""Secret scans through a trigram inverted index.

Every rule is a regular expression.  From its parse tree follows a Boolean
query over trigrams that every match must hold (``trigram_query``): literals and
small character classes give trigrams, a sequence joins its parts with AND, an
alternation with OR, and what may be empty or is too wide gives none.

Documents are indexed in segments of bounded size: for each trigram the queries
name, the sorted list of the segment's documents that hold it.  A rule's query
intersects and unites these postings; only the candidates are verified with the
regular expression on the whole text.  A rule without a mandatory trigram scans
every text.  Segments are cut inside tasks, so a trigram that a third of all
documents hold makes no hot key and nothing is shuffled; a lost executor repeats
its own partitions.  ``build_postings`` writes the same segment postings as a
table for rules that are not known yet.

Trigrams are bytes of the UTF-8 text with A-Z lower-cased; verification decides.

Defined results: a null text counts as empty; empty texts and tables without
rows have no spans; repeated rows give repeated rows; texts of any length are
scanned whole; other columns of any name may be kept, except the two result
columns' own names, which can be chosen.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawhouse.llm.common import CHUNK_BYTES, LOWER_TABLE, map_texts

# Most strings a set of the analysis holds; most repetitions, and letters of a class, written out.
MAX_STRINGS = 48
MAX_COPIES = 8

# --- Boolean trigram queries ------------------------------------------------

# A query: True (no condition), a trigram as bytes, ("and", ...) or ("or", ...).
Query = object


def _and(*parts: Query) -> Query:
    flat: list = []
    for p in parts:
        if p is True:
            continue
        flat += [q for q in (p[1:] if isinstance(p, tuple) and p[0] == "and" else (p,)) if q not in flat]
    return True if not flat else flat[0] if len(flat) == 1 else ("and", *flat)


def _or(*parts: Query) -> Query:
    if any(p is True for p in parts):
        return True
    flat = list(dict.fromkeys(parts))
    return flat[0] if len(flat) == 1 else ("or", *flat)


def _grams(strings: frozenset[bytes]) -> Query:
    """What holds of a text that contains one of the strings."""
    if not strings or any(len(s) < 3 for s in strings):
        return True
    return _or(*(_and(*(s[i : i + 3] for i in range(len(s) - 2))) for s in sorted(strings)))


EMPTY = frozenset([b""])


@dataclass(frozen=True)
class _Part:
    """What is known of the matches of a piece of the expression: all of them
    (``exact``, or None), how they begin and end, and a query they satisfy."""

    exact: frozenset[bytes] | None
    first: frozenset[bytes] = EMPTY
    last: frozenset[bytes] = EMPTY
    query: Query = True

    def known(self) -> Query:
        return _and(self.query, _grams(self.exact)) if self.exact is not None else self.query


ANY = _Part(None)
NOTHING = _Part(EMPTY)


def _opened(part: _Part) -> _Part:
    """The same without an exact set: two bytes at each end are kept."""
    if part.exact is None:
        return part
    return _Part(None, frozenset(s[:2] for s in part.exact), frozenset(s[-2:] for s in part.exact), part.known())


def _joined(a: frozenset[bytes], b: frozenset[bytes]) -> frozenset[bytes]:
    return frozenset(x + y for x in a for y in b)


def _sequence(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None:
        if len(a.exact) * len(b.exact) <= MAX_STRINGS:
            return _Part(_joined(a.exact, b.exact), query=_and(a.query, b.query))
    first = a.exact if a.exact is not None else a.first
    last = b.exact if b.exact is not None else b.last
    ends, begins = (a.exact if a.exact is not None else a.last), (b.exact if b.exact is not None else b.first)
    border = _joined(ends, begins) if len(ends) * len(begins) <= MAX_STRINGS else EMPTY
    return _Part(
        None,
        frozenset(s[:2] for s in (_joined(first, begins) if a.exact is not None and border != EMPTY else first)),
        frozenset(s[-2:] for s in (_joined(ends, last) if b.exact is not None and border != EMPTY else last)),
        _and(a.known(), b.known(), _grams(border)),
    )


def _either(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MAX_STRINGS:
        return _Part(a.exact | b.exact, query=_or(a.query, b.query) if True not in (a.query, b.query) else True)
    a, b = _opened(a), _opened(b)
    return _Part(None, a.first | b.first, a.last | b.last, _or(a.query, b.query))


def _letter(code: int) -> bytes:
    return chr(code).encode().translate(LOWER_TABLE)


def _class(items: list) -> _Part:
    codes: set[int] = set()
    for op, value in items:
        if op is sre.LITERAL:
            codes.add(value)
        elif op is sre.RANGE and value[1] - value[0] < MAX_STRINGS:
            codes.update(range(value[0], value[1] + 1))
        else:
            return ANY
    found = frozenset(map(_letter, codes))
    return _Part(found) if len(found) <= MAX_COPIES else ANY


def _repeat(part: _Part, low: int, high: int) -> _Part:
    if high == 1 and low == 0:
        return _either(NOTHING, part)
    copies = NOTHING
    for _ in range(min(low, MAX_COPIES)):
        copies = _sequence(copies, part)
    if low == high <= MAX_COPIES:
        return copies
    if not low:
        return ANY
    copies = _opened(copies)
    return _Part(None, copies.first, _opened(part).last if part.exact is not None else part.last, copies.query)


def _analyse(nodes) -> _Part:
    out = NOTHING
    for op, value in nodes:
        if op is sre.LITERAL:
            part = _Part(frozenset([_letter(value)]))
        elif op is sre.IN:
            part = _class(value)
        elif op is sre.SUBPATTERN:
            part = _analyse(value[-1])
        elif op is sre.BRANCH:
            part = None
            for branch in value[1]:
                one = _analyse(branch)
                part = one if part is None else _either(part, one)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            part = _repeat(_analyse(value[2]), value[0], int(value[1]))
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            part = NOTHING  # takes no characters
        else:
            part = ANY
        out = _sequence(out, part)
    return out


def trigram_query(pattern: str) -> Query:
    """A Boolean query that every text with a match of ``pattern`` satisfies:
    True, a trigram, or ``("and" | "or", ...)``.  A-Z is lower-cased, so the query
    holds for patterns that ignore (ASCII) case too."""
    return _analyse(sre_parser.parse(pattern, re.ASCII)).known()


def trigrams_of(query: Query) -> set[bytes]:
    """Every trigram a query names."""
    if query is True:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*(trigrams_of(q) for q in query[1:]))


# --- segment postings -------------------------------------------------------


def _code(gram: bytes) -> int:
    return (gram[0] << 16) | (gram[1] << 8) | gram[2]


class SegmentIndex:
    """Postings of one segment: trigram -> sorted numbers of the texts holding it.

    ``wanted`` limits the index to some trigrams (None: every trigram there is).
    """

    def __init__(self, texts: list[bytes], wanted: np.ndarray | None = None) -> None:
        self.n = len(texts)
        data = np.frombuffer(b"\0\0".join(texts).translate(LOWER_TABLE), np.uint8)
        starts = np.concatenate(([0], np.cumsum([len(t) + 2 for t in texts])))[: self.n].astype(np.int64)
        code = data[:-2].astype(np.uint32) << 16
        code |= data[1:-1].astype(np.uint32) << 8
        code |= data[2:]
        if wanted is not None:
            at = np.flatnonzero(wanted[code])
            code = code[at]
        else:
            at = np.arange(len(code))
        doc = np.searchsorted(starts, at, side="right") - 1
        inside = at + 3 <= starts[doc] + np.array([len(t) for t in texts], np.int64)[doc] if self.n else np.ones(0, bool)
        pair = np.unique((code[inside].astype(np.int64) << 32) | doc[inside])
        grams, begin = np.unique(pair >> 32, return_index=True)
        self.postings = dict(zip(grams.tolist(), np.split(pair & 0xFFFFFFFF, begin[1:]))) if len(grams) else {}

    def texts_for(self, query: Query) -> np.ndarray:
        """Sorted numbers of the texts that satisfy a query."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings.get(_code(query), np.zeros(0, np.int64))
        lists = sorted((self.texts_for(q) for q in query[1:]), key=len)
        out = lists[0]
        for more in lists[1:]:
            out = np.intersect1d(out, more, assume_unique=True) if query[0] == "and" else np.union1d(out, more)
            if query[0] == "and" and not len(out):
                break
        return out


def build_postings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The index as a table: (segment, ids, trigram, rows), one row a trigram of a
    segment; ``rows`` are places in ``ids``, the segment's document ids (both
    sorted by place).  ``ids`` stands in the row of each segment's smallest
    trigram only.  Segments are numbered by task and place."""
    source = df.select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"), F.spark_partition_id().alias("p"))
    names = ["segment", "ids", "trigram", "rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, used = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            found = sorted(SegmentIndex(texts).postings.items())
            columns = [
                pa.array([(part << 32) | number] * len(found), pa.int64()),
                pa.array([ids if k == 0 else None for k in range(len(found))], pa.list_(pa.string())),
                pa.array([g.to_bytes(3, "big") for g, _ in found], pa.binary()),
                pa.array([r.astype(np.int32) for _, r in found], pa.list_(pa.int32())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for i, t, part in zip(*(batch.column(k).to_pylist() for k in range(3))):
                data = (t or "").encode()
                if texts and used + len(data) > segment_bytes:
                    yield flush()
                    number, ids, texts, used = number + 1, [], [], 0
                ids.append(i)
                texts.append(data)
                used += len(data)
        if texts:
            yield flush()

    return source.mapInArrow(run, "segment long, ids array<string>, trigram binary, rows array<int>")


# --- rules ------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``least`` is the fewest characters of ``group`` (0: the
    match); matches that are shorter are dropped, without another try."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    query: Query = field(default=None, compare=False)

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)


# The patterns of the base kinds.  ``{n,}`` where a run of one class
# is meant, so that shorter runs need no match object; the matches are the same.
_KEYWORD = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
BASE_RULES = (
    Rule("assign", _KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Published formats of tokens and keys.
MORE_RULES = (
    Rule("github", r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}\b"),
    Rule("gitlab", r"\bglpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("npm", r"\bnpm_[A-Za-z0-9]{36}\b"),
    Rule("sendgrid", r"\bSG\.[A-Za-z0-9_-]{16,32}\.[A-Za-z0-9_-]{16,64}"),
    Rule("url", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@[A-Za-z0-9.-]+"),
)
BASE_KINDS = tuple(r.kind for r in BASE_RULES)
RULES = BASE_RULES + MORE_RULES


def matches(text: str, rule: Rule, compiled: re.Pattern | None = None) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping matches of a rule, too short ones dropped; code points."""
    found = (compiled or rule.compiled()).finditer(text)
    return [m.span() for m in found if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scanner(rules: tuple[Rule, ...]) -> Callable[[list[str | None]], list[list[tuple[str, int, int]]]]:
    """A function from the texts of one segment to their spans (kind, start, end),
    by start, then by the order of the rules."""
    compiled = [r.compiled() for r in rules]
    queries = [r.query if r.query is not None else trigram_query(r.pattern) for r in rules]
    wanted = np.zeros(1 << 24, bool)
    wanted[[_code(g) for q in queries for g in trigrams_of(q)]] = True

    def scan(texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
        index = SegmentIndex([(t or "").encode() for t in texts], wanted)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for order, (rule, query, regex) in enumerate(zip(rules, queries, compiled)):
            for row in index.texts_for(query).tolist():
                if texts[row]:
                    found[row] += [(a, order, b) for a, b in matches(texts[row], rule, regex)]
        return [[(rules[k].kind, a, b) for a, k, b in sorted(f)] for f in found]

    return scan


def find_secrets(
    df: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    rules: tuple[Rule, ...] = RULES,
    out: str = "spans",
    segment_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Columns ``keep`` (None: all but ``out``) with an array of ``kind:start:end``
    in code points, by start and then by the order of ``rules``."""
    kept = keep if keep is not None else [c for c in df.columns if c.lower() != out.lower()]

    def factory():
        scan = scanner(rules)
        return lambda texts: {out: [[f"{k}:{a}:{b}" for k, a, b in spans] for spans in scan(texts)]}

    return map_texts(df, text_col, kept, {out: "array<string>"}, factory, segment_bytes)


def find_by_postings(
    df: DataFrame, postings: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text", out: str = "spans"
) -> DataFrame:
    """(id, ``out``) of the documents in which one more rule matches, through an
    index that :func:`build_postings` wrote: postings of the rule's trigrams are
    brought together segment by segment, and only candidates are read again.

    ``id_col`` must name documents uniquely and not be null.  A rule without a
    mandatory trigram reads every document.
    """
    query = trigram_query(rule.pattern)
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    if query is not True:
        named = sorted(trigrams_of(query))
        held = postings.where(F.col("trigram").isin([bytearray(g) for g in named]))
        lists = held.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct(F.hex("trigram").alias("g"), "rows"))).alias("m"))

        def rows_of(q: Query):
            if isinstance(q, bytes):
                return F.coalesce(F.try_element_at("m", F.lit(q.hex().upper())), F.array().cast("array<int>"))
            parts = [rows_of(x) for x in q[1:]]
            out_rows = parts[0]
            for p in parts[1:]:
                out_rows = F.array_intersect(out_rows, p) if q[0] == "and" else F.array_union(out_rows, p)
            return out_rows

        hits = lists.select("segment", F.explode(rows_of(query)).alias("row"))
        ids = postings.where(F.col("ids").isNotNull()).select("segment", F.posexplode("ids").alias("row", "i"))
        candidates = hits.join(ids, ["segment", "row"]).select(F.col("i").cast(df.schema[id_col].dataType).alias("id"))
        texts = texts.join(candidates.distinct(), "id", "left_semi")
    found = find_secrets(texts, "text", ["id"], (rule,), "found")
    return found.where(F.size("found") > 0).select("id", F.col("found").alias(out))


SPANS_TYPE = T.ArrayType(T.StringType())

__all__ = [
    "BASE_KINDS", "BASE_RULES", "MORE_RULES", "RULES", "Rule", "SegmentIndex", "build_postings", "find_by_postings",
    "find_secrets", "matches", "scanner", "trigram_query", "trigrams_of",
]
