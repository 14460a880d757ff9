"""Personal data: fixed patterns and a skip-chain conditional random field.

Patterns find email addresses, IP addresses, card numbers and phone numbers
exactly; their spans always stay.  A skip-chain CRF then labels the tokens that
could be personal data (those with an ASCII digit, ``@`` or a bracketed "at";
every other token can only be O and would send no message):

* unary potentials from token features,
* chain potentials between neighbouring tokens,
* skip potentials between distant tokens of a document that repeat or resemble
  each other (same text, same digits, same last digits, same letters and digits):
  all members of a group share a hub variable, so a group of m tokens costs m
  edges and not m squared.

Tokens inside pattern spans are observed.  Loopy sum-product message passing
over all graphs of a batch at once gives marginals, so evidence for one mention
reaches its repetitions anywhere in the document; confident tokens become spans
of their own.

A number that no pattern matches is told from an ordinary one by what it repeats,
so the field is fitted on lessons made from a bounded sample of documents with
matches (``TRAIN_DOCS`` at most, drawn by hash for each kind): some matches are
hidden, other writings of them are added, and numbers that repeat nothing beside
them.  Detection covers every document and the whole text.

Defined results: a null or empty text has no spans; offsets are code points,
end exclusive; repeated rows get equal results; without documents, or a match in
them, the model has zero weights and adds nothing; texts of any length are read
whole; other columns of any name are kept, except one called as a result, whose
name can be chosen.
"""

from __future__ import annotations

import json
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawhouse.llm.common import free_name, map_texts
from rawhouse.session import discard, materialize

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
TRAIN_DOCS = 2000
CASE_TOKENS = 512
SKIPS = (0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 12.0)
ROUNDS = 8
CONFIDENCE = 0.9
CHUNK_BYTES = 1 << 20  # text whose graphs are passed over together

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]|[\[({][aA][tT][\])}]")
_TOKEN = re.compile(r"\S+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def pattern_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by kind as listed, then start.

    Each kind is matched leftmost and without overlap; a match that fails its
    check is dropped without another try.  Linear in the text.
    """
    if not text or not _HINT.search(text):
        return []
    found = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    for m in _NUMBERS.finditer(text):
        parts = m[0].split(".")
        if len(parts) < 4:
            continue
        start = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            if all(map(_octet, four)):
                found.append(("ip", start, start + length))
            start += length + 1
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


# --- tokens -----------------------------------------------------------------

FEATURES = (
    "bias", "at", "address", "bracketed_at", "octets", "dots", "luhn", "digits_1_3", "digits_4_7", "digits_8_15", "digits_16_19",
    "digits_20", "all_digits", "letters", "plus", "parens", "hyphen", "after_plus", "before_digits", "after_digits",
)
_EDGE = " \t\r\n!\"#$%&'*,.:;<=>?[]^_`{|}~"
_NUMERIC = re.compile(r"[0-9()./-]+")
_BRACKETED = re.compile(r"[\[({]at[\])}]", re.I)
_SIGNS = re.compile(r"[^a-z0-9]")


class Tokens:
    """Candidate tokens of one text: offsets of their cores, features, groups.

    Words of digits with one blank between them are one token (up to 19 digits):
    a number is written with or without blanks.  Tokens are in a group if their
    text is equal, their digits, their last seven digits (of numbers), or their
    letters and digits with ``@`` read as "at".
    """

    def __init__(self, text: str) -> None:
        self.start: list[int] = []
        self.end: list[int] = []
        self.chain: list[int] = []  # tokens whose predecessor is the candidate before them
        last, open_digits = -2, 0
        for n, m in enumerate(_TOKEN.finditer(text)):
            word = m[0]
            if not _HINT.search(word):
                continue
            core = word.strip(_EDGE)
            if not core:
                continue
            offset = m.start() + len(word) - len(word.lstrip(_EDGE))
            numeric = _NUMERIC.fullmatch(core[1:] if core[0] == "+" else core) is not None
            digits = len(_NOT_DIGIT.sub("", core)) if numeric else 0
            near = last == n - 1
            last = n
            if near and numeric and open_digits and core[0] != "+" and offset == self.end[-1] + 1 and open_digits + digits <= 19:
                self.end[-1] = offset + len(core)
                open_digits += digits
                continue
            if near and self.start:
                self.chain.append(len(self.start))
            self.start.append(offset)
            self.end.append(offset + len(core))
            open_digits = digits
        rows = []
        keys: dict[tuple[str, str], list[int]] = defaultdict(list)
        for i, (start, end) in enumerate(zip(self.start, self.end)):
            core = text[start:end]
            digits, low = _NOT_DIGIT.sub("", core), core.lower()
            rows.append(self._of(core, digits, text, start))
            keys["text", low].append(i)
            if len(digits) >= 7:
                keys["digits", digits].append(i)
                if not any(map(str.isalpha, core)):
                    keys["tail", digits[-7:]].append(i)
            if len(plain := _SIGNS.sub("", low.replace("@", "at"))) >= 6:
                keys["plain", plain].append(i)
        # The same members under two keys are one group: evidence counts once.
        self.groups = [list(g) for g in dict.fromkeys(tuple(g) for g in keys.values() if len(g) > 1)]
        self.features = b"".join(rows)

    @staticmethod
    def _of(core: str, digits: str, text: str, offset: int) -> bytes:
        n, parts = len(digits), core.split(".")
        at = core.find("@")
        before = text[max(0, offset - 6) : offset]
        after = text[offset + len(core) : offset + len(core) + 2]
        return bytes((
            True, at >= 0, at > 0 and bool(_DOMAIN.match(core, at + 1)), bool(_BRACKETED.search(core)),
            len(parts) == 4 and all(p.isascii() and p.isdigit() and _octet(p) for p in parts), len(parts) > 1,
            16 <= n <= 19 and luhn(digits), 1 <= n <= 3, 4 <= n <= 7, 8 <= n <= 15, 16 <= n <= 19, n >= 20,
            n == len(core), any(map(str.isalpha, core)), core[0] == "+", core[0] == "(", "-" in core,
            "+" in before, after[-1:].isdigit(), bool(re.search(r"[0-9] $", before)),
        ))

    def labels(self, spans: list[tuple[str, int, int]]) -> list[int]:
        """Label of the pattern span that overlaps each token, else 0."""
        out = [0] * len(self.start)
        if not spans:
            return out
        order = sorted((s, e, LABELS.index(k)) for k, s, e in spans)
        k = 0
        for i, (s, e) in enumerate(zip(self.start, self.end)):
            while k < len(order) and order[k][1] <= s:
                k += 1
            j = k
            while j < len(order) and order[j][0] < e:
                if order[j][1] > s:
                    out[i] = order[j][2]
                    break
                j += 1
        return out


class Graph:
    """The graphs of many texts side by side."""

    def __init__(self, tokens: list[Tokens]) -> None:
        sizes = [len(t.start) for t in tokens]
        self.first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.x = np.frombuffer(b"".join(t.features for t in tokens), np.uint8).reshape(-1, len(FEATURES)).astype(np.float32)
        self.right = np.array([a + i for a, t in zip(self.first, tokens) for i in t.chain], np.int64)
        groups = [[a + i for i in g] for a, t in zip(self.first, tokens) for g in t.groups]
        self.hub = np.repeat(np.arange(len(groups)), [len(g) for g in groups]) if groups else np.empty(0, np.int64)
        self.member = np.array([i for g in groups for i in g], np.int64)
        self.n_hubs = len(groups)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def _add(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]))
    np.add.at(out, at, values)
    return out


def marginals(graph: Graph, weights: dict[str, np.ndarray], observed: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Token marginals (n x labels) by loopy sum-product; observed > 0 fixes a label."""
    k, n = len(LABELS), len(graph.x)
    unary = graph.x @ weights["unary"]
    fixed = np.flatnonzero(observed)
    unary[fixed] = -50.0
    unary[fixed, observed[fixed]] = 50.0
    move, agree = weights["chain"], float(weights["skip"]) * np.eye(k)
    left, right = graph.right - 1, graph.right
    to_right = np.zeros((len(right), k))
    to_left = np.zeros((len(right), k))
    to_member = np.zeros((len(graph.member), k))
    belief = unary
    for _ in range(rounds):
        belief = unary + _add(right, to_right, n) + _add(left, to_left, n) + _add(graph.member, to_member, n)
        if not len(right) and not len(graph.member):
            break
        go_right = _lse((belief[left] - to_left)[:, :, None] + move[None], 1)
        go_left = _lse((belief[right] - to_right)[:, None, :] + move[None], 2)
        to_hub = _lse((belief[graph.member] - to_member)[:, :, None] + agree[None], 1)
        to_hub -= _lse(to_hub, 1)[:, None]
        hub = _add(graph.hub, to_hub, graph.n_hubs)
        go_member = _lse((hub[graph.hub] - to_hub)[:, :, None] + agree[None], 1)
        for old, new in ((to_right, go_right), (to_left, go_left), (to_member, go_member)):
            new -= _lse(new, 1)[:, None]
            old += 0.5 * (new - old)  # damped
    return np.exp(belief - _lse(belief, 1)[:, None])


# --- learning ---------------------------------------------------------------


class Case:
    """What one document teaches: the features and groups of its tokens, their labels,
    and which of them the patterns show (the others must be found)."""

    __slots__ = ("start", "features", "chain", "groups", "label", "shown")

    def __init__(self, start, features, chain, groups, label, shown) -> None:
        self.start, self.features, self.chain, self.groups = start, features, chain, groups
        self.label, self.shown = label, shown

    def packed(self) -> str:
        return json.dumps([len(self.start), self.features.hex(), self.chain, self.groups, self.label, self.shown])

    @classmethod
    def unpacked(cls, line: str) -> Case:
        n, features, chain, groups, label, shown = json.loads(line)
        return cls([0] * n, bytes.fromhex(features), chain, groups, label, shown)


def _variant(kind: str, text: str, rng: random.Random) -> str | None:
    """Another way to write the same thing, which the patterns do not match."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == "email":
        return text.replace("@", rng.choice(("[at]", "(at)", "{at}")))
    if kind == "ip":
        return text.replace(".", rng.choice(("-", "[.]")))
    if kind == "card":
        return rng.choice((".", "/")).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return rng.choice((digits, "0" + digits[2:], f"{digits[:4]}/{digits[4:]}", f"0{digits[2:5]} {digits[5:]}")) if len(digits) > 9 else digits


def learning_case(text: str | None, seed: int) -> Case | None:
    """A document with pattern matches as a lesson in finding the same things where
    no pattern shows them.

    Of its matches some are hidden; further mentions in other writing are put
    behind the text, and beside them numbers of the same shapes that repeat
    nothing (these are O).  None without a match or with more than ``CASE_TOKENS``
    tokens.
    """
    spans = pattern_spans(text)
    if not spans:
        return None
    rng = random.Random(seed)
    kind_of = {}  # place of an added mention -> label
    whole = text
    for kind, a, b in spans[:8]:
        same = text[a:b]
        for label, mention in ((kind, _variant(kind, same, rng)), ("O", _variant(kind, re.sub("[0-9]", lambda m: rng.choice("0123456789"), same), rng))):
            if rng.random() < 0.7 and not (label == "O" and kind == "email"):
                whole += rng.choice(("\nsee ", " or ", ", namely "))
                kind_of[len(whole), len(whole) + len(mention)] = LABELS.index(label)
                whole += mention
    if rng.random() < 0.5:  # a long run of numbers is nothing
        whole += "\nvalues " + " ".join(str(rng.randrange(1000, 10000)) for _ in range(rng.randrange(6, 14)))
    tokens, shown = Tokens(whole), pattern_spans(whole)
    if len(tokens.start) > CASE_TOKENS:
        return None
    seen = tokens.labels(shown)
    label = list(seen)
    for i, (a, b) in enumerate(zip(tokens.start, tokens.end)):
        for (x, y), k in kind_of.items():
            if a < y and x < b and not seen[i]:
                label[i] = k
    hidden = [rng.random() < 0.3 for _ in seen]
    return Case(tokens.start, tokens.features, tokens.chain, tokens.groups, label, [0 if h else k for k, h in zip(seen, hidden)])


def fit_cases(cases: list[Case], steps: int = 300, ridge: float = 0.02) -> dict[str, np.ndarray]:
    """Weights from lessons.  Unary and chain weights: pseudo-likelihood of the tokens
    that are not shown, given the labels around them.  The skip weight: the one of
    ``SKIPS`` under which message passing, as it is run, gives those tokens' labels
    the highest mean log-probability."""
    k = len(LABELS)
    weights = {"unary": np.zeros((len(FEATURES), k)), "chain": np.zeros((k, k)), "skip": np.zeros(())}
    if not cases:
        return weights
    graph = Graph(cases)
    y = np.array([v for c in cases for v in c.label], np.int64)
    shown = np.array([v for c in cases for v in c.shown], np.int64)
    asked = np.flatnonzero(shown == 0)
    if not len(asked) or not y.any():
        return weights
    one = np.eye(k)[y]
    left, right, n = graph.right - 1, graph.right, len(y)
    share = np.zeros((n, k))  # of the other members of a token's groups that have each label
    if graph.n_hubs:
        size = np.bincount(graph.hub, minlength=graph.n_hubs)
        total = _add(graph.hub, one[graph.member], graph.n_hubs)
        others = (total[graph.hub] - one[graph.member]) / (size[graph.hub] - 1)[:, None]
        share = _add(graph.member, others, n)
    speed = {name: np.zeros_like(w) for name, w in weights.items()}
    lonely = (shown == 0)[:, None]
    for _ in range(steps):
        z = graph.x @ weights["unary"] + weights["skip"] * share
        z += _add(right, weights["chain"][y[left]], n) + _add(left, weights["chain"][:, y[right]].T, n)
        error = np.where(lonely, one - np.exp(z - _lse(z, 1)[:, None]), 0.0)
        slope = {
            "unary": graph.x.T @ error,
            "chain": one[left].T @ error[right] + error[left].T @ one[right],
            "skip": np.array((error * share).sum()),
        }
        for name in weights:
            speed[name] = 0.9 * speed[name] + slope[name] / len(asked) - ridge / 20 * weights[name]
            weights[name] = weights[name] + 0.5 * speed[name]

    def fits(skip: float) -> float:
        p = marginals(graph, weights | {"skip": np.array(skip)}, shown)
        return float(np.log(np.maximum(p[asked, y[asked]], 1e-12)).mean())

    weights["skip"] = np.array(max(SKIPS, key=fits))
    return weights


def fit(texts: list[str | None]) -> dict[str, np.ndarray]:
    """:func:`fit_cases` of the texts that have a pattern match."""
    return fit_cases([c for i, t in enumerate(texts) if (c := learning_case(t, i)) is not None])


def added_spans(
    texts: list[str], base: list[list[tuple[str, int, int]]], weights: dict[str, np.ndarray], confidence: float = CONFIDENCE
) -> list[list[tuple[str, int, int]]]:
    """Spans the field adds to the pattern spans of each text: its confident tokens."""
    tokens = [Tokens(t) if t and _HINT.search(t) else Tokens("") for t in texts]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not any(t.start for t in tokens):
        return out
    graph = Graph(tokens)
    observed = np.array([v for t, b in zip(tokens, base) for v in t.labels(b)], np.int64)
    p = marginals(graph, weights, observed)
    best = p.argmax(axis=1)
    sure = (best > 0) & (observed == 0) & (p[np.arange(len(p)), best] >= confidence)
    row = np.searchsorted(graph.first, np.flatnonzero(sure), side="right") - 1
    for at, r in zip(np.flatnonzero(sure).tolist(), row.tolist()):
        i = at - int(graph.first[r])
        out[r].append((LABELS[best[at]], tokens[r].start[i], tokens[r].end[i]))
    return out


# --- operators --------------------------------------------------------------


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Fit the field on at most ``docs`` documents with pattern matches, an equal part
    for each kind: those with the smallest hashes of id and text among the documents
    that hold the kind, so rare kinds are learned too.

    One pass over all documents; each task keeps its smallest hashes a kind.  The
    driver receives token features of the drawn documents (``CASE_TOKENS`` tokens
    each at most), no texts.
    """
    text = F.col(f"`{text_col}`").cast("string")
    own = df.select(text.alias("t"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("h")).where(text.isNotNull())
    each = max(1, docs // len(KINDS))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[int, str]] = {k: {} for k in KINDS}
        top: dict[str, int] = {k: 1 << 63 for k in KINDS}
        for batch in batches:
            for t, h in zip(batch.column(0), batch.column(1).to_pylist()):
                case = None
                value = t.as_py()
                for kind in {k for k, _, _ in pattern_spans(value)}:
                    if h >= top[kind] or h in kept[kind]:
                        continue
                    case = case or learning_case(value, h)
                    if case is None:
                        break
                    kept[kind][h] = case.packed()
                    if len(kept[kind]) > 2 * each:
                        kept[kind] = dict(sorted(kept[kind].items())[:each])
                        top[kind] = max(kept[kind])
        rows = [(k, h, line) for k in KINDS for h, line in sorted(kept[k].items())[:each]]
        if rows:
            kinds, hashes, lines = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(hashes, pa.int64()), pa.array(lines)], names=["kind", "h", "line"])

    drawn = materialize(own.mapInArrow(draw, "kind string, h long, line string"), "private-cases")
    lines: dict[int, str] = {}
    for kind in KINDS:
        for r in drawn.where(F.col("kind") == kind).orderBy("h", "line").limit(each).collect():
            lines[r["h"]] = r["line"]
    discard(drawn)
    return fit_cases([Case.unpacked(line) for _, line in sorted(lines.items())])


def _joined(spans: list[tuple[str, int, int]]) -> list[str]:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return [f"{k}:{s}:{e}" for k, s, e in order]


def _finder(weights):
    def find(texts):
        base = [pattern_spans(t) for t in texts]
        extra = added_spans(texts, base, weights)
        return base, [b + e for b, e in zip(base, extra)]

    return find


def find_private(
    df: DataFrame,
    weights: dict[str, np.ndarray],
    text_col: str = "text",
    keep: list[str] | None = None,
    base_out: str = "base_spans",
    out: str = "spans",
) -> DataFrame:
    """Columns ``keep`` with two arrays of ``kind:start:end``: the pattern spans
    and all spans, each by kind and start."""
    kept = keep if keep is not None else [c for c in df.columns if c.lower() not in {base_out.lower(), out.lower()}]
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def factory():
        find = _finder(shared.value)

        def run(texts):
            base, spans = find(texts)
            return {base_out: [_joined(b) for b in base], out: [_joined(s) for s in spans]}

        return run

    return map_texts(df, text_col, kept, {base_out: "array<string>", out: "array<string>"}, factory, CHUNK_BYTES)


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span (overlaps joined) replaced by its kind in brackets."""
    if not text or not spans:
        return text
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start < at:
            if end > at:
                at = end
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def mask_private(df: DataFrame, weights: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``df`` with personal data in its text column masked; other columns and order of columns stay."""
    others = [c for c in df.columns if c != text_col]
    name = free_name(df, "masked")
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def factory():
        find = _finder(shared.value)
        return lambda texts: {name: [masked(t, s) for t, s in zip(texts, find(texts)[1])]}

    done = map_texts(df, text_col, others, {name: "string"}, factory, CHUNK_BYTES)
    return done.select(*[F.col(f"`{name}`").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])


__all__ = ["KINDS", "find_private", "fit", "luhn", "mask_private", "masked", "pattern_spans", "train"]
