"""Licence scans by template-markup matching.

A template is compiled to an automaton over words: mandatory wording is a chain
of word steps, an optional region may be skipped, a replaceable region takes a
bounded or unbounded number of any words.  A text is accepted where it holds
all mandatory wording, word for word and in order.  All starts are followed in
one pass over the words; an automaton runs only on texts that hold each of the
template's mandatory runs of words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text with A-Z
lower-cased.  Defined results: a null text is empty and has no words; a text
without a match has empty labels and score 0; the score is
1 - 2 ** (-m / 4) for the m mandatory words of the longest wording found;
repeated rows get equal results; texts of any length are read whole; a table without
rows gives none; other columns of any name are kept, except those called as the
results, whose names can be chosen.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rawhouse.llm.common import alnum_words, map_texts
from rawhouse.llm.license_templates import PHRASES, TEMPLATES

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var)((?:;[^>]*)?)>>")
_MATCH = re.compile(r'match="\.(\+|\*|\{(\d+),(\d*)\})"')
ANY = None  # the step of a replaceable word


def parse(markup: str) -> list:
    """Template elements: words, ("any", low, high or None), ("optional", elements)."""
    stack: list[list] = [[]]
    at = 0
    for m in _MARKUP.finditer(markup):
        stack[-1] += alnum_words(markup[at : m.start()])
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            if len(stack) < 2:
                raise ValueError("endOptional without beginOptional")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        else:
            how = _MATCH.search(m[2])
            if not how:
                raise ValueError(f"unsupported match in {m[0]}")
            low = {"+": 1, "*": 0}.get(how[1], int(how[2] or 0))
            stack[-1].append(("any", low, int(how[3]) if how[3] else None))
    if len(stack) != 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0] + alnum_words(markup[at:])


@dataclass(frozen=True)
class Automaton:
    """steps[state]: (word or ANY, next state); skips[state]: states reached
    without a word; the last state accepts."""

    label: str
    base: bool
    steps: tuple
    skips: tuple
    runs: tuple[bytes, ...]  # mandatory runs of words, as padded lines
    mandatory: int
    first: frozenset | None  # words a match can begin with; None: any


def compile_template(label: str, markup: str, base: bool = False) -> Automaton:
    """The automaton of a template."""
    elements = parse(markup)
    steps: list[list] = [[]]
    skips: list[list[int]] = [[]]

    def state() -> int:
        steps.append([])
        skips.append([])
        return len(steps) - 1

    def add(parts: list, at: int) -> int:
        for part in parts:
            if isinstance(part, bytes):
                to = state()
                steps[at].append((part, to))
                at = to
            elif part[0] == "optional":
                end = add(part[1], at)
                to = state()
                skips[end].append(to)
                skips[at].append(to)
                at = to
            else:
                _, low, high = part
                for _ in range(low):
                    to = state()
                    steps[at].append((ANY, to))
                    at = to
                if high is None:
                    to = state()
                    skips[at].append(to)
                    steps[to].append((ANY, to))
                    at = to
                else:
                    exits = [at]
                    for _ in range(high - low):
                        to = state()
                        steps[at].append((ANY, to))
                        at = to
                        exits.append(at)
                    to = state()
                    for x in exits:
                        skips[x].append(to)
                    at = to
        return at

    end = add(elements, 0)
    if end != len(steps) - 1:
        to = state()
        skips[end].append(to)
    runs, run = [], []
    for part in [*elements, ("any", 0, None)]:
        if isinstance(part, bytes):
            run.append(part)
        elif run:
            runs.append(b" " + b" ".join(run) + b" ")
            run = []
    if not runs:
        raise ValueError("a template needs mandatory words")
    closed = _close({0: 0}, skips)
    begin = {word for s in closed for word, _ in steps[s]}
    return Automaton(
        label, base, tuple(map(tuple, steps)), tuple(map(tuple, skips)), tuple(runs),
        sum(isinstance(p, bytes) for p in elements), None if ANY in begin else frozenset(begin),
    )


def _close(active: dict[int, int], skips) -> dict[int, int]:
    """States (with their smallest start) reachable without a word."""
    todo = list(active)
    while todo:
        s = todo.pop()
        for to in skips[s]:
            if to not in active or active[s] < active[to]:
                active[to] = active[s]
                todo.append(to)
    return active


def matches(words: list[bytes], a: Automaton) -> list[tuple[int, int]]:
    """(start, end exclusive) of the places where the automaton accepts: for
    each start its longest match; literal templates report overlapping places."""
    last, found = len(a.steps) - 1, {}
    at_first = _close({0: 0}, a.skips)
    active: dict[int, int] = {}
    for i, word in enumerate(words):
        if a.first is None or word in a.first:
            for s in at_first:
                if s not in active:
                    active[s] = i
        if not active:
            continue
        now: dict[int, int] = {}
        for s, start in active.items():
            for want, to in a.steps[s]:
                if (want is ANY or want == word) and (to not in now or start < now[to]):
                    now[to] = start
        active = _close(now, a.skips) if now else now
        if last in active:
            found[active[last]] = i + 1
    return sorted(found.items())


def default_automata() -> list[Automaton]:
    """The phrases as templates without free regions, then the templates."""
    return [compile_template(k, v, True) for k, v in PHRASES.items()] + [compile_template(k, v) for k, v in TEMPLATES]


def scan(text: str | None, automata: list[Automaton]) -> tuple[int, list[tuple[Automaton, int, int]]]:
    """Number of words and all matches (automaton, start, end) of a whole text."""
    words = alnum_words(text)
    line = b" " + b" ".join(words) + b" " if words else b""
    out = []
    for a in automata:
        if words and all(run in line for run in a.runs):
            out += [(a, s, e) for s, e in matches(words, a)]
    return len(words), out


def scan_licenses(
    df: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    automata: list[Automaton] | None = None,
) -> DataFrame:
    """Columns ``keep`` (default: all that do not clash) with n_words, n_base,
    first_word, last_word, base_labels, labels, score and ``places``
    (``label:start:end`` in words, end exclusive, by start)."""
    out = {
        "n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string",
        "labels": "string", "score": "double", "places": "array<string>",
    }
    kept = keep if keep is not None else [c for c in df.columns if c.lower() not in out]
    compiled = automata if automata is not None else default_automata()

    def factory():
        def run(texts):
            rows = []
            for text in texts:
                n, found = scan(text, compiled)
                base = [s for a, s, _ in found if a.base]
                rows.append(
                    (
                        n,
                        len(base),
                        min(base, default=None),
                        max(base, default=None),
                        ",".join(sorted({a.label for a, _, _ in found if a.base})),
                        ",".join(sorted({a.label for a, _, _ in found})),
                        1.0 - 2.0 ** (-max((a.mandatory for a, _, _ in found), default=0) / 4.0),
                        [f"{a.label}:{s}:{e}" for a, s, e in sorted(found, key=lambda f: (f[1], f[2], f[0].label))],
                    )
                )
            return dict(zip(out, map(list, zip(*rows))))

        return run

    return map_texts(df, text_col, kept, out, factory)


__all__ = ["Automaton", "compile_template", "default_automata", "matches", "parse", "scan", "scan_licenses"]
