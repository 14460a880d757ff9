"""Secret scans: trigram queries, postings, spans by brute force, odd rows."""

import random
import re

import pyarrow.parquet as pq
import pytest

from rawhouse.llm import secrets_index as si
from rawhouse.llm.queries import op13_secret_scans

SF = "/root/testdata/sf0.01"


def brute(text, rules=si.RULES):
    found = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m.group(r.group)) >= r.least:
                found.append((m.start(), k, m.end()))
    return [f"{rules[k].kind}:{a}:{b}" for a, k, b in sorted(found)]


def holds(query, text):
    """A query against one text, without an index."""
    data = text.encode().translate(si.LOWER_TABLE)
    if query is True:
        return True
    if isinstance(query, bytes):
        return query in data
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1:])


@pytest.mark.parametrize(
    "pattern, query",
    [
        ("abc", b"abc"),
        ("abcd", ("and", b"abc", b"bcd")),
        ("ABC|xyz", ("or", b"abc", b"xyz")),
        ("ab[cd]", ("or", b"abc", b"abd")),
        ("ab(?:c|dz?)", ("or", b"abc", b"abd", ("and", b"abd", b"bdz"))),
        ("[0-9a-f]+", True),
        ("abc|[0-9]+", True),
        ("ab?c", True),
        ("x*abc.*def", ("and", b"abc", b"def")),
        ("(?:abc)+", b"abc"),
        ("-{5}", b"---"),
        ("(?i)Token", ("and", b"tok", b"oke", b"ken")),
        ("a.c", True),
        (r"\bAKIA[A-Z0-9]{16,}", ("and", b"aki", b"kia")),
    ],
)
def test_trigram_queries(pattern, query):
    assert si.trigram_query(pattern) == query


def test_only_runs_of_one_class_lack_trigrams():
    assert [r.kind for r in si.RULES if si.trigram_query(r.pattern) is True] == ["hex"]


def test_every_match_satisfies_its_query():
    """Random expressions and texts: a text with a match is always a candidate."""
    rng = random.Random(7)

    def expression(depth):
        kind = rng.randrange(7 if depth else 2)
        if kind < 2:
            return "".join(rng.choice("abC") for _ in range(rng.randrange(1, 5)))
        if kind == 2:
            return f"(?:{expression(depth - 1)}|{expression(depth - 1)})"
        if kind == 3:
            return f"(?:{expression(depth - 1)}){rng.choice(['?', '*', '+', '{2}', '{2,3}', '{1,9}'])}"
        if kind == 4:
            return rng.choice(["[ab]", "[a-c]", ".", "[^a]", r"\b"])
        return expression(depth - 1) + expression(depth - 1)

    seen = 0
    for _ in range(1500):
        pattern = rng.choice(["", "(?i)"]) + expression(3)
        query = si.trigram_query(pattern)
        for _ in range(6):
            text = "".join(rng.choice("abcABC ") for _ in range(rng.randrange(14)))
            if re.search(pattern, text, re.ASCII):
                seen += 1
                assert holds(query, text), (pattern, query, text)
    assert seen > 1000


def test_index_gives_the_candidates():
    texts = ["alpha beta", "", "ALPHA", "bet", "al", "ph", "xalphabetax"]
    index = si.SegmentIndex([t.encode() for t in texts])
    for pattern in ("alpha", "bet", "alpha|bet", "alpha.*beta", "zzz", "[0-9]"):
        query = si.trigram_query(pattern)
        assert index.texts_for(query).tolist() == [i for i, t in enumerate(texts) if holds(query, t)], pattern
    assert "pha".encode() not in {g.to_bytes(3, "big") for g in si.SegmentIndex([b"al", b"pha"[1:]]).postings}


CASES = [
    'password = "hunter2hunter"',
    "token=token:abcdefgh",  # the first match is too short and is not tried again
    "Api_Key:  'abc' APIKEY:abcdef secret=12345 secret=123456",
    "paſſword=abcdefgh toKen=abcdefgh",  # letters that only Unicode folding makes equal
    "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " xAKIAAKIA" + "C" * 12,
    "0" * 23 + "g" + "a" * 24 + "\n" + "deadbeef" * 9,
    "é🙂 ghp_" + "a1" * 18 + " end",
    "ghp_" + "z" * 37,
    "-----BEGIN RSA PRIVATE KEY-----\nMIIabc+/=\n-----END RSA PRIVATE KEY-----",
    "-----BEGIN PRIVATE KEY----- never closed",
    "see https://user:pa55word@example.org/x and https://example.org:8080/@y",
    "xoxb-1234567890-abc AIza" + "x" * 35 + " sk_live_" + "0" * 16,
    "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMe npm_" + "z" * 36,
]


def test_spans_of_cases():
    scan = si.scanner(si.RULES)
    found = [[f"{k}:{a}:{b}" for k, a, b in s] for s in scan([*CASES, None, ""])]
    assert found == [*map(brute, CASES), [], []]
    kinds = {s.split(":")[0] for f in found for s in f}
    assert kinds >= {"assign", "access", "hex", "github", "pem", "url", "slack", "google", "stripe", "jwt", "npm"}
    assert found[1] == [] and found[3] == [] and found[7] == [] and found[9] == []


def test_query_equals_brute_force_over_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    got = {r["doc_id"]: r for r in op13_secret_scans(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        spans = brute(text)
        assert got[i]["spans"] == ",".join(spans)
        assert [got[i][f"n_{k}"] for k in si.BASE_KINDS] == [sum(s.startswith(f"{k}:") for s in spans) for k in si.BASE_KINDS]
    assert sum(r["n_assign"] for r in got.values()) > 0


def test_odd_rows_and_segments(spark, odd, odd_rows, docs):
    got = si.find_secrets(odd).collect()
    assert len(got) == len(odd_rows) and all(r["spans"] == brute(t) for r, t in zip(got, [t for _, t in odd_rows]) if r["text"] == t)
    found = si.find_secrets(docs([(i, t) for i, t in enumerate(CASES)]), keep=["doc_id", "id"], out="score", segment_bytes=40)
    assert {r["doc_id"]: r["score"] for r in found.collect()} == {i: brute(t) for i, t in enumerate(CASES)}
    assert si.find_secrets(docs([]), keep=["doc_id"]).collect() == []


def test_stored_postings_find_one_more_rule(spark, docs):
    table = docs([(i, f"{t} {'zebra' * (i % 3)} N{i}-77") for i, t in enumerate(CASES)])
    postings = si.build_postings(table, segment_bytes=200).cache()
    assert postings.select("segment").distinct().count() > 3
    for pattern in ("zebrazebra", "hunter|zebra", "zebra.*77", r"N\d+-77", "nowhere", "[0-9]{16}"):
        rule = si.Rule("more", pattern)
        got = {r["id"]: r["spans"] for r in si.find_by_postings(table, postings, rule).collect()}
        want = {r["doc_id"]: brute(r["text"], (rule,)) for r in table.collect()}
        assert got == {i: s for i, s in want.items() if s}, pattern
    postings.unpersist()
