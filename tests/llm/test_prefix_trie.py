"""Prefix trie: the radix tree's layouts, nodes by brute force, odd rows."""

import hashlib
import random
import zlib

import pytest

from rawhouse.llm import prefix_trie as pt


def brute_nodes(seqs):
    """{prefix: (conv, depth, parent conv, n, kids, leaves, saved, ends)} of {conv: turns}."""
    members = {}
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for prefix, cs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(seqs[c]) == len(prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        out[prefix] = (min(cs), len(prefix), parent, len(cs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def rows_of(df):
    return sorted(
        (tuple(r) for r in df.select("conv", "depth", "parent_conv", "n", "kids", "leaves", "saved", "ends_sha256").collect()), key=repr
    )


def table(spark, rows):
    schema = "conv_id long, turn long, role string, text string, key string, node string, n long, first string, conv string"
    return spark.createDataFrame([(*r, "k", "n", 1, "f", "c") for r in rows], schema)


def test_layouts_grow_and_keep_every_child():
    for many in (1, 4, 5, 16, 17, 48, 49, 256):
        order = list(range(many))
        random.Random(many).shuffle(order)
        root = None
        for b in order:
            root = pt.insert(root, b"common" + bytes([b]) + b"tail", b)
        if many > 1:
            assert root.path == b"common" and root.room == next(r for r in (4, 16, 48, 256) if many <= r)
            assert [k.end for k in root.children()] == list(range(many))
            assert all(root.find(b).path == b"tail" for b in order)
            assert many == 256 or root.find(255) is None
            root.put(order[0], pt.Branch(b"new"))
            assert root.find(order[0]).path == b"new" and len(root.children()) == many


@pytest.mark.parametrize("seed", range(6))
def test_chunks_add_up_to_the_brute_force(seed):
    """Any cut of the sorted keys into chunks gives the same nodes after merging."""
    rng = random.Random(seed)
    turns = [(rng.choice("ab"), "x" * rng.randrange(5) + str(i)) for i in range(5)]
    seqs = {c: [rng.choice(turns) for _ in range(rng.randrange(7))] for c in range(60)}
    ids = {t: hashlib.sha256(repr(t).encode()).digest()[:16] for t in turns}
    groups = {}
    for c, s in seqs.items():
        groups.setdefault(b"".join(ids[t] for t in s), []).append(c)
    keys = sorted(groups)
    sizes = [[len(t[1].encode()) for t in seqs[groups[k][0]]] for k in keys]
    want = sorted(((c, d, n, k, lv, sv) for c, d, _, n, k, lv, sv, _ in brute_nodes(seqs).values()))
    for cuts in (0, 3, len(keys) - 1):
        at = [0, *sorted(rng.sample(range(1, len(keys)), cuts)), len(keys)]
        got = {}
        for a, b in zip(at, at[1:]):
            part = list(pt.chunk_nodes(keys[a:b], sizes[a:b], [len(groups[k]) for k in keys[a:b]], [min(groups[k]) for k in keys[a:b]]))
            assert len({r[0] for r in part}) == len(part)
            if a:
                part += pt.overlap_rows(keys[a - 1], keys[a], sizes[a])
            for r in part:
                got.setdefault(r[0], []).append(r)
        merged = sorted(
            (
                min(r[4] for r in rs if r[4] is not None), max(r[2] for r in rs if r[2] is not None),
                *(sum(r[i] for r in rs) for i in (3, 5, 6, 7)),
            )
            for rs in got.values()
        )
        assert merged == want


def test_only_whole_turns_emit_nodes():
    """Ids that share bytes branch inside a turn and give no node there."""
    a, b, c = b"\0" * 15 + b"\1", b"\0" * 15 + b"\2", b"\0" * 8 + b"\1" * 8
    nodes = list(pt.chunk_nodes(sorted([a + b, a + c, c]), [[1, 1], [1, 1], [1]], [1, 1, 1], [1, 2, 3]))
    assert sorted((r[2], r[3], r[5], r[6]) for r in nodes) == [(0, 3, 2, 3), (1, 1, 0, 1), (1, 2, 2, 2), (2, 1, 0, 1), (2, 1, 0, 1)]


@pytest.mark.parametrize("chunk_bytes", [1, 200, 1 << 20])
def test_many_tasks_and_chunks(spark, chunk_bytes):
    rng = random.Random(chunk_bytes)
    rows = []
    for c in range(90):
        start = rng.choice([0, 1, 5])
        rows += [(c, t, "user", f"common {t} é") for t in range(start)]
        rows += [(c, start + t, rng.choice(["user", "assistant"]), "ab" * rng.randrange(3)) for t in range(rng.randrange(4))]
    rows += [(200 + c, 0, "user", "one conversation that many hold") for c in range(60)]
    rows += [(300, t, "user", f"long {t % 7}") for t in range(700)] + [(301, t, "user", f"long {t % 7}") for t in range(650)]
    rng.shuffle(rows)
    seqs = {}
    for c, _, role, text in sorted(rows, key=lambda r: r[:2]):
        seqs.setdefault(c, []).append((role, text))
    short = {c: s for c, s in seqs.items() if c < 300}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows_of(pt.prefix_trie(pt.conversations(table(spark, [r for r in rows if r[0] < 300])), chunk_bytes))
        both = pt.prefix_trie(pt.conversations(table(spark, rows)), chunk_bytes).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted(brute_nodes(short).values(), key=repr)
    deep = sorted((r["depth"], r["n"], r["kids"], r["saved"]) for r in both if r["conv"] == 300)
    assert [d[0] for d in deep] == list(range(1, 701)) and [d[1] for d in deep] == [2] * 650 + [1] * 50
    assert deep[0][3] == 650 * 6 and deep[-1][2] == 0


def test_grafted_heads(spark):
    rows = [(c, t, "user", f"{c}.{t}") for c in [*range(10, 20), 31, 32] for t in range(c % 7 + 4)]
    got = {r["conv"]: [t["id"] for t in r["turns"]] for r in pt.grafted(pt.conversations(table(spark, rows))).collect()}
    plain = {r["conv"]: [t["id"] for t in r["turns"]] for r in pt.conversations(table(spark, rows)).collect()}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        assert got[c] == plain.get(c - c % 5, [])[:h] + own[h:], c
    assert any(len(got[c]) < len(plain[c]) for c in got)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 2, None, None), (1, 2, "", ""), (1, 1, "user", "y" * 100_000), (2, 0, "user", "first"),
        (2, 0, "user", "first"), (3, 0, "us", "erfirst"), (None, 0, "user", "lost"), (-7, 0, "user", ""), (4, None, None, "\0é🙂"),
    ]
    seqs = {
        1: [("user", "first"), ("user", "y" * 100_000), ("", ""), ("", "")], 2: [("user", "first")] * 2, 3: [("us", "erfirst")],
        -7: [("user", "")], 4: [("", "\0é🙂")],
    }
    assert rows_of(pt.prefix_trie(pt.conversations(table(spark, rows)))) == sorted(brute_nodes(seqs).values(), key=repr)
    assert pt.prefix_trie(pt.grafted(pt.conversations(table(spark, [])))).collect() == []
    # Conversation 6 has fewer turns than its head part and no head: it is turnless.
    assert zlib.crc32(b"6") % 9 > 0
    got = rows_of(pt.prefix_trie(pt.grafted(pt.conversations(table(spark, [(6, 0, "user", "only")])))))
    assert got == sorted(brute_nodes({6: []}).values(), key=repr)


def test_digests_of_a_hot_key(spark):
    rows = [(b"a", i) for i in range(5000)] + [(b"b", 7), (b"b", -3)] + [(b"c", i * 10) for i in range(3)]
    df = spark.createDataFrame(rows, "node binary, conv long").repartition(7)
    got = {bytes(r["node"]): r["sha256"] for r in pt.digests(df, "node", "conv", piece_ids=64).collect()}
    for k in (b"a", b"b", b"c"):
        ids = sorted(i for n, i in rows if n == k)
        assert got[k] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
