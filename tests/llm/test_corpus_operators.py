"""Language, toxicity, near-duplicates, decontamination, sharding and the pipeline."""

import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from oracle_harness import compare, duckdb_conn
from rawhouse.llm import components, langid, queries, sharding, simhash_vp, toxicity, vectors, winnow
from rawhouse.llm.oracle import SQL

SF = "/root/testdata/sf0.01"


def table(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ok, message = compare(spark, SF, name, duckdb_conn(SF))
    assert ok, message


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


# --- language and toxicity ---------------------------------------------------


def test_language_held_out(spark):
    got = queries.op9_language_id(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in table("documents")}
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and held
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(docs, odd, odd_rows):
    learned = [(i, "the cat and the dog") for i in range(5)]
    df = docs(learned).withColumn("lang", F.lit("en")).union(docs([(9, "der Hund und die Katze")]).withColumn("lang", F.lit("de")))
    model = langid.train_language_model(df)
    assert model.langs == ("de", "en")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_language(odd, model, keep=["doc_id"], score_out="p").collect()}
    assert [got[i] for i in (2, 3, 4, 5)] == ["und"] * 4 and got[1] == "en" and got[6] in model.langs
    nothing = langid.train_language_model(df.limit(0))
    assert {r["lang_pred"] for r in langid.identify_language(odd, nothing, keep=["doc_id"]).collect()} == {"und"}
    assert langid.train_language_model(df.withColumn("lang", F.lit(None).cast("string"))).langs == ()


def test_long_texts_hash_in_pieces(monkeypatch):
    letters, text = langid.letter_table(), "Ein längerer Text, mit 12 Zahlen. " * 50
    whole = np.sort(np.concatenate(list(langid._grams(text, letters, (1, 2, 3), 15))))
    monkeypatch.setattr(langid, "PIECE_CHARS", 64)
    pieces = np.sort(np.concatenate(list(langid._grams(text, letters, (1, 2, 3), 15))))
    assert np.array_equal(whole, pieces)


def naive_bayes(rows, texts, orders=langid.ORDERS, bits=langid.BITS, alpha=0.5):
    """Language and posterior of texts by the definition, with plain counters."""
    mask = (1 << 64) - 1

    def grams(text):
        chars, out = [" "], []
        for c in text.lower():
            chars.append(c if c.isalpha() else " ")
        line = re.sub(" +", " ", "".join(chars) + " ")
        for n in orders:
            for i in range(len(line) - n + 1):
                if n == 1 and line[i] == " ":
                    continue
                h = n
                for c in line[i : i + n]:
                    h = (h + ord(c)) * 0x9E3779B97F4A7C15 & mask
                    h ^= h >> 29
                out.append((h * 0xBF58476D1CE4E5B9 & mask) >> (64 - bits))
        return out

    counts, docs = {}, collections.Counter()
    for lang, text in rows:
        counts.setdefault(lang, collections.Counter()).update(grams(text or ""))
        docs[lang] += 1
    found = []
    for text in texts:
        own = grams(text or "")
        if not own:
            found.append(("und", 0.0))
            continue
        score = {}
        for lang, c in counts.items():
            whole = sum(c.values()) + alpha * 2**bits
            score[lang] = math.log(docs[lang] / sum(docs.values())) + sum(math.log((c[g] + alpha) / whole) for g in own)
        best = max(sorted(score), key=score.get)
        found.append((best, 1 / sum(math.exp(s - score[best]) for s in score.values())))
    return found


def test_language_scores_by_definition(spark, odd):
    words = {"de": "der die und nicht ein größer straße", "en": "the of and is not larger street", "fr": "le la et ne pas où çà élève"}
    rng = random.Random(3)
    rows = [(lang, " ".join(rng.choice(w.split()) for _ in range(rng.randint(0, 9)))) for lang, w in words.items() for _ in range(8)]
    rows += [("en", None), ("de", "12 34 !!")]
    df = spark.createDataFrame(rows, "lang string, text string")
    model = langid.train_language_model(df)
    texts = ["the street", "größer", "où", "", None, "x", "  le--la  ", "a", "1", "The\x00of", "🙂 nicht", "ﬁ İ ǅ", "und " * 300] + [t for _, t in rows]
    got = langid._scorer(model.langs, model.logp, model.prior, model.orders, model.bits, langid.letter_table())(texts)
    for text, lang, score, (want, posterior) in zip(texts, *got, naive_bayes(rows, texts)):
        assert (lang, score) == (want, pytest.approx(posterior, abs=1e-4)), text


def test_batches_of_texts_sum_as_single_texts(monkeypatch):
    letters = langid.letter_table()
    logp = np.random.default_rng(1).standard_normal((1 << 15, 3)).astype(np.float32)
    texts = ["Ein Text", None, "", "a", "äöü 12 b" * 40, "...", "x" * 700, "b c", "y z " * 90]
    whole = langid._totals(texts, logp, (1, 2, 3), 15, letters)
    for limit in (1, 64, 500):
        monkeypatch.setattr(langid, "PIECE_CHARS", limit)
        part = langid._totals(texts, logp, (1, 2, 3), 15, letters)
        assert np.allclose(whole[0], part[0], atol=1e-3) and (whole[1] == part[1]).all()


def by_definition(x):
    """Maximal segments: the best one, then the same left and right of it."""
    best = None
    for i in range(len(x)):
        total = 0.0
        for j in range(i, len(x)):
            total += x[j]
            if total > 0 and (best is None or total > best[2] + 1e-12):
                best = (i, j + 1, total)
    if best is None:
        return []
    right = [(a + best[1], b + best[1], s) for a, b, s in by_definition(x[best[1] :])]
    return by_definition(x[: best[0]]) + [best] + right


def test_maximal_segments():
    rng = random.Random(2)
    for _ in range(300):
        x = np.array([rng.uniform(-3, 3) for _ in range(rng.randint(0, 25))])
        assert [s[:2] for s in toxicity.maximal_segments(x)] == [s[:2] for s in by_definition(x)]


@pytest.mark.parametrize("n, m", [(30, 20), (200, 190), (1000, 900), (1000, 3000)])
def test_merged_labels_lose_no_link(n, m):
    """Against plain union-find, on sparse random graphs, chains and comb shapes."""
    rng = random.Random(n + m)
    for turn in range(60):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        if turn % 3 == 0:
            order = rng.sample(range(n), n)
            pairs = list(zip(order, order[1:]))
        parent = list(range(n))

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in pairs:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        i, j = (np.array(c) for c in zip(*pairs))
        assert components.merge_labels(np.arange(n), i, j).tolist() == [root(x) for x in range(n)]


def test_toxicity_score_by_definition(spark):
    """Score and passages worked out from the model's tables with plain loops."""
    rng = random.Random(4)
    plain, bad = ["the", "house", "garden", "river", "stone", "walked"], ["idiotic", "idiots", "scumbags"]
    rows = [(i, " ".join(rng.choice(plain) for _ in range(40)) + (" " + " ".join(rng.choice(bad) for _ in range(6)) if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model, keep=["doc_id"]).collect()}
    shift = 32 - model["bits"]

    def word_score(word):
        units = [zlib.crc32(p.encode()) >> shift for p in [word, *(word[:k] + "*" for k in toxicity.PREFIXES if len(word) > k)]]
        best = max(units, key=lambda u: model["z"][u])
        return float(model["value"][best if model["z"][best] > 0 else units[0]]) - model["drift"]

    for i, text, _ in rows[:60]:
        x = [word_score(w) for w in text.split()]
        found = by_definition(x)
        best, whole, n = max((s for *_, s in found), default=0.0), sum(s for *_, s in found), len(x)
        floor = math.log(max(model["k"] * n, 1e-9))
        top, every = (max(model["lam"] * v - floor, 0.0) if v > 0 else 0.0 for v in (best, whole))
        evidence = [1.0, float(best > 0), math.log1p(top), math.log1p(every), math.sqrt(whole / n)]
        want = 1 / (1 + math.exp(-sum(a * b for a, b in zip(evidence, model["curve"]))))
        assert got[i]["score"] == pytest.approx(want, abs=1e-9)
        significant = [f"{a}:{b}" for a, b, s in found if model["k"] * n * math.exp(-model["lam"] * s) < toxicity.SIGNIFICANT]
        assert got[i]["passages"] == significant
    assert all((got[i]["score"] >= 0.7) == bool(toxic) for i, _, toxic in rows)


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF[:-4]}0.1/documents.parquet"), spark.read.parquet(f"{SF[:-4]}0.1/labels.parquet")
    model = toxicity.train(docs, labels.where(queries.remainder("doc_id", 3) != 1))
    held = labels.where(queries.remainder("doc_id", 3) == 1).join(docs.select("doc_id", "text"), "doc_id")
    got = toxicity.score_toxicity(held, model, keep=["doc_id", "toxic"]).collect()
    hit = sum(r["score"] >= 0.7 and r["toxic"] == 1 for r in got)
    false = sum(r["score"] >= 0.7 and r["toxic"] == 0 for r in got)
    assert hit >= 0.8 * sum(r["toxic"] for r in got)
    assert false <= 0.02 * sum(1 - r["toxic"] for r in got)


def test_toxicity_edges(spark, odd, odd_rows):
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    for model in (toxicity.train(odd, labels), toxicity.train(odd, labels.limit(0)), toxicity.train(odd.limit(0), labels)):
        got = toxicity.score_toxicity(odd, model, keep=["doc_id"]).collect()
        assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
        assert toxicity.score_toxicity(odd.limit(0), model, keep=["doc_id"]).collect() == []


# --- near-duplicates ----------------------------------------------------------


def fingerprint_by_definition(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def smallest_reachable(ids, near):
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], label[near[i]].min(initial=label[i])) for i in range(len(ids))])
        if np.array_equal(new, label):
            return label
        label = new


def test_simhash_query_by_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.op5_simhash_near_dedup(spark, SF).collect()}
    rows = sorted(table("documents"), key=lambda r: r["doc_id"])
    prints = np.array([fingerprint_by_definition(r["text"]) for r in rows], np.uint64)
    ids = [r["doc_id"] for r in rows]
    label = smallest_reachable(ids, np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    for i, fp, component in zip(ids, prints, label):
        assert got[i]["fingerprint"] == f"{int(fp):016x}" and got[i]["component_id"] == component


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
    near = rng.choice(base, n // 4)
    dense = np.full(n // 3, base[0])
    for k in range(4):
        near = near ^ np.where(rng.random(len(near)) < 0.4, np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64), np.uint64(0))
        dense = dense ^ (np.uint64(1) << rng.integers(0, 64, len(dense)).astype(np.uint64))
    return np.unique(np.concatenate([base, near, dense]))


def test_hamming_search_is_exact(spark):
    prints = clustered(6000)
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    want = components.merge_labels(np.arange(len(prints)), i, j)
    assert np.array_equal(simhash_vp.link_shard(prints), want)
    df = spark.createDataFrame([(int(f),) for f in prints.view(np.int64)], "fp long")
    for how in ({}, {"sample": 500, "shard_rows": 64}, {"shard_rows": 100}):
        got = simhash_vp.hamming_components(df, **how).toPandas()
        root = dict(zip(got["fp"], got["root"]))
        mine = [root[f] for f in prints.view(np.int64).tolist()]
        groups, wanted = {}, {}
        for k, (a, b) in enumerate(zip(mine, want.tolist())):
            groups.setdefault(a, []).append(k)
            wanted.setdefault(b, []).append(k)
        assert sorted(groups.values()) == sorted(wanted.values())


def test_dense_region_by_keys(spark):
    prints = np.unique(np.concatenate([clustered(30), np.uint64(5) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))]))
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    want = components.merge_labels(np.arange(len(prints)), i, j)
    df = spark.createDataFrame([(int(f),) for f in prints.view(np.int64)], "fp long")
    found = components.connected_components(simhash_vp._edges_of_keys(df)).toPandas()
    of = dict(zip(found["node"], found["component"]))
    mine = [of.get(f, f) for f in prints.view(np.int64).tolist()]
    assert len(set(mine)) == len(set(want.tolist()))
    assert all((mine[a] == mine[b]) == (want[a] == want[b]) for a in range(len(prints)) for b in range(a))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5000 + i) for i in range(1, 300)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    low = {v: v for e in edges if None not in e and e[0] != e[1] for v in e}
    for _ in range(len(low)):
        before = dict(low)
        for a, b in edges:
            if a in low and b in low:
                low[a] = low[b] = min(low[a], low[b])
        if before == low:
            break
    assert got == low
    assert components.connected_components(df.limit(0)).collect() == []


def test_simhash_edges(docs, odd, odd_rows):
    got = simhash_vp.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    of = {r["id"]: r for r in got}
    assert [of[i]["fp"] for i in (2, 3, 4)] == [0, 0, 0] and {of[i]["component_id"] for i in (2, 3, 4)} == {2}
    kept = simhash_vp.keep_first(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == sorted({of[i]["component_id"] for i in of if of[i]["component_id"] is not None}) + [None]
    assert simhash_vp.keep_first(odd.limit(0)).collect() == []
    assert simhash_vp.near_duplicates(odd.limit(0)).collect() == []
    same = docs([(5, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (None, "a b c d e")])
    assert [r["doc_id"] for r in simhash_vp.keep_first(same).collect()] == [4]


def test_vectors_by_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 32))
    rows = [centres[rng.integers(30)] + rng.standard_normal(32) * rng.choice([0.02, 0.2, 0.25, 0.3, 0.4, 1.0]) for _ in range(900)]
    x = np.concatenate([np.array(rows), centres[0] + rng.standard_normal((200, 32)) * 0.2, np.repeat(centres[1:2], 60, 0)]).astype(np.float32)
    ids = rng.permutation(len(x))
    odd = [(9001, None), (9002, [0.0] * 32), (9003, [float("nan")] * 32), (9004, [1.0, 2.0]), (9005, [2.0, 4.0]), (9006, [])]
    odd += [(9007, [1.0, None])]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)] + odd, "vec_id long, embedding array<float>")
    df = df.withColumn("node", F.lit("extra")).withColumn("n_links", F.lit("extra"))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    label = smallest_reachable(ids, near)
    for block in (2048, 50):
        got = {r["id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicate_vectors(df, block_rows=block).collect()}
        assert all(got[i] == (n, c) for i, n, c in zip(ids, near.sum(axis=1), label))
        assert got[9004] == got[9005] == (1, 9004)
        assert all(got[i] == (0, i) for i in (9001, 9002, 9003, 9006, 9007))
    assert vectors.near_duplicate_vectors(df.limit(0)).collect() == []


def test_embedding_query_by_brute_force(spark):
    rows = table("embeddings")
    x = np.array([r["embedding"] for r in rows], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    label = smallest_reachable([r["vec_id"] for r in rows], near)
    got = {r["vec_id"]: r for r in queries.op7_embedding_near_dedup(spark, SF).collect()}
    assert len(got) == len(rows)
    for r, n, c in zip(rows, near.sum(axis=1), label):
        mine = got[r["vec_id"]]
        assert (mine["n_links"], mine["component_id"], mine["kept"]) == (n, c, c == r["vec_id"])


# --- decontamination ----------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated_by_definition(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        n = min(10, len(v))
        if item is None or not n:
            continue
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_winnowing_by_brute_force(spark, docs, odd_rows):
    rng = random.Random(6)
    pool = ["a", "b", "C", "d1", "é", "日"]
    say = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 5, 9, 10, 11, 25]))) for i in range(25)] + [(None, say(12)), (3, say(15)), (90, None), (91, "Lazy DOG and runs")]
    rows = [(i, say(rng.randint(0, 60))) for i in range(80)] + [(500 + i, say(4) + " " + t + " " + say(5)) for i, t in items[:20] if i is not None]
    rows += odd_rows + [(i, t) for i, t in odd_rows[:2]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnow.contamination(docs(rows), bench, item_id_col="item_id", item_text_col="text").collect()
    assert len(got) == len(rows)
    mine = sorted((str(r["id"]), r["n_words"], r["n_hit"], tuple(r["items"])) for r in got)
    want = sorted((str(i), n, h, tuple(f)) for i, t in rows for n, h, f in [contaminated_by_definition(t, items)])
    assert mine == want
    kept = winnow.drop_contaminated(docs(rows), bench)
    assert kept.count() == sum(h == 0 for _, _, h, _ in want)


def test_winnowing_edges(spark, odd, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    got = winnow.contamination(odd, none).collect()
    assert len(got) == len(odd_rows) and not any(r["contaminated"] for r in got)
    some = spark.createDataFrame([(1, "brown fox jumps")], "item_id long, text string")
    assert winnow.contamination(odd.limit(0), some).collect() == []
    assert sum(r["n_hit"] for r in winnow.contamination(odd, some).collect()) == 6


def test_winnowing_without_broadcast(spark, docs, monkeypatch):
    monkeypatch.setattr(winnow, "BROADCAST_ROWS", -1)
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    got = winnow.contamination(docs([(1, "zero one two three four five six seven eight nine ten end")]), bench).collect()
    assert [(r["n_hit"], r["items"]) for r in got] == [(10, ["1"])]


@pytest.mark.parametrize("query", ["op3_decontamination", "op10_sharding"])
def test_native_queries_run_no_python(spark, query):
    plan = queries.QUERIES[query](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- sharding -----------------------------------------------------------------


def test_shards(spark):
    got = queries.op10_sharding(spark, SF).collect()
    rows = {r["doc_id"]: (r["text"] or "").encode() for r in table("documents")}
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    slots = {}
    for r in got:
        assert r["text_crc32"] == zlib.crc32(rows[r["doc_id"]]) and r["size"] == len(rows[r["doc_id"]]) + 16
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["slot"], r["shard"]))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.15


def test_shard_edges_and_files(spark, docs, odd, odd_rows, tmp_dir):
    placed = sharding.shuffled(odd, 4)
    assert placed.count() == len(odd_rows)
    assert sorted(str(r["text"]) for r in placed.collect()) == sorted(str(t) for _, t in odd_rows)
    sharding.write_shards(placed, f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.count() == len(odd_rows) and len([d for d in os.listdir(f"{tmp_dir}/shards") if d.startswith("shard=")]) == 4
    assert sharding.shuffled(odd.limit(0), 4).collect() == []
    same = sharding.shuffled(docs([(1, "same")] * 300), 3).collect()
    assert sorted((r["shard"], r["slot"]) for r in same) == [(s, k) for s in range(3) for k in range(100)]


def test_buckets_follow_all_columns(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sharding, "scratch_path", lambda *_: f"{tmp_dir}/buckets")
    df = spark.range(400).selectExpr(
        "id AS doc_id", "'short' AS text", "repeat('h', 4000) AS html", "map('k', id) AS meta", "array_repeat(0.5D, 200) AS v",
        "1.5BD AS price", "CAST(NULL AS binary) AS b", "current_date() AS d", "struct(id) AS `s.t`", "id AS nth",
    )
    got = sharding.shuffled(df, 3, bucket_bytes=1 << 16).collect()
    assert sorted((r["doc_id"], r["nth"], r["meta"]["k"], len(r["html"]), r["size"]) for r in got) == [(i, i, i, 4000, 21) for i in range(400)]
    assert sorted((r["slot"], r["shard"]) for r in got) == [(i // 3, i % 3) for i in range(400)]
    assert spark.read.parquet(f"{tmp_dir}/buckets").select("b").distinct().count() >= 400 * 4000 // (1 << 16)


# --- pipeline -----------------------------------------------------------------


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in table("documents")}
    items = [(r["item_id"], r["text"]) for r in table("benchmark")]
    kept = sorted(i for i, r in rows.items() if any(map(str.isalpha, r["text"] or "")))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        left = corpus_pipeline.materialize(stage(spark, left, SF), name)
        assert left.columns == docs.columns and left.dtypes == docs.dtypes
        if name == "near_duplicates":
            prints = np.array([fingerprint_by_definition(rows[i]["text"]) for i in kept], np.uint64)
            label = smallest_reachable(kept, np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
            kept = [i for i, c in zip(kept, label) if i == c]
        if name == "decontamination":
            kept = [i for i in kept if not contaminated_by_definition(rows[i]["text"], items)[1]]
        assert sorted(r["doc_id"] for r in left.select("doc_id").collect()) == kept
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert all(texts[i] == rows[i]["text"] or "[" in texts[i] for i in kept)
    last = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in last) == kept and all(r["round_trip"] for r in last)


def test_pipeline_edges(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, SF)
        if name != "tokens":
            assert got.columns == odd.columns
        got.count()
        assert stage(spark, odd.limit(0), SF).count() == 0
