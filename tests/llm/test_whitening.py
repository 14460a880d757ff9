"""Whitening against numpy's eigensolver and the definition; odd rows."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from rawhouse.llm import whitening as wh
from rawhouse.llm.queries import op12_embedding_whitening

SF = "/root/testdata/sf0.01"


def brute(vectors, scale=64, shift=1_000_000):
    x = np.floor(np.asarray(vectors, np.float64) * scale).astype(np.int64) + shift
    n, sums = len(x), [int(s) for s in x.astype(object).sum(axis=0)]
    deviation = [sum((n * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in x]
    centred = (x.astype(object) * n - np.array(sums, object)).astype(np.float64) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, values[::-1], turn[:, ::-1], sum(deviation) / n**3


def same_up_to_sign(a, b, tol):
    sign = np.sign((a * b).sum(axis=0))
    assert np.abs(a - b * sign).max() <= tol


def test_query_against_numpy(spark):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    n, deviation, centred, values, turn, trace = brute([r["embedding"] for r in rows])
    got = op12_embedding_whitening(spark, SF).collect()
    assert len(got) == 32 * n and {r["component"] for r in got} == set(range(1, 33))
    place = {r["vec_id"]: i for i, r in enumerate(rows)}
    w = np.zeros((n, 32))
    for r in got:
        i, k = place[r["vec_id"]], r["component"] - 1
        w[i, k] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[i]
        assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-10)
    same_up_to_sign(w, centred @ turn[:, :32] / np.sqrt(values[:32]), 1e-8)
    error = np.abs(np.cov(w.T, bias=True) - np.eye(32)).max()
    assert got[0]["identity_error"] < 1e-9 and error < 1e-9 and len({r["identity_error"] for r in got}) == 1


class Dense:
    """Products with a given matrix, counted as passes."""

    def __init__(self, v):
        self.v, self.dim, self.passes = v, len(v), 0

    def times(self, q):
        self.passes += 1
        return self.v @ q


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(100, 50, 80),
        np.geomspace(1e6, 1e-3, 80),
        np.concatenate(([1e5, 10.0], np.linspace(2, 1, 78))),
        np.concatenate((np.full(40, 7.0), np.linspace(5, 1, 40))),  # equal eigenvalues
        np.concatenate((np.linspace(9, 8, 6), np.zeros(74))),  # fewer than wanted
        np.full(80, 3.0),
    ],
    ids=["flat", "steep", "spikes", "ties", "low rank", "sphere"],
)
def test_filtered_iteration_on_known_spectra(values):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((80, 80)))
    v = Dense((q * values) @ q.T)
    found, vectors, residual, rounds = wh.leading(v, 20, guards=6)
    live = int((values[:20] > 1e-11 * values[0]).sum())
    assert len(found) == live and residual <= 1e-10 and v.passes < 400
    assert np.abs(found - values[:live]).max() <= 1e-10 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(live)).max() < 1e-12
    assert np.abs(v.v @ vectors - vectors * found).max() <= 1e-10 * values[0]


def test_the_filter_does_the_work(monkeypatch):
    """With the polynomial replaced by one plain product, far more passes are needed."""
    values = np.concatenate((np.linspace(60, 52, 20), np.linspace(51, 40, 60)))
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((80, 80)))
    fast, slow = Dense((q * values) @ q.T), Dense((q * values) @ q.T)
    wh.leading(fast, 20, guards=6)
    monkeypatch.setattr(wh, "_filtered", lambda v, bound, q, vq, *rest: vq)
    wh.leading(slow, 20, guards=6, max_rounds=5000)
    assert slow.passes > 5 * fast.passes


ODD = [
    (1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 0.0, 0.0]), (5, [float("inf"), 0.0, 0.0]),
    (6, []), (7, [0.0, 0.0, 0.0]), (8, [-1.5, 0.25, 3.0]), (8, [-1.5, 0.25, 3.0]), (None, [0.1, -2.0, 1.0]), (9, [2.0, 2.0, -1.0]),
]


def table(spark, rows, kind="double"):
    schema = f"vec_id long, embedding array<{kind}>, x string, id string, n long, whitened string, k int, v int"
    return spark.createDataFrame([(i, v, "x", "y", 1, "w", 2, 3) for i, v in rows], schema)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_odd_rows(spark, kind):
    good = [(i, v) for i, v in ODD if v and None not in v and np.isfinite(v).all()]
    got, model = wh.whiten(table(spark, ODD, kind))
    stored = np.array([v for _, v in good], np.float32 if kind == "float" else np.float64)
    n, deviation, centred, values, turn, _ = brute(stored)
    rows = got.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["id"], r["deviation"]) for r in rows), key=key) == sorted(((i, d) for (i, _), d in zip(good, deviation)), key=key)
    assert model.n == n == 6 and wh.identity_error(got, 3, n) < 1e-10
    by = {r["deviation"]: r["whitened"] for r in rows}
    same_up_to_sign(np.array([by[d] for d in deviation]), centred @ turn / np.sqrt(values), 1e-9)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [1.0, 2.0])] * 3):
        assert wh.whiten(table(spark, rows))[0].collect() == []
    with pytest.raises(ValueError):
        wh.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_deviations_are_exact_beyond_doubles():
    x = np.array([[3 * 10**6, 1], [1, 5], [7, 10**6]], np.int64)
    for n in (10**3, 10**9):
        sums = np.array([n * 1_000_003 + 1, n * 17 + 5], object)
        want = [sum((n * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in x]
        assert wh.deviations(x, n, sums) == want
