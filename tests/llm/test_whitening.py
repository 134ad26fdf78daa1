import math

import numpy as np
import pytest

from hearth.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "n", "x") for i, v in rows], SCHEMA)


def brute(rows, components=4, scale=256):
    """By the definition: exact sums, and the eigenvectors of the whole covariance matrix."""
    whole = [(i, [math.floor(float(np.float32(c)) * scale) for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    a = np.array(fit, float) - mean
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    keep = e > 1e-9 * max(e[0], 1e-300)
    e, q = e[keep], q[:, keep]
    out = {}
    for k in range(len(e)):
        for i, x in whole:
            dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
            out.setdefault((i, k + 1), []).append((n, dev, float((np.array(x) - mean) @ q[:, k] / math.sqrt(e[k])), float(e[k] / (a * a).sum() * n)))
    return out


def compare(got, want, exact_sign=False):
    mine = {}
    for r in got:
        mine.setdefault((r.vec_id, r.component), []).append((r.n, int(r.deviation), r.whitened, r.explained))
        assert r.identity_error < 1e-9
    assert mine.keys() == want.keys()
    for k in {c for _, c in want}:
        ids = [i for i in want if i[1] == k]
        sign = 0.0
        for i in ids:
            for g, w in zip(sorted(mine[i]), sorted(want[i])):
                assert g[:2] == w[:2] and g[3] == pytest.approx(w[3], rel=1e-9)
                sign += g[2] * w[2]
        for i in ids:
            for g, w in zip(sorted(mine[i]), sorted(want[i])):
                assert g[2] * math.copysign(1, sign) == pytest.approx(w[2], abs=1e-7)


def vectors(n, d, seed, spread=None):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * (spread if spread is not None else np.linspace(2, 0.3, d))).astype(np.float32)


def test_against_the_whole_covariance(spark):
    x = vectors(200, 12, 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, x[3].tolist()), (None, x[4].tolist()), (7, x[5].tolist())]
    rows += [(2000, None), (2001, [None] * 12), (2002, [1.0] * 11 + [float("nan")]), (2003, [float("inf")] + [0.0] * 11), (2004, [])]
    compare(wh.whiten(frame(spark, rows)).collect(), brute(rows))


def test_negative_zero_hot_vector_and_small_spaces(spark):
    """A vector with most rows counts once; vectors on a line have one component, alike ones none."""
    line = [(i, [0.5 * i, -0.25 * i, -0.0]) for i in range(6)] + [(100 + i, [0.5, -0.25, 0.0]) for i in range(50)]
    compare(wh.whiten(frame(spark, line)).collect(), brute(line))
    assert {r.component for r in wh.whiten(frame(spark, line)).collect()} == {1}
    for rows in ([], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [0.0, 0.0])]):
        assert wh.whiten(frame(spark, rows)).collect() == []


def test_vectors_of_another_length_go(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(30, 5, 2))] + [(100, [1.0, 2.0]), (101, [3.0] * 7)]
    compare(wh.whiten(frame(spark, rows)).collect(), brute(rows[:30]))


def test_deviations_beyond_longs_are_exact(spark):
    rows = [(i, (v * 2.0 ** 20).tolist()) for i, v in enumerate(vectors(40, 4, 3))]
    want = brute(rows)
    assert max(w[0][1] for w in want.values()) > 2 ** 62
    compare(wh.whiten(frame(spark, rows)).collect(), want)


def products_of(a):
    return lambda p: (float((a @ p) @ (a @ p)), a.T @ (a @ p))


@pytest.mark.parametrize("seed", range(6))
def test_bidiagonalisation_finds_the_leading_values(seed):
    """Against a whole decomposition, with slow and with fast decay; a fast one needs fewer steps than dimensions."""
    rng = np.random.default_rng(seed)
    d = 40
    spread = 0.5 ** np.arange(d) if seed % 2 else np.linspace(2, 1, d)
    a = rng.standard_normal((300, d)) * spread
    sigma, right, steps = wh.bidiagonalise(products_of(a), d, 299, 4, seed)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(sigma, s[:4], rtol=1e-12)
    assert np.allclose(np.abs((vt[:4] @ right).diagonal()), 1, atol=1e-12)
    assert steps < d if seed % 2 else steps <= d


@pytest.mark.parametrize("values", [[3, 3, 3, 3, 1, 1, 1, 1], [5, 2, 2, 2, 2, 2, 2, 2], [4, 3, 0, 0, 0, 0, 0, 0], [1] * 8, [9, 9, 5, 5, 5, 1, 1, 1]])
def test_repeated_values_are_all_found(values):
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((8, 8)))
    u, _ = np.linalg.qr(rng.standard_normal((50, 8)))
    a = u @ np.diag(np.array(values, float)) @ q.T
    sigma, right, _ = wh.bidiagonalise(products_of(a), 8, 50, 4)
    want = [v for v in sorted(values, reverse=True)[:4] if v]
    assert np.allclose(sigma, want, rtol=1e-12)
    assert np.allclose(right.T @ right, np.eye(len(want)), atol=1e-12)
    assert np.allclose(np.linalg.norm(a @ right, axis=0), want, rtol=1e-12)


def test_query(spark):
    from hearth.llm.common import table
    from hearth.llm.queries import QUERIES

    got = QUERIES["op13_whitened_vectors"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["deviation"] == "bigint"
    rows = [(r.vec_id, r.embedding) for r in table(spark, "/root/testdata/sf0.001", "embeddings").collect()]
    compare(got.collect(), brute(rows))
