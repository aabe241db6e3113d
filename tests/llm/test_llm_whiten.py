import numpy as np
import pytest
from millrace.llm.feast import count_above, inertia, largest_eigenpairs
from millrace.llm.whiten import whitened

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string"


def brute(rows):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    ints = [(i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)) for i, v in good]
    fit = np.array(sorted({v for _, v in ints}), float)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    return ints, n, sums, cov, e[::-1], u[:, ::-1]


def test_whitening_is_that_of_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    spread = rng.standard_normal((12, 12))
    rows = [(i, [float(c) for c in rng.standard_normal(12) @ spread / 3 + 0.5]) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)] + [(7, rows[7][1]), (None, rows[8][1])]
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (2004, [1.0]), (2005, [])]
    df = spark.createDataFrame([(i, v, 1, 5, "a") for i, v in rows], SCHEMA)
    found = whitened(df).collect()
    ints, n, sums, cov, e, u = brute([(i, v) for i, v in rows if v is None or len(v) == 12])
    assert len(found) == 4 * len(ints)
    assert {r["n"] for r in found} == {n} == {300}
    for r in found:
        k = r["component"] - 1
        assert abs(r["explained"] / (e[k] / np.trace(cov)) - 1) < 1e-10 and r["identity_error"] < 1e-10
    by_id = {}
    for i, v in ints:
        by_id.setdefault(i, []).append(v)
    signs = {}
    for r in found:
        x = np.array(by_id[r["vec_id"]][0])
        k = r["component"] - 1
        want = (x - sums / n) @ u[:, k] / np.sqrt(e[k])
        sign = signs.setdefault(k, np.sign(want * r["whitened"]))
        assert abs(want - sign * r["whitened"]) < 1e-8
        assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))


def test_empty_constant_short_and_huge_vectors(spark):
    def run(vectors):
        return whitened(spark.createDataFrame([(i, v, 0, 0, "") for i, v in enumerate(vectors)], SCHEMA)).collect()

    assert run([]) == [] and run([None, []]) == []
    same = run([[1.0, 2.0]] * 5)
    assert len(same) == 10 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in same)
    one = run([[1.0], [2.0], [2.0]])
    assert sorted(abs(r["whitened"]) for r in one) == pytest.approx([1.0, 1.0, 1.0])
    huge = run([[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0]])
    assert len(huge) == 6 and {r["deviation"] for r in huge if r["vec_id"] != 2} == {None}


def test_inertia_and_eigenpairs():
    rng = np.random.default_rng(5)
    for d in (1, 2, 5, 40):
        a = rng.standard_normal((d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        assert inertia(a) == (int((e < 0).sum()), 0, int((e > 0).sum()))
        assert count_above(a, e.mean()) == int((e > e.mean()).sum())
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 0, 1) and inertia(np.zeros((3, 3))) == (0, 3, 0)
    # Many equal eigenvalues, a cluster, and far too few non-zero ones.
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    for values in (np.ones(40), np.r_[5, 5, 5, np.ones(37)], np.r_[3 + 1e-9 * np.arange(20), np.zeros(20)], np.r_[2.0, np.zeros(39)]):
        e, v = largest_eigenpairs(q @ np.diag(values) @ q.T, 4)
        assert e == pytest.approx(sorted(values)[::-1][:4], abs=1e-12)
        assert np.abs(v.T @ v - np.eye(4)).max() < 1e-12
