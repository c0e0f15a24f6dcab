import math
from fractions import Fraction

import numpy as np
import pytest

from layerkit.llm import whitening as wh

from .small import SF01

VECTORS = "vec_id long, embedding array<double>, kept string, component int"


def plain(rows, count=4):
    """By numpy, from exact centred numbers: {id: (deviation, ...)}, eigenvalues, whitened up to sign."""
    fine = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    xs = {i: tuple(math.floor(256 * float(c)) for c in v) for i, v in fine}
    fit = sorted(set(xs.values()))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in fit])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    trace = sum(Fraction((n * a - b) ** 2, n * n) for x in fit for a, b in zip(x, s)) / n
    return n, {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in xs.items()}, e[:count], u[:, :count], \
        {i: np.array([(n * a - b) / n for a, b in zip(x, s)]) for i, x in xs.items()}, float(trace)


def given(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "clash", 9) for i, v in rows], VECTORS)


def test_whole_table_against_numpy(spark):
    got = wh.op11_whitening(spark, SF01).collect()
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    n, deviation, e, u, y, trace = plain(rows)
    assert len(got) == 4 * len(deviation) and {r["n"] for r in got} == {n}
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-12
    sign = {}
    for r in got:
        k = r["component"] - 1
        want = float(y[r["vec_id"]] @ u[:, k]) / math.sqrt(e[k])
        sign.setdefault(k, np.sign(want) * np.sign(r["whitened"]))
        assert r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["whitened"] - sign[k] * want) < 1e-9
        assert abs(r["explained"] - e[k] / trace) < 1e-12


def matrix_poly(m):
    """det(x I - m) by Faddeev and LeVerrier, in fractions."""
    n = len(m)
    a, c, out = [[Fraction(int(x)) for x in r] for r in m], Fraction(1), [Fraction(1)]
    mk = [[Fraction(0)] * n for _ in range(n)]
    for k in range(1, n + 1):
        mk = [[sum(a[i][t] * mk[t][j] for t in range(n)) + (c if i == j else 0) for j in range(n)] for i in range(n)]
        c = -sum(a[i][t] * mk[t][i] for i in range(n) for t in range(n)) / k
        out.append(c)
    return [int(x) for x in out[::-1]]


@pytest.mark.parametrize("d, rank, size", [(1, 1, 5), (2, 2, 10), (5, 3, 7), (8, 8, 10**6), (7, 7, 10**19)])
def test_characteristic_polynomial(spark, d, rank, size):
    rng = np.random.default_rng(d)
    b = np.array([[int(x) * size // 100 for x in r] for r in rng.integers(-100, 100, (rank, d))], dtype=object)
    m = b.T @ b
    poly = wh.characteristic(spark, m)
    assert poly == matrix_poly(m)
    # A polynomial modulo a small prime needs swaps and meets columns of zeros.
    for p in (2, 3, 5, 101):
        assert wh.polynomial_mod(m, p).tolist() == [c % p for c in poly]


def test_roots_of_known_polynomials():
    roots = [10**18 + 1, 10**18, 10**18, 7, 7, 7, 3, 0, 0]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    for k, r in enumerate(roots, 1):
        found = wh.root(poly, k)
        if r == 0:
            assert found is None
            continue
        lo, hi, s, first = found
        assert Fraction(lo, 1 << s) < r <= Fraction(hi, 1 << s) and (hi - lo) << 100 <= hi
        assert first == roots.index(r) + 1
    # x ^ 2 - 4 x + 2: 2 + sqrt(2), 2 - sqrt(2)
    lo, hi, s, _ = wh.root([2, -4, 1], 2)
    assert (2 * (1 << s) - hi) ** 2 <= 2 << 2 * s <= (2 * (1 << s) - lo) ** 2


def test_equal_and_close_eigenvalues(spark):
    """Eigenvalues 9, 9, 9 - tiny, 1 in a turned frame with whole numbers."""
    h = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]], dtype=object)
    big = 10**30
    m = h @ np.diag(np.array([9 * big, 9 * big, 9 * big - 1, big], dtype=object)) @ h.T
    found = wh.components(spark, m, 1, 4)
    v = np.array([x for _, _, x in found])
    assert np.abs(v @ v.T - np.eye(4)).max() < 1e-15
    assert np.abs(np.abs(v[2] @ h / 2) - [0, 0, 1, 0]).max() < 1e-14 and np.abs(np.abs(v[3] @ h / 2) - [0, 0, 0, 1]).max() < 1e-14
    assert [e for e, _, _ in found] == pytest.approx([36e30, 36e30, 36e30, 4e30], rel=1e-15)
    assert sum(x for _, x, _ in found) == pytest.approx(1, abs=1e-15)


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(40)] * 2 + [(None, [0.0] * 6), (50, [0.0] * 6)]
    rows += [(60, None), (61, []), (63, [float("nan")] * 6), (64, [float("inf")] + [0.0] * 5), (65, [None] + [1.0] * 5)]
    rows += [(70, [1.0, 2.0]), (71, [3.0, 1.0]), (72, [3.0, 1.0]), (80, [5.0]), (90, [1.0, 2.0, 1e300]), (91, [1.0, -2.0, -1e300]), (92, [1.0, 4.0, 3.0])]
    got = wh.whiten(given(spark, rows), ["vec_id", "kept"]).collect()
    size = {}
    for r in got:
        size.setdefault(r["vec_id"], []).append(r)
    assert all(len(size[i]) == 8 for i in range(40)) and len(size[None]) == len(size[50]) == 4
    assert not {60, 61, 63, 64, 65} & set(size) and {r["kept"] for r in got} == {"clash"}
    six = [r for r in rows if r[1] and len(r[1]) == 6 and all(x is not None and math.isfinite(x) for x in r[1])]
    n, deviation, e, u, y, trace = plain(six)
    assert n == 41 and all(r["deviation"] == deviation[i] for i in range(40) for r in size[i])
    assert all(r["identity_error"] < 1e-12 for i in range(40) for r in size[i])
    assert [r["explained"] for r in sorted(size[50], key=lambda r: r["component"])] == pytest.approx((e / trace).tolist())
    # Two distinct vectors: one component with variance.
    two = {r["component"]: r for r in size[70]}
    assert set(two) == {1, 2} and abs(two[1]["whitened"]) == pytest.approx(1) and two[1]["explained"] == pytest.approx(1)
    assert two[2]["whitened"] is None and two[2]["explained"] == 0 and two[1]["n"] == 2
    assert [(r["component"], r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in size[80]] == [(1, None, 0.0, 0, 0.0)]
    huge = {r["component"]: r for r in size[90]}
    assert huge[1]["deviation"] is None and huge[1]["explained"] == pytest.approx(1) and huge[1]["identity_error"] < 1e-9
    assert wh.whiten(given(spark, []), ["vec_id"]).count() == 0
    assert wh.whiten(given(spark, [(1, None)]), ["vec_id"]).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_sums_of_any_size():
    rng = np.random.default_rng(5)
    for top in (100, 1 << 28, 1 << 40, (1 << 63) - 1):
        x = rng.integers(-top, top, (50, 3), endpoint=True)
        o = x.astype(object)
        assert (wh.exact_products(x) == o.T @ o).all()
        y = wh.centred(x, 7, [1, 2, 3])
        assert (y.astype(object) == 7 * o - np.array([1, 2, 3], dtype=object)).all()
        assert wh.squares(y) == [v if (v := sum(int(c) ** 2 for c in r)) < 1 << 63 else None for r in y]
