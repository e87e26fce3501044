"""Whitening against numpy's eigenvectors."""

import math

import numpy as np
import pytest

from tallyrec.llm import whitening

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", 0) for i, e in rows], "vec_id long, embedding array<double>, x string, n int")


def result(df):
    return whitening.whiten(df, whitening.fit(df))


def check(rows, out, width, components=4):
    """All columns against numpy; the whitened ones up to sign, or by their covariance where eigenvalues are equal."""
    left = [(i, [*e, *[0.0] * (width - len(e))]) for i, e in rows
            if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    x = np.array([[math.floor(256 * c) for c in e] for _, e in left], object)
    u = sorted(set(map(tuple, x.tolist())))
    n, total = len(u), [sum(c) for c in zip(*u, strict=True)]
    c = np.array(u, float) - np.array(total, float) / n
    value, vector = np.linalg.eigh(c.T @ c / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(components, int((value > 1e-12 * value[0]).sum()))
    got = [tuple(r) for r in out.collect()]
    assert len(got) == k * len(left)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, total, strict=True)) for row in x.tolist()]
    by_id = {}
    for row, d in zip(left, deviation, strict=True):
        by_id.setdefault(row[0], []).append((d, (np.array([math.floor(256 * c) for c in row[1]], float) - np.array(total, float) / n)))
    signs = {}
    for vec_id, component, rows_n, d, w, explained, error in got:
        assert rows_n == n and error <= 1e-4 and abs(explained - value[component - 1] / value.sum()) <= 1e-9
        known = by_id[vec_id]
        assert d in [a for a, _ in known]
        gap = min([abs(value[component - 1] - o) for j, o in enumerate(value) if j != component - 1] or [1]) / value[0]
        if gap > 1e-6 and len(known) == 1:
            want = known[0][1] @ vector[:, component - 1] / math.sqrt(value[component - 1])
            if abs(want) > 1e-3:
                assert abs(abs(w) - abs(want)) < 1e-8 * max(1, abs(want))
                assert signs.setdefault(component, np.sign(w * want)) == np.sign(w * want)


def test_query_by_numpy(spark):
    from tallyrec.llm.queries import QUERIES

    out = QUERIES["op13_golub_kahan_whitening"](spark, SMALL)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, out, 64)


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.standard_normal(6) * [5, 3, 1, 1, .2, .01]).tolist()) for i in range(300)]
    rows += [(900, None), (901, [1.0, None, 0.0]), (902, [math.nan] * 6), (903, [math.inf] + [0.0] * 5), (904, [-math.inf] * 6),
             (905, [0.5, -0.25]), (906, []), (907, [-0.0] * 6), (None, rows[0][1]), rows[1], rows[1]]
    check(rows, result(frame(spark, rows)), 6)


def test_equal_eigenvalues_are_all_found(spark):
    rows = [(4 * i + j, [float(s * 2 * (a == i)) for a in range(7)]) for i in range(7) for j, s in enumerate((1, -1))]
    out = result(frame(spark, rows)).toPandas()
    assert out.component.max() == 4 and np.allclose(out.explained, 1 / 7, atol=1e-12) and (out.identity_error < 1e-9).all()
    w = out.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(-1, 4)
    assert np.allclose(w.T @ w / len(w), np.eye(4), atol=1e-9)


def test_few_or_no_components(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]
    check(line, result(frame(spark, line)), 3)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        out = result(frame(spark, rows))
        assert out.count() == 0 and len(out.columns) == 7


def test_huge_entries(spark):
    rows = [(i, [1e300 if i == 3 else 2.0**45 + i, float(i % 5)]) for i in range(9)]
    out = result(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in out} == set(range(9)) and all(math.isfinite(r["whitened"]) for r in out)
    assert any(r["deviation"] is None for r in out)
