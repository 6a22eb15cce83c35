"""Exact k-NN over k-d cells against brute force, and that a row goes to few other cells."""

import numpy as np
import pytest

from sensorlab.operators import sampling


def brute(x, lab, k):
    out = {}
    for i in range(len(x)):
        same = np.flatnonzero(lab == lab[i])
        same = same[same != i]
        d = np.sqrt(((x[same] - x[i]) ** 2).sum(axis=1))
        order = np.lexsort((same, d))[:k]
        out[i] = [int(v) for v in same[order]]
    return out


def found(spark, x, lab, k, cell):
    names = [f"f{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(i, str(lab[i]), *map(float, x[i])) for i in range(len(x))],
                               "udi long, label string, " + ", ".join(f"{n} double" for n in names))
    got = {}
    for r in sampling.knn_within_class(df, names, k=k, block_size=cell).collect():
        got.setdefault(r["udi"], []).append((r["rank"], r["neighbor_udi"], r["distance"]))
    for i, rows in got.items():
        assert [r for r, _, _ in sorted(rows)] == list(range(1, len(rows) + 1))
        assert all(d == pytest.approx(np.sqrt(((x[i] - x[j]) ** 2).sum()), abs=1e-12) for _, j, d in rows)
    return {i: [j for _, j, _ in sorted(rows)] for i, rows in got.items()}


def test_ties_clusters_and_outliers(spark):
    rng = np.random.default_rng(11)
    grid = rng.integers(0, 5, (700, 4)).astype(float)                    # many equal distances
    x = np.r_[grid, rng.normal(scale=0.01, size=(300, 4)) + 9, [[500.0, 0, 0, 0], [-500.0, 1, 1, 1]]]
    lab = rng.integers(0, 3, len(x))
    assert found(spark, x, lab, 5, 32) == brute(x, lab, 5)


def test_many_equal_rows(spark, monkeypatch):
    used = []
    plain = sampling._first_copies
    monkeypatch.setattr(sampling, "_first_copies", lambda *a: used.append(1) or plain(*a))
    rng = np.random.default_rng(12)
    x = np.r_[np.tile([[1.0, 2.0]], (400, 1)), np.tile([[1.0, 2.5]], (3, 1)), rng.normal(size=(200, 2)).round(2)]
    x = x[rng.permutation(len(x))]
    lab = np.zeros(len(x), int)
    assert found(spark, x, lab, 4, 16) == brute(x, lab, 4)
    assert used


def test_missing_values_have_no_neighbours(spark):
    df = spark.createDataFrame([(i, 0, float(i) if i % 4 else None) for i in range(20)], "udi long, label int, a double")
    rows = sampling.knn_within_class(df, ["a"], k=2).collect()
    assert {r["udi"] for r in rows} == {i for i in range(20) if i % 4} and all(r["neighbor_udi"] % 4 for r in rows)


def test_rows_visit_few_cells():
    """Cells a row has to be compared with must not grow with the cells (it did: blocks cut along one axis
    meet a growing share of all blocks)."""
    rng = np.random.default_rng(13)

    def visits(n):
        x = rng.random((n, 4))
        cells = sampling.Cells.build([x[rng.random(n) < 32 / 128]], 32)
        cell = cells.of(np.zeros(n, int), x)
        count = cells.cell.max() + 1
        cells.lo = np.array([x[cell == i].min(axis=0) for i in range(count)])
        cells.hi = np.array([x[cell == i].max(axis=0) for i in range(count)])
        total = 0
        for i in range(count):
            mine = np.flatnonzero(cell == i)
            dist, _ = sampling.nearest(x[mine], mine, x[mine], mine, 5)
            total += len(cells.reached(i, x[mine], dist[:, 4])[0])
        return total / n

    small, large = visits(4_000), visits(32_000)
    assert large < 1.6 * small and large < 16
