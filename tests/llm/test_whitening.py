import random

import numpy as np
import pytest

from tallyweave.llm import qd, whitening


def restated(rows, components):
    """x of the rows that count, the distinct ones' covariance, and its eigenvectors by another solver."""
    x = {i: tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) for i, v in rows}
    fit = np.array(sorted(set(x.values())), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = np.array([[float(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, r in x.items():
        off = [int(n * a - s) for a, s in zip(r, sums, strict=True)]
        out[i] = (n, sum(o * o for o in off), (np.array(off, float) / n) @ vectors / np.sqrt(values))
    return out, values / np.trace(centred.T @ centred / n)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<float>, x string, part string, n int").repartition(5)


def test_equals_another_solver(spark):
    r = random.Random(3)
    scales = [2 ** (-i / 3) for i in range(20)]
    rows = [(i, [r.gauss(0, 1) * s for s in scales]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # one vector many times
    odd = [(2000, None), (2001, []), (2002, [None] + [1.0] * 19), (2003, [float("nan")] * 20), (2004, [float("inf")] * 20), (2005, [1.0, 2.0]), (2006, [1e30] * 20)]
    got = whitening.whiten(table(spark, rows + odd), 16).toPandas()
    want, explained = restated(rows, 16)
    assert len(got) == 16 * len(rows) and set(got["vec_id"]) == set(want)
    for c, part in got.groupby("component"):
        assert part["explained"].iloc[0] == pytest.approx(explained[c - 1], rel=1e-9)
        theirs = np.array([want[i][2][c - 1] for i in part["vec_id"]])
        ours = part["whitened"].to_numpy()
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8
        assert [(n, d) for n, d in zip(part["n"], part["deviation"], strict=True)] == [want[i][:2] for i in part["vec_id"]]
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_repeated_and_missing_ids_and_directions_without_variance(spark):
    rows = [(1, [0.0, 1.0, 5.0]), (1, [1.0, 1.0, 5.0]), (None, [3.0, 1.0, 5.0]), (None, [3.0, 1.0, 5.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 4 and {g["component"] for g in got} == {1} and {g["n"] for g in got} == {3}
    assert sorted(round(abs(g["whitened"]), 6) for g in got if g["vec_id"] is None) == [1.336306] * 2


def test_nothing_to_fit(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_a_deviation_beyond_64_bits_is_null(spark):
    got = whitening.whiten(table(spark, [(1, [1e10, 0.0]), (2, [0.0, 0.0])])).collect()
    assert {g["deviation"] for g in got} == {None} and all(abs(abs(g["whitened"]) - 1) < 1e-9 for g in got)


def test_triangles_meet_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    monkeypatch.setattr(whitening.durable, "rewritten", lambda df, name: df.repartition(7))
    got = whitening.whiten(table(spark, rows)).toPandas()
    assert got["identity_error"].iloc[0] < 1e-12 and len(got) == 240


@pytest.mark.parametrize("kind", ["random", "graded", "deficient", "cluster", "tight", "eye", "diagonal"])
def test_solver(kind):
    r = np.random.default_rng(0)
    turn = lambda: np.linalg.qr(r.normal(size=(40, 40)))[0]
    m = {
        "random": r.normal(size=(40, 40)), "graded": r.normal(size=(40, 40)) * np.logspace(0, -8, 40), "deficient": r.normal(size=(40, 30)) @ r.normal(size=(30, 40)),
        "cluster": turn() * np.r_[[5.0] * 8, [5 * (1 + 1e-9)] * 4, [1] * 28] @ turn(), "tight": turn() * np.linspace(1, 1 + 1e-6, 40) @ turn(), "eye": np.eye(40), "diagonal": np.diag(np.arange(1.0, 41)),
    }[kind]
    a, b, v = qd.bidiagonal(m)
    found = qd.squares(a, b)
    true = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.abs(np.sqrt(found) - np.sqrt(true)).max() < 1e-13 * np.sqrt(true[0])
    z = v @ qd.right_vectors(a, b, found, 16)
    assert np.abs(z.T @ z - np.eye(16)).max() < 1e-9
    assert np.abs(m.T @ (m @ z) - z * found[:16]).max() < 1e-12 * found[0]
