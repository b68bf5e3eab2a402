"""Eigenpairs and whitening against numpy's own decomposition."""

import math

import duckdb
import numpy as np
import pytest

from tallybook.llm import queries
from tallybook.llm.eigen import leading_pairs, leading_values, sturm_count, tridiagonal
from tallybook.llm.whitening import Whitening, whitening_report

RNG = np.random.default_rng(5)


def symmetric(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values, float)) @ q.T


MATRICES = {
    "one": np.array([[3.0]]),
    "two": np.array([[2.0, 1.0], [1.0, 2.0]]),
    "apart": symmetric([9, 7, 5, 3, 1, 0.5]),
    "equal": symmetric([5, 5, 5, 5, 1, 1, 1]),
    "close": symmetric([5, 5 - 1e-13, 5 - 1e-12, 4.999999, 1, 0]),
    "identity": np.eye(9),
    "diagonal": np.diag([1.0, 4.0, 2.0, 3.0]),
    "ones": np.ones((6, 6)),
    "zero": np.zeros((4, 4)),
    "wide": symmetric(np.linspace(1, 2, 150)),
    "large": 1e180 * symmetric([4, 3, 2, 1, 0.1]),
    "small": 1e-180 * symmetric([4, 3, 2, 1, 0.1]),
    "spread": symmetric([1e9, 1.0, 1e-2, 0, 0, 0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_pairs(name):
    matrix = MATRICES[name]
    wanted = np.linalg.eigvalsh(matrix)[::-1][:4]
    values, basis = leading_pairs(matrix, 4)
    size = np.abs(matrix).max()
    rank = int((wanted > 1e-12 * size * len(matrix)).sum())
    assert len(values) == rank == basis.shape[1]
    if rank:
        assert np.allclose(values, wanted[:rank], rtol=1e-13, atol=1e-14 * size * len(matrix))
        assert np.abs(matrix @ basis - basis * values).max() < 1e-13 * size * len(matrix)
        assert np.abs(basis.T @ basis - np.eye(rank)).max() < 1e-13


def test_tridiagonal_keeps_eigenvalues_and_sturm_counts_them():
    matrix = symmetric(RNG.uniform(-3, 3, 20))
    diagonal, off, reflectors = tridiagonal(matrix)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    wanted = np.linalg.eigvalsh(matrix)
    assert np.allclose(np.linalg.eigvalsh(t), wanted)
    assert len(reflectors) == 18
    at = np.linspace(-4, 4, 33)
    assert sturm_count(diagonal, off, at).tolist() == [int((wanted < x).sum()) for x in at]
    assert np.allclose(leading_values(diagonal, off, 20), wanted[::-1], atol=1e-13)


def check(found, rows, components=4):
    """``found`` is the report on ``rows`` (key, vector)."""
    x = {k: [math.floor(256 * c) for c in v] for k, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), float)
    n, sums = len(fit), [sum(int(c) for c in column) for column in fit.T]
    centred = fit - fit.mean(0)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    components = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(found) == len(rows) * components
    signs = {}
    for r in found:
        k, c = r["vec_id"], r["component"] - 1
        assert r["n"] == n
        assert r["deviation"] == sum((n * v - s) ** 2 for v, s in zip(x[k], sums))
        assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
        wanted = (np.array(x[k]) - fit.mean(0)) @ basis[:, c] / math.sqrt(values[c])
        assert abs(r["whitened"]) == pytest.approx(abs(wanted), abs=1e-8)
        if abs(wanted) > 1e-6:
            signs.setdefault(c, set()).add(np.sign(r["whitened"] * wanted))
    assert all(len(s) == 1 for s in signs.values())


def test_report_over_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet'").fetchall()
    check(queries.op12_whitening(spark, sf_dir).collect(), rows)


SCHEMA = "vec_id long, embedding array<double>, x string, component int"


def test_report_of_odd_rows(spark):
    usable = [(k, RNG.normal(0, 1, 6).tolist()) for k in range(40)]
    usable.append((40, usable[0][1]))
    odd = [None, [1.0] * 5 + [None], [math.nan] * 6, [math.inf] + [0.0] * 5, [-math.inf] * 6, [1e300] * 6]
    rows = usable + [(100 + i, v) for i, v in enumerate(odd)]
    table = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], SCHEMA).repartition(5)
    check(whitening_report(table).collect(), usable)
    # a repeated row weighs once, a missing key stays
    more = table.unionByName(table.where("vec_id < 5")).unionByName(
        spark.createDataFrame([(None, usable[3][1], "x", 1)], SCHEMA)
    )
    found = whitening_report(more).collect()
    assert len(found) == (41 + 5 + 1) * 4
    assert {r["n"] for r in found} == {40}
    # another length has no value
    other = table.unionByName(spark.createDataFrame([(7, [1.0], "x", 1), (8, [], "x", 1)], SCHEMA))
    found = whitening_report(other).collect()
    assert len(found) == (41 + 2) * 4
    assert sum(r["whitened"] is None for r in found) == sum(r["deviation"] is None for r in found) == 8


def test_low_rank_and_empty(spark):
    def report(*vectors):
        rows = [(k, v, "x", 1) for k, v in enumerate(vectors)]
        return whitening_report(spark.createDataFrame(rows, SCHEMA)).collect()

    assert report() == report(None) == report([1.0, 2.0], [1.0, 2.0]) == report([]) == []
    line = report([0.0, 0.0, 1.0], [1.0, 1.0, 1.0], [2.0, 2.0, 1.0])
    assert {r["component"] for r in line} == {1}
    assert sorted(abs(r["whitened"]) for r in line) == pytest.approx([0, math.sqrt(1.5), math.sqrt(1.5)], abs=1e-9)


def test_deviation_beyond_a_long_is_null():
    model = Whitening(10**9, [0, 0], np.ones(1), np.ones((2, 1)), 1.0)
    assert model.deviations(np.array([[1, 2], [10**6, 0]])) == [5 * 10**18, None]
