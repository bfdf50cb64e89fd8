"""Whitening against numpy's own eigenvectors and exact integers."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from marquee.llm import whitening
from marquee.llm.registry import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=4):
    x = {i: tuple(math.floor(256 * float(np.float32(c))) for c in v) for i, v in rows
         if v is not None and all(c is not None and math.isfinite(c) and abs(c) < 2.0 ** 54 for c in v)
         and len(v) == len(rows[0][1])}
    listed = np.array(sorted(set(x.values())))
    n, s = len(listed), [int(t) for t in listed.sum(axis=0)]
    y = listed - np.array(s) / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return {i: (n, sum((n * a - b) ** 2 for a, b in zip(v, s)), (np.array(v) - np.array(s) / n) @ u / np.sqrt(e),
                e / cov.trace()) for i, v in x.items()}


def compare(got, want):
    assert {(r.vec_id, r.component) for r in got} == {(i, k) for i in want for k in range(1, 5)}
    sign = {k: 0 for k in range(1, 5)}
    for r in got:
        n, deviation, w, explained = want[r.vec_id]
        k = r.component - 1
        assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
        assert abs(r.explained - explained[k]) < 1e-9
        if not sign[r.component] and abs(w[k]) > 1e-3:
            sign[r.component] = math.copysign(1, r.whitened * w[k])
        assert abs(r.whitened - (sign[r.component] or 1) * w[k]) < 1e-7


def test_query_on_the_table(spark):
    t = pq.read_table("/root/testdata/sf0.01/embeddings.parquet")
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    compare(QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.01").collect(), brute(rows))


def test_edge_rows(spark):
    """A mean far from zero, copies as a third of all rows, dropped rows, a null id and clashing names."""
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(6, 6))
    rows = [(i, (rng.normal(size=6) @ mix + 5000).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]
    bad = [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6),
           (2004, [1.0]), (2005, []), (2006, [3e38] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], SCHEMA).selectExpr(
        "*", "1 as component", "2 as x", "3 as n", "4 as _c0").repartition(7)
    compare(whitening.whiten(df, ["vec_id"]).collect(), brute(rows))
    assert len(whitening.whiten(spark.createDataFrame([(None, v, 1) for _, v in rows], SCHEMA), ["vec_id"]).collect()) == 1800


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5, 1.0], 1)] * 3, [(1, [], 1)]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), ["vec_id"])
    assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                                   "identity_error"]


def test_lower_rank_gives_fewer_components(spark):
    rows = [(i, [i / 256, 2 * i / 256, 1.0, 0.0, -i / 256], 1) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), ["vec_id"]).collect()
    assert len(got) == 50 and all(r.component == 1 and abs(r.explained - 1) < 1e-12 for r in got)


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (5, 5), (40, 40), (40, 11)):
        a = rng.normal(size=(d, rank)) * np.logspace(0, -5, rank)
        a = a @ a.T
        factor, order = whitening.pivoted_cholesky(a)
        assert np.allclose(factor @ factor.T, a[order][:, order], atol=1e-13)
        assert np.allclose(factor, np.tril(factor))
        values, vectors = whitening.eigen(a, 1)
        assert factor.shape[1] <= rank and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-11)
        want = np.linalg.eigvalsh(a)[::-1][:len(values)]
        assert np.abs(values - want).max() < 1e-13 * want[0]
        assert np.allclose(a @ vectors, vectors * values, atol=1e-13 * d)
    pairs = {frozenset(p) for i, j in whitening.rounds(7) for p in zip(i.tolist(), j.tolist())}
    assert len(pairs) == 21


def test_exact_beyond_a_long():
    centre = whitening.Centre(3, [1 << 61, 5, -7])
    x = np.array([[1 << 60, 2, 3], [0, 0, 0]])
    want = [sum((3 * int(a) - b) ** 2 for a, b in zip(v, centre.sums)) for v in x]
    assert centre.deviation(x) == [t if t < 1 << 63 else None for t in want] == [None, None]
    centre = whitening.Centre(10 ** 6, [10 ** 6 * (1 << 40) - 5, 5, -7])
    x = np.array([[1 << 40, 2, 3]])
    assert centre.deviation(x) == [sum((10 ** 6 * int(a) - b) ** 2 for a, b in zip(x[0], centre.sums))]
