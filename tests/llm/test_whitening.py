"""Whitening against numpy on whole tables, and exact sums against whole numbers of any size."""

import math

import numpy as np
import pytest

from ontime.llm import whitening
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(vectors, components=32):
    """x, number of vectors, deviations, whitened values and shares, by the definition."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return n, deviation, centred @ q / np.sqrt(e), e / v.trace()


def check(rows, ids, vectors, components=32):
    n, deviation, white, share = plain(vectors, components)
    k = white.shape[1]
    assert len(rows) == len(ids) * k and {r.n for r in rows} == {n}
    got = {(r[0], r.component): r for r in rows}
    signs = np.sign(np.sum([[got[i, c + 1].whitened * w for c, w in enumerate(ws)] for i, ws in zip(ids, white)], axis=0))
    for i, d, ws in zip(ids, deviation, white):
        for c in range(k):
            r = got[i, c + 1]
            assert r.deviation == d
            assert r.whitened * signs[c] == pytest.approx(ws[c], rel=1e-6, abs=1e-8)
            assert r.explained == pytest.approx(share[c], rel=1e-9)
            assert r.identity_error == rows[0].identity_error <= 1e-4


def test_query_on_the_test_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = QUERIES["op13_whiten_polar"](spark, SF).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()
    check(rows, [r.vec_id for r in table], [r.embedding for r in table])


def test_nulls_nan_ragged_repeated_and_extra_columns(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(40, 5)).tolist()
    rows = [*enumerate(good), (100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, [0.5, 2.0]), (105, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS id", "1 AS vector", "2 AS N")
    got = whitening.whiten(df).collect()
    ids = [*range(40), 104, 105]
    check(got, ids, [*good, [0.5, 2.0, 0, 0, 0], [0.0] * 5])
    assert {r.component for r in got} == {1, 2, 3, 4, 5}
    twice = whitening.whiten(df.union(df)).collect()
    assert len(twice) == 2 * len(got) and {r.n for r in twice} == {84}


def test_tables_without_variance_or_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "vec_id long, embedding array<float>")
    assert whitening.whiten(df).count() == 0
    assert whitening.whiten(df.limit(0)).count() == 0
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [3.0, 2.0])], "vec_id long, embedding array<float>")
    rows = whitening.whiten(flat).collect()
    assert {(r.id, r.component) for r in rows} == {(1, 1), (2, 1), (3, 1)} and rows[0].explained == 1.0


def test_entries_beyond_64_bits_in_their_squares(spark):
    rows = [(1, [1e12, 1.0]), (2, [-3e12, 2.0]), (3, [5e11, -7.0]), (4, [2e12, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = whitening.usable(df, "vec_id", "embedding")
    n, sums = whitening.totals(vectors)
    x = [[math.floor(64 * c) for c in v] for _, v in rows]
    assert (n, sums) == (4, [sum(c) for c in zip(*x)])
    centre = [s // n for s in sums]
    y = [[a - c for a, c in zip(row, centre)] for row in x]
    assert whitening.square_sums(vectors, centre) == {(0, 0): sum(a * a for a, _ in y), (1, 1): sum(b * b for _, b in y), (0, 1): sum((a + b) ** 2 for a, b in y)}
    full = [[a + 1_000_000 for a in row] for row in x]
    totals = [sum(c) for c in zip(*full)]
    got = {r.id: int(r.deviation) for r in whitening.whiten(df).collect()}
    assert got == {k + 1: sum((4 * a - s) ** 2 for a, s in zip(row, totals)) for k, row in enumerate(full)}
    # The largest doubles are held at the bound instead of overflowing.
    huge = spark.createDataFrame([(1, [1.7e308]), (2, [-1.7e308])], "vec_id long, embedding array<double>")
    assert {round(abs(r.whitened), 9) for r in whitening.whiten(huge).collect()} == {1.0}


def test_polarisation_equals_products():
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (200, 7))
    n, sums = len(x), x.sum(0).tolist()
    centre, rest = [s // n for s in sums], [s % n for s in sums]
    y = x - np.array(centre)
    squares = {(i, j): int(((y[:, i] + y[:, j]) ** 2).sum()) if i < j else int((y[:, i] ** 2).sum()) for i in range(7) for j in range(i, 7)}
    assert np.abs(whitening.covariance(n, centre, rest, squares) - np.cov(x.T, bias=True)).max() < 1e-12


def test_large_counts_take_the_wide_path():
    w = whitening.Whitening(1 << 40, (0, 0), (5, 7), np.eye(2), np.ones(2))
    y = np.array([[3, -4], [0, 0]])
    assert w.deviations(y) == [sum(((1 << 40) * a - r) ** 2 for a, r in zip(row, (5, 7))) for row in y.tolist()]
