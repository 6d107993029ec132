"""Near-duplicate vectors against all pairs, with the recall that the calibration promises."""

import math

import numpy as np
import pytest

from ontime.llm import neardup
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(rows, cosine=0.98):
    """rows: (id, vector, label). Links counted over all pairs of rows, and components."""
    ok = [label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (_, u, la) in enumerate(rows):
        for b in range(a):
            _, v, lb = rows[b]
            if ok[a] and ok[b] and la == lb and len(u) == len(v):
                x, y = np.array(u, float), np.array(v, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for a, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return [(i, links[a], least.get(find(a))) for a, (i, _, _) in enumerate(rows)]


def listed(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query_on_the_test_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op5_collision_counting"](spark, SF).collect()
    assert listed((r.vec_id, r.n_links, r.component_id) for r in got) == listed(plain(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_near_the_limit(spark, monkeypatch):
    """Pairs just above the limit, in groups large enough for several lines per bucket and for tiles."""
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 20)
    monkeypatch.setattr(neardup, "TILE_ROWS", 50)
    rng = np.random.default_rng(3)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    base = unit(rng.standard_normal((1500, 64)))
    turn = rng.standard_normal((1500, 64))
    turn = unit(turn - (turn * base).sum(1, keepdims=True) * base)
    cos = 0.9805
    near = base * cos + turn * math.sqrt(1 - cos**2)
    hub = unit(base[:1] + 0.012 * rng.standard_normal((300, 64)))
    every = np.concatenate((base, near, hub)).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(every)]
    got = {r.id: r.n_links for r in neardup.classes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    whole = unit(every.astype(np.float64))
    true = (whole @ whole.T >= 0.98).sum(1) - 1
    assert all(got[i] <= true[i] for i in got)
    assert sum(got.values()) >= 0.995 * true.sum() and true.sum() > 3000
    assert sum(got[i] for i in range(1, 1500)) >= 0.995 * true[1:1500].sum()


def test_calibration():
    hits = (np.abs(np.random.default_rng(2).standard_normal((200_000, 32))) <= 2).sum(1)
    count = neardup.least_count(32, 2.0, 0.9995)
    assert (hits >= count).mean() > 0.9993 and (hits >= count + 1).mean() < 0.9997
    for depth in (1, 3, 8):
        assert 1 - (1 - neardup.cell_chance(neardup.CELL) ** depth) ** neardup.tables_for(depth) >= neardup.PASS


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.0], "a"), (2, [2.0, 0.0], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.0], None), (5, None, "a"), (6, [0.0, 0.0], "a"), (7, [nan, 1.0], "a"), (8, [1.0, None], "a"), (9, [], "a"), (10, [1.0, 0.0, 0.0], "a"), (None, [1.0, 0.0], "a"), (11, [inf, 1.0], "a"), (0, [1e-300, 1e-302], "a"), (12, [1e300, -1e300], "b"), (13, [1.0, -1.0], "b"), (14, [1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").selectExpr("*", "1 AS node", "2 AS kind", "'x' AS id", "3 AS times")
    assert listed(neardup.classes(df).collect()) == listed(plain(rows))
    assert neardup.classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("across", [False, True])
def test_pairs_that_pass_the_count(across):
    rng = np.random.default_rng(1)
    values = rng.standard_normal((200, 8))
    side = (rng.random(200) < 0.5).astype(int) if across else np.zeros(200, int)
    i, j = neardup._passing(values, side, 0.8, 1.6, 5)
    want = {(a, b) for a in range(200) for b in range(a) if abs(values[a, 0] - values[b, 0]) <= 1.6 and (np.abs(values[a] - values[b]) <= 0.8).sum() >= 5 and (not across or side[a] != side[b])}
    assert {(max(a, b), min(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)
