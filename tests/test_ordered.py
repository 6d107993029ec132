"""Running totals, quantiles and AUC against brute force, with ties, nulls and one hot group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.operators import evaluate as E, ordered as O, profile as P

random.seed(7)
# Group "hot" holds most rows; one value holds a third of it.
ROWS = (
    [("hot", float(random.choice([0, 0, 0, random.gauss(0, 50)]))) for _ in range(3000)]
    + [("small", float(i % 5)) for i in range(37)]
    + [("one", 4.0), ("none", None), ("hot", None), (None, 2.0), (None, 8.0)]
)
SCHEMA = "g string, x double"


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(7)


def known(group):
    return [x for g, x in ROWS if g == group and x is not None]


def test_exact_quantiles(data):
    wanted = {"q1": 0.25, "mid": 0.5, "p99": 0.99, "lo": 0.0, "hi": 1.0}
    got = {r.g: r for r in O.grouped_quantiles(data, ["g"], "x", wanted).collect()}
    assert set(got) == {"hot", "small", "one", "none", None}
    for g in ("hot", "small", "one", None):
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(known(g), p)), (g, name)
    assert got["none"]["mid"] is None


def test_approximate_quantiles_are_close_in_rank(data):
    got = {r.g: r.mid for r in O.grouped_quantiles(data, ["g"], "x", {"mid": 0.5}, exact=False).collect()}
    hot = sorted(known("hot"))
    below = sum(v < got["hot"] for v in hot) / len(hot)
    upto = sum(v <= got["hot"] for v in hot) / len(hot)
    assert below - 0.01 <= 0.5 <= upto + 0.01


def test_quantiles_over_several_slices(spark, data):
    counts = data.filter("x is not null").groupBy("g", "x").agg(F.count("*").alias("n"))
    totals = O.running_totals(counts, ["g"], [F.col("x")], ["n"], ranged=5)
    got = {(r.g, r.x): (r.n_before, r.n_total) for r in totals.collect()}
    for g in ("hot", "small", "one", None):
        values = known(g)
        for x in set(values):
            assert got[g, x] == (sum(v < x for v in values), len(values))


def test_no_slice_holds_the_hot_group(spark, data):
    counts = data.filter("x is not null").groupBy("g", "x").agg(F.count("*").alias("n"))
    sizes = counts.repartitionByRange(5, "g", "x").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 0.5 * counts.count()


def test_positions(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 9), ("a", 2)], "g string, n int")
    got = {(r.g, r.n): r.position for r in O.positions(df, ["g"], [F.desc("n")]).collect()}
    assert got == {("a", 3): 0, ("a", 2): 1, ("a", 1): 2, ("b", 9): 0}


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc(spark):
    pairs = [(int(random.random() < 0.3), float(random.randint(0, 9))) for _ in range(300)]
    row = E.auc(spark.createDataFrame(pairs, "y int, s double"), "y", "s").first()
    assert row.auc == pytest.approx(brute_auc(pairs))
    assert row.n_positive + row.n_negative == 300


def test_auc_same_as_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    pairs = [(float(random.random() < 0.4), random.random()) for _ in range(500)]
    df = spark.createDataFrame(pairs, "y double, s double")
    ml = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(df)
    assert E.auc(df, "y", "s").first().auc == pytest.approx(ml)


def test_auc_of_one_class_is_null(spark):
    assert E.auc(spark.createDataFrame([(1, 0.5), (1, 0.6)], "y int, s double"), "y", "s").first().auc is None


def test_box_stats(data):
    got = {r.g: r for r in P.box_stats(data, "g", "x").collect()}
    x = np.array(known("hot"))
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert got["hot"].n_outliers == len(x) - len(inside)
    assert (got["hot"].whisker_low, got["hot"].whisker_high) == (inside.min(), inside.max())
    assert got["none"].n_known == 0 and got["none"].median is None


def test_delay_by_keeps_groups_without_values(data):
    rows = P.delay_by(data, "g", "x", exact=True).collect()
    got = {r.g: r for r in rows}
    assert got["none"].flight_count == 1 and got["none"].avg_delay is None
    assert got["hot"].flight_count == 3001
    assert got["hot"].avg_delay == pytest.approx(np.mean(known("hot")))
    approx = {r.g: r.flight_count for r in P.delay_by(data, "g", "x").collect()}
    assert approx == {g: r.flight_count for g, r in got.items()}


def test_rows_are_shuffled_once(spark):
    """By range, when the slices are made; afterwards only the small totals move."""
    from pyspark.sql import functions as F

    from ontime.operators.ordered import running_totals

    df = spark.range(3000).select((F.col("id") % 3).alias("g"), "id", F.lit(1).alias("n"))
    out = running_totals(df, ["g"], [F.col("id")], ["n"], 5)
    assert sorted((r.id, r.n_before, r.n_total) for r in out.collect()) == [(i, i // 3, 1000) for i in range(3000)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and plan.count("Relation [") == 2
    # Only the totals are exchanged: they are broadcast to the slices, whose scan has no exchange above it.
    rows, totals = out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange", 1)
    assert "BroadcastHashJoin" in rows and "hashpartitioning" not in rows and "hashpartitioning" in totals
    assert "_id_inner" not in totals and totals.count("FileScan") >= 1


def test_totals_leave_with_the_slices_in_one_job(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id", F.lit(1).alias("n"))
    spark.sparkContext.setJobGroup("ordered", "one write")
    O.running_totals(df, ["g"], [F.col("id")], ["n"], 4)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("ordered")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One samples the range bounds, one writes.
    assert len(jobs) <= 3


def test_a_group_named_nan_is_one_group_over_batches(spark):
    """Rows of one group that come in several Arrow batches go on counting, also where the key is NaN or a negative zero."""
    from ontime.session import settings

    n = 500
    rows = [(key, i) for key in (float("nan"), 0.0, 1.5, None) for i in range(n)] + [(-0.0, n + i) for i in range(n)]
    df = spark.createDataFrame(rows, "g double, i int")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "64"}):
        ranked = O.positions(df, ["g"], [F.col("i")], 2)
        got = {("nan" if r.g != r.g else r.g, r.i): r.position for r in ranked.collect()}
    assert len(got) == 5 * n
    for (g, i), position in got.items():
        assert position == i, (g, i)
