"""Bucketed tables, Parquet footers and exact splits: what their plans move and read."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F, types as T

from ontime.operators import sample as S
from ontime.sources import bucketed, footers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_join_of_bucketed_tables_moves_nothing(spark):
    left = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("a"))
    right = spark.range(100, 700).select(F.col("id").cast("string").alias("k"), (F.col("id") * 3).alias("b"))
    tables = [bucketed.write_bucketed(t, ["k"], 4) for t in (left, right)]
    joined = bucketed.join_bucketed(spark, *tables, ["k"])
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert sorted((r.k, r.a, r.b) for r in joined.collect()) == sorted((str(i), 2 * i, 3 * i) for i in range(100, 500))
    outer = bucketed.join_bucketed(spark, *tables, ["k"], "full_outer")
    assert outer.count() == 700 and "Exchange" not in plan_of(outer.drop("a"))
    for t in tables:
        assert len(spark.table(t).inputFiles()) <= 4
        spark.sql(f"DROP TABLE {t}")


LAYOUT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("s", T.StringType()), T.StructField("year", T.IntegerType())])


def test_footers_answer_without_reading_columns(spark, tmp_path):
    rows = [(float(i) - 3, i * 10 if i % 3 else None, None if i % 2 else "a", 2000 + i % 2) for i in range(20)]
    spark.createDataFrame(rows, LAYOUT).write.partitionBy("year").parquet(f"{tmp_path}/t")
    got = {(r.year, r.column): tuple(r)[2:] for r in footers.footer_report(spark, f"{tmp_path}/t", LAYOUT, ["year"]).collect()}
    for year in (2000, 2001):
        mine = [r for r in rows if r[3] == year]
        xs, ns = [r[0] for r in mine], [r[1] for r in mine if r[1] is not None]
        assert got[year, "x"] == (len(mine), len(xs), min(xs), max(xs))
        assert got[year, "n"] == (len(mine), len(ns), min(ns), max(ns))
        assert got[year, "s"] == (len(mine), sum(r[2] is not None for r in mine), None, None)
    with footers.settings(spark, footers._FOOTERS):
        plan = plan_of(footers.footer_aggregate(spark, f"{tmp_path}/t", LAYOUT, ["year"]))
    assert "PushedAggregation: [COUNT(*)" in plan and "PushedGroupBy: [year]" in plan
    whole = footers.footer_report(spark, f"{tmp_path}/t", LAYOUT).where("column = 'x'").first()
    assert tuple(whole) == ("x", 20, 20, -3.0, 16.0)


def test_a_least_zero_is_positive(spark, tmp_path):
    spark.createDataFrame([(0.0,), (1.0,)], "x double").write.parquet(f"{tmp_path}/t")
    (r,) = footers.footer_report(spark, f"{tmp_path}/t", T.StructType([T.StructField("x", T.DoubleType())])).collect()
    assert math.copysign(1, r.min) == 1 and (r.min, r.max) == (0.0, 1.0)


def test_exact_split_of_every_class(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 50 + ["rare"])) for i in range(4000)] + [(5000 + i, None) for i in range(7)]
    df = spark.createDataFrame(rows, "k long, c string")
    for share in (0.8, 0.29, 0.0, 1.0):
        parts = S.exact_split(df, share, S.bucket_of(["k"], 42), "c", ["k"])
        assert parts.columns == ["k", "c", "part"]
        got, sizes = Counter((r.c, r.part) for r in parts.collect()), Counter(c for _, c in rows)
        for c, n in sizes.items():
            assert got[c, "train"] == math.floor(round(share * n * 100) / 100) and got[c, "train"] + got[c, "test"] == n


def test_exact_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    first, again = (S.exact_split(d, 0.5, S.bucket_of(["k"], 1), "c", ["k"]) for d in (df, df.repartition(7)))
    assert first.exceptAll(again).isEmpty()


def test_a_hot_class_spreads_over_tasks(spark):
    from ontime.operators import ordered

    df = spark.range(20_000).select(F.col("id").alias("k"), F.lit("hot").alias("c"), F.lit(1).alias("one"))
    ranked = ordered.running_totals(df, ["c"], [F.xxhash64("k"), F.col("k")], ["one"], 8)
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 10_000
