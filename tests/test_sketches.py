"""Stored sketches: merged states against exact answers, and what adding a year reads."""

import random

import pytest

from ontime.operators import sketches as K

LAYOUT = "year int, carrier string, x double, code string"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(2000 + i % 3, rng.choice(["A", "B", None]), rng.gauss(0, 10), f"c{rng.randint(0, 700)}") for i in range(9000)]
    data += [(2000, "nan", float("nan"), None), (2001, "none", None, None)]
    return spark.createDataFrame(data, LAYOUT).cache()


def store(tmp_path):
    return K.Store(f"{tmp_path}/store", ["carrier"], ["x"], ["code"])


def pick(rows):
    return lambda years: rows.where(rows["year"].isin(years))


def test_merged_quantiles_stay_within_the_error(spark, rows, tmp_path):
    s = store(tmp_path)
    assert s.add(spark, [2000, 2001, 2002], pick(rows)) == [2000, 2001, 2002]
    found = {r.carrier: r for r in K.quantiles(s.read(spark, rows.schema), ["carrier"], "x", {"median": 0.5, "p99": 0.99}).collect()}
    exact = {}
    for r in rows.collect():
        if r.x is not None and r.x == r.x:
            exact.setdefault(r.carrier, []).append(r.x)
    for carrier, values in exact.items():
        assert found[carrier].n_known == len(values)
        for name, p in (("median", 0.5), ("p99", 0.99)):
            got = found[carrier][name]
            below, upto = sum(v < got for v in values), sum(v <= got for v in values)
            assert below <= (p + 2 * K.rank_error()) * len(values) and upto >= (p - 2 * K.rank_error()) * len(values)
    for carrier in ("nan", "none"):
        assert (found[carrier].n_known, found[carrier].median) == (0, None)


def test_distinct_counts_are_near(spark, rows, tmp_path):
    s = store(tmp_path)
    s.add(spark, [2000, 2001, 2002], pick(rows))
    (r,) = K.distinct(s.read(spark, rows.schema), [], ["code"]).collect()
    exact = rows.select("code").distinct().count() - 1
    assert abs(r.n_distinct - exact) <= 5 * K.distinct_error() * exact


def test_a_later_year_is_read_alone(spark, rows, tmp_path):
    s, asked = store(tmp_path), []

    def read(years):
        asked.append(years)
        return pick(rows)(years)

    assert s.years(spark) == set()
    s.add(spark, [2000, 2001], read)
    s.add(spark, [2000, 2001, 2002], read)
    s.add(spark, [2000, 2001, 2002], read)
    assert asked == [[2000, 2001], [2002]] and s.years(spark) == {2000, 2001, 2002}
    total = s.read(spark, rows.schema).groupBy().sum("n").first()[0]
    assert total == rows.count()


def test_a_later_year_leaves_the_files_of_others(spark, rows, tmp_path):
    """Only the folder of the year asked for is scanned, by the plan."""
    rows.write.partitionBy("year").parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    built = K.states(pick(stored)([2002]), ["year", "carrier"], ["x"], ["code"])
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "2002" in plan


def test_adding_again_replaces(spark, rows, tmp_path):
    s = store(tmp_path)
    s.add(spark, [2000], pick(rows))
    s.add(spark, [2000], pick(rows.where("carrier = 'A'")), again=True)
    assert {r.carrier for r in s.read(spark, rows.schema).collect()} == {"A"}


def test_an_empty_year_is_no_error(spark, rows, tmp_path):
    s = store(tmp_path)
    s.add(spark, [1999], pick(rows))
    assert s.years(spark) == set()
