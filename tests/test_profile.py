import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from ontime.operators import profile as P, relate as R, sample as S

NAN = float("nan")


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, float(i % 10) if i % 4 else None, 500.0, "ab"[i % 2] if i % 5 else None, bool(i % 3)) for i in range(100)]
    return spark.createDataFrame(rows, "id long, x double, same double, t string, b boolean")


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (None, "NaN")], "x double, t string")
    assert {r.column: r.n_missing for r in P.null_profile(df).collect()} == {"x": 2, "t": 1}


def test_null_profile_order(table):
    got = P.null_profile(table).collect()
    assert [(r.column, r.n_missing) for r in got] == [("x", 25), ("t", 20)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, t string")
    assert P.null_profile(df).count() == 0
    assert P.histograms(df).count() == 0
    assert P.top_values(df).count() == 0
    assert {r.column: r.n for r in P.describe_table(df).collect()}["t"] == 0


def test_frequencies_add_up(table):
    counts = P.frequencies(table, ["t", "b"])
    assert {r.column: r.n for r in counts.groupBy("column").agg(F.sum("n").alias("n")).collect()} == {"t": 100, "b": 100}


def test_top_values_ties_and_share(spark):
    df = spark.createDataFrame([(v,) for v in "aabbccd"], "t string")
    got = P.top_values(df, ["t"], 2).orderBy("rank").collect()
    assert [(r.value, r.n) for r in got] == [("a", 2), ("b", 2)]
    assert got[0].covered_pct == pytest.approx(400 / 7)


def test_top_values_limits_before_the_shuffle(table):
    plan = P.top_values(table, ["t"], 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_histogram_counts_and_constant_column(table):
    got = P.histograms(table, ["x", "same"], 30).collect()
    assert sum(r.n for r in got if r.column == "x") == 75
    assert [(r.bin, r.n) for r in got if r.column == "same"] == [(0, 100)]
    x = np.array([r.x for r in table.collect() if r.x is not None])
    expected, _ = np.histogram(x, bins=30)
    counts = [0] * 30
    for r in got:
        if r.column == "x":
            counts[r.bin] = r.n
    assert counts == list(expected)


def test_distinct_counts(table):
    exact = {r.column: r.n_distinct for r in P.distinct_counts(table, [], ["t", "id"]).collect()}
    assert exact == {"t": 2, "id": 100}
    rough = {r.column: r.n_distinct for r in P.distinct_counts(table, [], ["t", "id"], approximate=True).collect()}
    assert rough["t"] == 2 and abs(rough["id"] - 100) <= 10


def test_describe_types(table):
    got = {r.column: r for r in P.describe_table(table).collect()}
    assert got["x"].min == 0.0 and got["x"].n == 75 and got["x"].min_text is None
    assert (got["t"].min_text, got["t"].max_text, got["t"].mean) == ("a", "b", None)


def test_drift_counts_rejected_text(spark):
    rows = [("2009", "NA", "2009-01-01"), ("2009", "x", "2009-13-01"), ("2010", "1.5", " "), ("2010", "NaN", None)]
    df = spark.createDataFrame(rows, "y string, v string, d string")
    kinds = T.StructType([T.StructField("v", T.DoubleType()), T.StructField("d", T.DateType())])
    got = {(r.y, r.column): (r.n_present, r.n_missing, r.n_rejected) for r in P.schema_drift(df, ["y"], kinds).collect()}
    assert got == {
        ("2009", "v"): (1, 1, 1), ("2009", "d"): (2, 0, 1), ("2010", "v"): (1, 1, 0), ("2010", "d"): (0, 2, 0),
    }


def test_compare_schemas(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([(1, 2.0)], "n long, u double")
    got = {r.column: r.asDict() for r in P.compare_schemas({"2009": a, "2010": b}).collect()}
    assert got["n"] == {"column": "n", "2009": "int", "2010": "bigint", "mismatch": True}
    assert got["t"]["2010"] is None and got["t"]["mismatch"]


@pytest.mark.parametrize("rule", ["zero", "pairwise"])
def test_correlations(table, rule):
    got = {(r.col_x, r.col_y): r["corr"] for r in R.correlations(table, ["id", "x"], rule).collect()}
    pairs = [(r.id, r.x) for r in table.collect()]
    pairs = [(i, x or 0.0) for i, x in pairs] if rule == "zero" else [p for p in pairs if p[1] is not None]
    assert got["id", "x"] == pytest.approx(np.corrcoef(np.array(pairs).T)[0, 1])
    assert got["x", "id"] == pytest.approx(got["id", "x"]) and got["x", "x"] == pytest.approx(1)


@pytest.mark.parametrize("rule", ["zero", "pairwise"])
def test_correlation_with_a_constant_is_null(table, rule):
    got = {(r.col_x, r.col_y): r["corr"] for r in R.correlations(table, ["id", "same"], rule).collect()}
    assert got["id", "same"] is None


def test_strongest_lists_each_pair_once(table):
    got = R.strongest(R.correlations(table, ["id", "x", "same"], "pairwise"), 10).collect()
    assert [(r.col_x, r.col_y) for r in got] == [("id", "x")]


def test_pair_fit_of_constant_is_null(table):
    r = R.pair_fits(table, [("same", "x")]).first()
    assert (r.n, r.slope, r["corr"]) == (75, None, None)


def test_pair_density_counts_known_pairs(table):
    assert R.pair_density(table, "id", "x").agg(F.sum("n")).first()[0] == 75


def test_sample_and_split_ignore_partitioning(spark):
    df = spark.range(20000)
    for bucket in (S.bucket_of(["id"], 42), S.fast_bucket_of(["id"], 42)):
        a = {r.id for r in S.sample(df.repartition(3), 0.08, bucket).collect()}
        assert a == {r.id for r in S.sample(df.repartition(11), 0.08, bucket).collect()}
        assert 1300 < len(a) < 1900
        train, test = S.split(df, 0.8, bucket)
        assert train.count() + test.count() == 20000
        assert train.intersect(test).count() == 0
    assert {r.id for r in S.sample(df, 0.08, S.bucket_of(["id"], 43)).collect()} != a


def test_text_totals_do_not_sort(table):
    plan = P.describe_table(table)._jdf.queryExecution().toString()
    assert "SortAggregate(key=[_at" not in plan


def test_nan_counts_as_missing_everywhere(spark):
    rows = [("a", x, 2 * x) for x in (1.0, 2.0, 3.0, 4.0)]
    clean = spark.createDataFrame(rows, "g string, x double, y double")
    dirty = spark.createDataFrame(rows + [("a", NAN, NAN), ("a", None, NAN)], "g string, x double, y double")
    for fn in (
        lambda d: P.histograms(d, ["x"], 4),
        lambda d: P.numeric_stats(d, ["g"], ["x", "y"]),
        lambda d: P.box_stats(d, "g", "x"),
        lambda d: P.mean_by(d, "g", "x"),
        lambda d: P.delay_by(d, "g", "x", exact=True).drop("flight_count"),
        lambda d: P.delay_by(d, "g", "x").drop("flight_count"),
        lambda d: P.describe_table(d).filter("column <> 'g'"),
        lambda d: R.correlations(d, ["x", "y"], "pairwise"),
        lambda d: R.pair_density(d, "x", "y", 2),
        lambda d: R.pair_fits(d, [("x", "y")]),
    ):
        assert sorted(fn(dirty).collect()) == sorted(fn(clean).collect())
    zeros = clean.union(spark.createDataFrame([("a", 0.0, 0.0)] * 2, clean.schema))
    assert sorted(R.correlations(dirty, ["x", "y"]).collect()) == sorted(R.correlations(zeros, ["x", "y"]).collect())


def test_exact_types(spark):
    from decimal import Decimal

    big = 2**53
    df = spark.createDataFrame([(Decimal("9.50"), 9, big), (Decimal("10.00"), 10, big + 1)], "d decimal(9,2), s short, b long")
    got = {r.column: r for r in P.describe_table(df).collect()}
    assert (got["d"].min, got["d"].max, got["d"].mean, got["d"].min_text, got["d"].max_text) == (9.5, 10.0, 9.75, "9.50", "10.00")
    assert (got["s"].min, got["s"].max, got["s"].min_text) == (9.0, 10.0, "9")
    assert (got["b"].min_text, got["b"].max_text) == (str(big), str(big + 1))
    from ontime.operators.ordered import value_ranks

    assert value_ranks(df.selectExpr("1 AS g", "b"), ["g"], "b").count() == 2


def test_nan_is_no_value_in_counts_and_filters(spark):
    from ontime.operators.clean import filter_known

    df = spark.createDataFrame([(1, 1.0), (1, NAN), (1, None), (1, 2.0)], "g int, x double")
    assert [r.n_distinct for r in P.distinct_counts(df, ["g"], ["x"]).collect()] == [2]
    assert [r.n_distinct for r in P.distinct_counts(df, ["g"], ["x"], approximate=True).collect()] == [2]
    assert filter_known(df, "x").count() == 2
    assert sorted((r.x, r.n) for r in P.known_counts(df, "g", "x").collect()) == [(1.0, 1), (2.0, 1)]
    assert {r.x: r.n for r in P.share(df, "g", "x").collect()} == {1.0: 1, 2.0: 1, None: 2}


def test_year_report_takes_two_scans(spark):
    from ontime.plans.flights import flights

    df = flights(spark, "/root/testdata/sf0.001", ["year"])
    assert P.year_report(df)._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


@pytest.mark.parametrize("rule", ["zero", "pairwise"])
@pytest.mark.parametrize("tile", [1, 2, 5])
def test_tiles_give_the_same_matrix(table, rule, tile):
    columns = ["id", "x", "same"]
    plain = {(r.col_x, r.col_y): r["corr"] for r in R.correlations(table, columns, rule).collect()}
    tiled = {(r.col_x, r.col_y): r["corr"] for r in R.correlations_tiled(table, columns, rule, tile).collect()}
    assert set(plain) == set(tiled) and len(tiled) == 9
    for pair, corr in plain.items():
        assert tiled[pair] == (corr if corr is None else pytest.approx(corr))


def test_tiles_bound_what_leaves_a_task_at_a_time(spark, monkeypatch):
    """Large values with small differences, several chunks, and partial sums of one pair of blocks in each batch."""
    rng = np.random.default_rng(2)
    data = rng.normal(size=(500, 7)) + 1e6
    data[:, 1] = data[:, 0] * 2
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"k{i} double" for i in range(7))).repartition(3)
    monkeypatch.setattr(R, "_CHUNK", 64)
    got = {(r.col_x, r.col_y): r["corr"] for r in R.correlations_tiled(df, tile=3).collect()}
    want = np.corrcoef(data.T)
    for i in range(7):
        for j in range(7):
            assert got[f"k{i}", f"k{j}"] == pytest.approx(want[i, j], abs=1e-7)
