from pyspark.sql import functions as F

from ontime.operators import clean as C, profile as P
from ontime.schema import CLEAN, CLEAN_NAMES, RAW, RAW_NAMES, ZERO_FILLED

NAN = float("nan")


def raw(spark, *rows):
    base = dict.fromkeys(RAW_NAMES) | {
        "FL_DATE": "2009-01-05", "OP_CARRIER": "AA", "ORIGIN": "JFK", "DEST": "LAX", "CRS_DEP_TIME": 900.0,
        "CANCELLED": 0.0, "DIVERTED": 0.0, "DISTANCE": 500.0,
    }
    return spark.createDataFrame([tuple((base | r)[c] for c in RAW_NAMES) for r in rows], RAW)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_layout(spark):
    cleaned = C.clean(raw(spark, {}))
    assert cleaned.columns == CLEAN_NAMES
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in CLEAN]


def test_date_parts_and_bad_date(spark):
    r = one(C.clean(raw(spark, {})))
    assert (r.year, r.month, r.day_of_week) == (2009, 1, "Monday")
    for bad in ("2009-13-01", "2009", "2009-01-05T10", "soon", None):
        r = one(C.clean(raw(spark, {"FL_DATE": bad})))
        assert (r.year, r.month, r.day_of_week) == (None, None, None), bad


def test_dates_that_are_not_text(spark):
    df = raw(spark, {}).withColumn("FL_DATE", F.col("FL_DATE").cast("date"))
    assert one(C.clean(df)).day_of_week == "Monday"


def test_nan_and_negative_causes(spark):
    r = one(C.clean(raw(spark, {"WEATHER_DELAY": NAN})))
    assert (r.delayed, r.delayed_time) == (0, 0.0)
    r = one(C.clean(raw(spark, {"NAS_DELAY": -5.0})))
    assert (r.delayed, r.delayed_time) == (0, -5.0)
    r = one(C.clean(raw(spark, {"NAS_DELAY": -5.0, "CARRIER_DELAY": 20.0})))
    assert (r.delayed, r.delayed_time) == (1, 15.0)


def test_cancelled_row_is_kept_and_filled(spark):
    r = one(C.clean(raw(spark, {"CANCELLED": 1.0, "CANCELLATION_CODE": "B"})))
    assert r.cancelled == 1 and all(r[c] == 0 for c in ZERO_FILLED)


def test_missing_schedule_is_dropped_in_v3_only(spark):
    df = raw(spark, {"CRS_DEP_TIME": None}, {"CRS_DEP_TIME": NAN})
    assert C.clean(df).count() == 0
    assert C.clean(df, "v1").count() == 2


def test_v1_keeps_nulls_and_double_flags(spark):
    cleaned = C.clean(raw(spark, {}), "v1")
    assert dict(cleaned.dtypes)["cancelled"] == "double"
    assert one(cleaned).arrival_delay is None


def test_missing_flag_stays_null(spark):
    assert one(C.clean(raw(spark, {"CANCELLED": None}))).cancelled is None


def test_filled_columns_have_no_nulls(spark):
    cleaned = C.clean(raw(spark, {"DEP_DELAY": 3.0}, {}, {"ARR_DELAY": NAN}))
    profile = {r.column: r.n_missing for r in P.null_profile(cleaned, keep_zero=True).collect()}
    assert all(profile[c] == 0 for c in ZERO_FILLED)


def test_result_ignores_partitioning(spark):
    df = raw(spark, *[{"DEP_DELAY": float(i), "CRS_DEP_TIME": None if i % 7 == 0 else 1.0} for i in range(50)])
    a = sorted(C.clean(df.repartition(1)).collect())
    assert a == sorted(C.clean(df.repartition(13)).collect())


def test_code_labels(spark):
    df = spark.createDataFrame([("A",), ("D",), ("Z",), (None,)], "code string")
    expected = {"A": "Airline/Carrier", "D": "Security", "Z": None, None: None}
    assert {r.code: r.label for r in C.label_codes(df, "code", "label").collect()} == expected
    lookup = spark.createDataFrame([("A", "Airline/Carrier"), ("D", "Security")], "c string, label string")
    assert {r.code: r.label for r in C.lookup_codes(df, "code", lookup, "c").collect()} == expected


def test_union_by_name_aligns_and_fills(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, n int")
    c = spark.createDataFrame([(3,)], "n int")
    assert sorted(map(tuple, C.union_by_name([a, b, c]).collect())) == [(1, "x"), (2, "y"), (3, None)]


def test_event_ids_never_collide(spark):
    rows = [("a-b", "c"), ("a", "b-c"), (None, "x"), ("\\N", "x"), ("a\\", "-b"), ("a", "\\-b")]
    ids = C.with_event_id(spark.createDataFrame(rows, "p string, q string"), ["p", "q"])
    assert ids.select("event_id").distinct().count() == len(rows)


def test_small_fractions_and_null_keys(spark):
    from ontime.operators import sample as S

    df = spark.range(1_000_000)
    for bucket in (S.bucket_of(["id"], 3), S.fast_bucket_of(["id"], 3), S.integer_bucket_of({"id": 7})):
        assert 15 < S.sample(df, 0.00004, bucket).count() < 75
        few, rest = S.split(df, 0.99999, bucket)
        assert few.count() + rest.count() == 1_000_000 and rest.count() > 0
    keyed = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    for bucket in (S.bucket_of(["k"], 3), S.fast_bucket_of(["k"], 3), S.integer_bucket_of({"k": 7}), F.lit(None).cast("long")):
        train, test = S.split(keyed, 0.5, bucket)
        assert train.count() + test.count() == 3
        assert sum(r.n for r in S.split_counts(keyed.withColumn("y", F.lit(1)), 0.5, bucket, "y").collect()) == 3


def test_keys_of_one_column_are_never_null(spark):
    from ontime.functions.values import key_text

    df = spark.createDataFrame([("a",), (None,), ("\\N",)], "k string")
    keys = [r[0] for r in df.select(key_text(["k"])).collect()]
    assert keys[0] == "a" and None not in keys and len(set(keys)) == 3


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1), (1, "a", 3)], "k int, t string, n int")
    for order in (df, df.orderBy(F.desc("n")), df.repartition(3)):
        assert sorted(C.first_per_key(order, ["k"]).collect()) == [(1, "a", 3), (2, None, 1)]


def test_labels_move_no_flight(spark):
    from ontime.plans.registry import QUERIES

    plan = QUERIES["code_labels"](spark, "/root/testdata/sf0.001")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_scheduled_departure_is_pushed_to_the_scan(spark):
    from ontime.plans.flights import flights

    plan = C.clean(flights(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().toString()
    assert "IsNotNull(CRS_DEP_TIME)" in plan
