import datetime as dt
import os

import pytest
from pyspark.sql import functions as F, types as T

from ontime.operators import clean as C, messages as M, models as L
from ontime.plans.flights import KEY, flights
from ontime.plans.registry import messages
from ontime.schema import MESSAGE, PREDICTION, RAW
from ontime.streaming import pipeline as X

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}
SIDE = "event_id string, event_time timestamp, route string, p double"


@pytest.fixture(scope="module")
def raw(spark):
    return flights(spark, SF, KEY)


def run(df, tmp_path, name="out"):
    path = f"{tmp_path}/{name}"
    X.drain(X.start(df, "parquet", f"{tmp_path}/{name}-checkpoint", {"path": path}, NOW))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_clean_stream_is_clean_batch(spark, raw, tmp_path):
    raw.select(RAW.names).repartition(5).write.parquet(f"{tmp_path}/in")
    stream = X.source(spark, "parquet", {"path": f"{tmp_path}/in", "maxFilesPerTrigger": "2"}, RAW)
    assert same(run(C.clean(stream), tmp_path), C.clean(raw))


def test_restart_goes_on_where_it_stopped(spark, raw, tmp_path):
    few = raw.select(RAW.names).limit(40).cache()
    few.write.parquet(f"{tmp_path}/in")
    layout = {"path": f"{tmp_path}/in"}
    assert run(C.clean(X.source(spark, "parquet", layout, RAW)), tmp_path).count() == C.clean(few).count()
    few.limit(10).write.mode("append").parquet(f"{tmp_path}/in")
    again = run(C.clean(X.source(spark, "parquet", layout, RAW)), tmp_path)
    assert again.count() == C.clean(few).count() + C.clean(few.limit(10)).count()


def test_scored_stream_is_scored_batch(spark, raw, tmp_path):
    rows = messages(raw)
    model = L.fit(rows, {"cancelled": "rf", "diverted": "logreg"})
    M.publish(M.encode(rows, ["event_id"], MESSAGE.names), "parquet", {"path": f"{tmp_path}/in"})
    layout = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    got = run(X.score_messages(X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, layout), model), tmp_path)
    assert [f.dataType.simpleString() for f in got.schema] == [f.dataType.simpleString() for f in PREDICTION]
    assert got.count() == rows.count() == got.select("event_id").distinct().count()
    assert same(got, L.score(rows, model).select(*PREDICTION.names))
    sent = X.prediction_messages(got)
    assert same(M.decode(sent, PREDICTION), got)


def side(spark, n, start=0):
    base = dt.datetime(2009, 1, 1)
    return spark.createDataFrame(
        [(str(i), base + dt.timedelta(minutes=i), "JFK-LAX", float(i)) for i in range(start, start + n)], SIDE
    )


def test_join_on_id_not_on_route(spark):
    a = side(spark, 2).withColumnRenamed("p", "a")
    b = side(spark, 2).select("event_id", "event_time", "route", F.col("p").alias("b"))
    assert X.join_predictions(a, b.drop("route"), ["event_id"], "event_time").count() == 2
    assert X.join_predictions(a.drop("event_id", "event_time"), b.drop("event_id", "event_time"), ["route"]).count() == 4


def test_route_counts_are_the_route_join(spark):
    a = side(spark, 30).select("route", (F.col("p") % 2).alias("a"))
    b = side(spark, 20).select("route", (F.col("p") % 3).alias("b"))
    joined = a.join(b, "route").groupBy("route", "a", "b").agg(F.count("*").alias("n"))
    assert same(X.route_join_counts(a, b, ["route"], ("a", "b")), joined)


def test_stream_join_drops_old_state(spark, tmp_path):
    layout = side(spark, 1).schema
    for step in range(3):
        for name in "ab":
            path = f"{tmp_path}/{name}"
            side(spark, 100, step * 100).coalesce(1).write.mode("append").parquet(path)
            # Files are read in the order of their times.
            for f in os.listdir(path):
                if f.endswith(".parquet") and os.path.getmtime(f"{path}/{f}") > 1e9 and f not in seen:
                    os.utime(f"{path}/{f}", (1000 + step, 1000 + step))
                    seen.add(f)

    def read(name):
        return X.source(spark, "parquet", {"path": f"{tmp_path}/{name}", "maxFilesPerTrigger": "1"}, layout)

    a, b = read("a").drop("route").withColumnRenamed("p", "a"), read("b").drop("route").withColumnRenamed("p", "b")
    joined = X.join_predictions(a, b, ["event_id"], "event_time", "10 minutes")
    counted = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "true"}
    query = X.start(joined, "parquet", f"{tmp_path}/checkpoint", {"path": f"{tmp_path}/out"}, NOW, state=counted)
    X.drain(query)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 300
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert state[-1]["numRowsTotal"] < 300


seen: set = set()


def test_memory_sink_needs_no_checkpoint_and_others_do(spark, raw, tmp_path):
    raw.select(RAW.names).limit(20).write.parquet(f"{tmp_path}/in")
    stream = X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, RAW)
    X.drain(X.start(C.clean(stream), "memory", name="cleaned", trigger=NOW))
    assert spark.table("cleaned").count() == C.clean(raw.select(RAW.names).limit(20)).count()
    with pytest.raises(ValueError):
        X.start(stream, "parquet", options={"path": f"{tmp_path}/x"})


def test_failures_are_raised(spark, tmp_path):
    spark.createDataFrame([("x",)], "v string").write.parquet(f"{tmp_path}/in")
    stream = X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, T.StructType([T.StructField("v", T.StringType())]))
    query = X.start(stream.select(F.col("v").cast("int")), "parquet", f"{tmp_path}/c", {"path": f"{tmp_path}/o"}, NOW)
    with pytest.raises(Exception):
        X.drain(query)


def test_settings_are_put_back(spark, tmp_path):
    before = {key: spark.conf.get(key, None) for key in X.STATE}
    spark.range(3).write.parquet(f"{tmp_path}/in")
    stream = X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, spark.range(1).schema)
    X.drain(X.start(stream, "console", trigger=NOW))
    assert {key: spark.conf.get(key, None) for key in X.STATE} == before


def test_one_target_and_a_join_of_scored_streams(spark, raw, tmp_path):
    """Layout by target, event time carried, several batches, and the second side scored by a model of its own."""
    rows = messages(raw)
    M.publish(M.encode(rows.repartition(4), ["event_id"], MESSAGE.names), "parquet", {"path": f"{tmp_path}/in"})
    layout = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    sides = []
    for target in ("cancelled", "diverted"):
        model = L.fit(rows, "rf", [target])
        stream = X.source(spark, "parquet", {"path": f"{tmp_path}/in", "maxFilesPerTrigger": "1"}, layout)
        sides.append(X.score_messages(stream, model, [target]))
        assert sides[-1].columns == ["event_id", "event_time", "origin_airport", "destination_airport", f"{target}_prediction", f"{target}_probability"]
    joined = X.join_predictions(sides[0], sides[1].drop("origin_airport", "destination_airport"), ["event_id"], "event_time", "4000 days")
    got = run(joined, tmp_path)
    assert got.count() == rows.count() == got.select("event_id").distinct().count()


def test_unbounded_stream_join_is_refused(spark, tmp_path):
    spark.createDataFrame([("a", None, "r", 0.5)], SIDE).write.parquet(f"{tmp_path}/in")
    stream = X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, T.StructType.fromDDL(SIDE))
    table = spark.read.parquet(f"{tmp_path}/in")
    for left, right in ((stream, stream), (stream, table), (table, stream)):
        with pytest.raises(ValueError):
            X.join_predictions(left, right, ["event_id"], "event_time")
    assert X.join_predictions(table, table.drop("route", "p", "event_time"), ["event_id"]).count() == 1


def test_two_sinks_and_their_restart(spark, tmp_path):
    spark.range(5).withColumn("x", F.col("id") * 2).write.parquet(f"{tmp_path}/in")
    layout = T.StructType.fromDDL("id long, x long")
    for n in (5, 8):
        stream = X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, layout)
        first, follow = X.two_sinks(stream, f"{tmp_path}/table", f"{tmp_path}/checks", ("parquet", {"path": f"{tmp_path}/second"}), lambda d: d.select((F.col("x") + 1).alias("y")), NOW)
        X.drain(first)
        X.drain(follow())
        assert spark.read.parquet(f"{tmp_path}/table").count() == n == spark.read.parquet(f"{tmp_path}/second").count()
        spark.range(100, 103).withColumn("x", F.col("id") * 2).write.mode("append").parquet(f"{tmp_path}/in")


def test_run_returns_when_a_query_ends(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    spark.streams.resetTerminated()
    X.start(X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, T.StructType.fromDDL("id long")), "parquet", f"{tmp_path}/c", {"path": f"{tmp_path}/out"}, NOW)
    X.run(spark)
    spark.streams.resetTerminated()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
