"""Streams that account for every row: sinks that fail half-way, joins with late and unmatched rows, messages published again."""

import datetime as dt
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from ontime.operators import messages as M
from ontime.streaming import batches as B, pairing as P, pipeline as X

NOW = {"availableNow": True}
LAYOUT = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("x", T.LongType())])
INBOX = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
BASE = dt.datetime(2009, 1, 1)


# ---- several sinks -----------------------------------------------------------------------------


@pytest.fixture
def places(spark, tmp_path):
    spark.range(60).select(F.col("id").cast("string").alias("event_id"), (F.col("id") * 7).alias("x")).repartition(3).write.parquet(f"{tmp_path}/in")
    return {n: f"{tmp_path}/{n}" for n in ("in", "table", "outbox", "more", "checkpoint")}


def outbox(places):
    return B.message_sink("outbox", "parquet", {"path": places["outbox"]}, lambda df: M.encode(df, ["event_id"], df.columns))


def stream(spark, places):
    return X.source(spark, "parquet", {"path": places["in"], "maxFilesPerTrigger": "1"}, LAYOUT)


def ids_in(spark, places):
    table = B.entered(spark, places["table"], places["checkpoint"], LAYOUT)
    sent = M.decode(spark.read.schema(INBOX).parquet(places["outbox"]), LAYOUT)
    return [sorted(int(r.event_id) for r in df.collect()) for df in (table, sent)]


def test_all_sinks_get_every_batch_once(spark, places):
    ledger = B.Ledger(spark, places["checkpoint"])
    more = B.table_sink("more", places["more"], ledger, lambda df: df.select("x"))
    X.drain(B.fan_out(stream(spark, places), places["table"], [outbox(places), more], places["checkpoint"], NOW, ledger))
    assert ids_in(spark, places) == [list(range(60))] * 2
    assert ledger.batches("table") == ledger.batches("outbox") == ledger.batches("more") == [0, 1, 2]
    assert spark.read.schema("x long").parquet(places["more"]).count() == 60


@pytest.mark.parametrize("fails", ["before", "after"])
def test_a_run_that_ends_between_the_sinks_is_made_good(spark, places, fails):
    """The table has the batch, the outbox has not (or has it without an entry); the restarted run gets the same batch again."""
    broken = {"left": 1}
    good = outbox(places)

    def write(rows, batch):
        if batch == 1 and broken["left"]:
            broken["left"] -= 1
            if fails == "after":
                rows.limit(0).write.mode("append").parquet(places["outbox"])
            raise RuntimeError("the outbox is away")
        good.write(rows, batch)

    query = B.fan_out(stream(spark, places), places["table"], [B.Sink("outbox", write)], places["checkpoint"], NOW)
    with pytest.raises(Exception, match="the outbox is away"):
        X.drain(query)
    ledger = B.Ledger(spark, places["checkpoint"])
    assert ledger.batches("table") == [0, 1] and ledger.batches("outbox") == [0]
    X.drain(B.fan_out(stream(spark, places), places["table"], [B.Sink("outbox", write)], places["checkpoint"], NOW))
    assert ids_in(spark, places) == [list(range(60))] * 2


def test_a_batch_that_broke_off_in_the_table_is_replaced(spark, places):
    ledger = B.Ledger(spark, places["checkpoint"])
    half = spark.createDataFrame([("0", 0), ("1", 7)], LAYOUT)
    half.write.parquet(B.folder_of(places["table"], ledger.run, 0))
    assert B.entered(spark, places["table"], places["checkpoint"], LAYOUT).isEmpty()
    X.drain(B.fan_out(stream(spark, places), places["table"], [outbox(places)], places["checkpoint"], NOW))
    assert ids_in(spark, places) == [list(range(60))] * 2


def test_another_checkpoint_does_not_replace_batches(spark, places, tmp_path):
    X.drain(B.fan_out(stream(spark, places), places["table"], [], places["checkpoint"], NOW))
    X.drain(B.fan_out(stream(spark, places), places["table"], [], f"{tmp_path}/other", NOW))
    assert spark.read.schema(LAYOUT).parquet(places["table"]).count() == 120
    assert B.entered(spark, places["table"], places["checkpoint"], LAYOUT).count() == 60


def test_sinks_need_names_of_their_own(spark, places):
    with pytest.raises(ValueError, match="names"):
        B.fan_out(stream(spark, places), places["table"], [B.Sink("table", lambda *_: None)], places["checkpoint"])


# ---- joins with outcomes -----------------------------------------------------------------------

SIDES = [T.StructType([T.StructField("event_id", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField(c, T.DoubleType())]) for c in "ab"]


class Streams:
    """Two folders that are streamed in runs, one batch each."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, str(tmp_path)
        for name, layout in zip("ab", SIDES):
            spark.createDataFrame([], layout).write.parquet(f"{self.path}/{name}")
        self.progress = []

    def run(self, left=(), right=()):
        for name, layout, rows in zip("ab", SIDES, (left, right)):
            data = [(k, None if m is None else BASE + dt.timedelta(minutes=m), v) for k, m, v in rows]
            if data:
                self.spark.createDataFrame(data, layout).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")
        sides = [X.source(self.spark, "parquet", {"path": f"{self.path}/{n}"}, s) for n, s in zip("ab", SIDES)]
        joined = P.outcomes(*sides, "event_id", "at", dt.timedelta(minutes=10))
        counted = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "true"}
        query = X.start(joined, "parquet", f"{self.path}/checkpoint", {"path": f"{self.path}/out"}, NOW, state=counted)
        X.drain(query)
        self.progress += query.recentProgress
        return self.rows()

    def rows(self):
        layout = "event_id string, outcome string, left_at timestamp, a double, right_at timestamp, b double"
        return sorted(((r.event_id, r.outcome, r.a, r.b) for r in self.spark.read.schema(layout).parquet(f"{self.path}/out").collect()), key=str)


def test_every_row_leaves_once(spark, tmp_path):
    s = Streams(spark, tmp_path)
    # In one batch, over two batches, alone, repeated, without an id and without a time.
    s.run([("one", 0, 1.0), ("two", 1, 2.0), ("alone", 2, 3.0), ("rep", 3, 4.0), ("rep", 3, 5.0)], [("one", 0, 10.0), (None, 1, 20.0), ("timeless", None, 30.0)])
    got = s.run([], [("two", 1, 40.0), ("rep", 3, 50.0)])
    assert got == sorted([("one", "matched", 1.0, 10.0), ("two", "matched", 2.0, 40.0), ("rep", "matched", 4.0, 50.0), (None, "unmatched", None, 20.0), ("timeless", "late", None, 30.0)], key=str)
    # An hour later the waiting rows are let go, and what comes then is late.
    got = s.run([("new", 60, 6.0)])
    assert set(got) >= {("alone", "unmatched", 3.0, None), ("rep", "unmatched", 5.0, None)}
    got = s.run([], [("alone", 2, 60.0), ("new", 60, 70.0)])
    assert ("alone", "late", None, 60.0) in got and ("new", "matched", 6.0, 70.0) in got
    sent = {r.outcome: r.n_sent for r in P.outcome_counts(spark.createDataFrame(got, "event_id string, outcome string, a double, b double")).collect()}
    assert sum(sent.values()) == 6 + 7


def test_times_survive_and_state_ends_empty(spark, tmp_path):
    s = Streams(spark, tmp_path)
    s.run([(str(i), i, float(i)) for i in range(50)], [(str(i), i, float(-i)) for i in range(25, 75)])
    beat = P.heartbeat(spark, SIDES[0], "at", BASE + dt.timedelta(days=2)).collect()[0]
    got = s.run([(beat.event_id, 2 * 24 * 60, None)])
    assert [sum(r[1] == o for r in got) for o in ("matched", "unmatched", "late")] == [25, 50, 0]
    layout = "event_id string, outcome string, left_at timestamp, a double, right_at timestamp, b double"
    for r in spark.read.schema(layout).parquet(f"{tmp_path}/out").collect():
        for at in (r.left_at, r.right_at):
            assert at in (None, BASE + dt.timedelta(minutes=int(r.event_id)))
    last = json.loads(s.progress[-1].json) if hasattr(s.progress[-1], "json") else s.progress[-1]
    assert last["stateOperators"][0]["numRowsTotal"] == 0


def test_columns_of_both_sides_need_different_names(spark):
    df = spark.createDataFrame([], SIDES[0])
    with pytest.raises(ValueError, match="different names"):
        P.outcomes(df, df, "event_id", "at", dt.timedelta(minutes=1))


# ---- messages published again ------------------------------------------------------------------


def test_messages_published_again_are_dropped_over_batches_and_runs(spark, tmp_path):
    layout = T.StructType([T.StructField("k", T.StringType()), T.StructField("published", T.TimestampType())])

    def run(*rows):
        data = [(k, BASE + dt.timedelta(minutes=m)) for k, m in rows]
        spark.createDataFrame(data, layout).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        unique = P.unique_messages(X.source(spark, "parquet", {"path": f"{tmp_path}/in"}, layout), ["k"], "published", "30 minutes")
        query = X.start(unique, "parquet", f"{tmp_path}/checkpoint", {"path": f"{tmp_path}/out"}, NOW, state={"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "true"})
        X.drain(query)
        return sorted(r.k for r in spark.read.schema(layout).parquet(f"{tmp_path}/out").collect()), query.recentProgress

    assert run(("a", 0), ("b", 1), ("a", 1))[0] == ["a", "b"]
    assert run(("a", 20), ("c", 25))[0] == ["a", "b", "c"]
    # Long after, the key may come again, and state has forgotten the old ones.
    got, progress = run(("d", 300))
    assert got == ["a", "b", "c", "d"]
    got, progress = run(("a", 301), ("b", 1))
    assert got == ["a", "a", "b", "c", "d"]
    last = json.loads(progress[-1].json) if hasattr(progress[-1], "json") else progress[-1]
    assert last["stateOperators"][0]["numRowsTotal"] == 2


# ---- joins with outcomes, by whole columns -----------------------------------------------------


def test_columns_are_paired_as_rows_one_by_one_would_be():
    rng = random.Random(5)
    for n in (0, 1, 7, 300):
        rows = pd.DataFrame({"key": [f"k{rng.randrange(1 + n // 4)}" for _ in range(n)], "side": [rng.choice([P.LEFT, P.RIGHT]) for _ in range(n)]}, dtype=object)
        waiting, want = {}, set()
        for i, (key, side) in enumerate(rows.itertuples(index=False)):
            mine = waiting.setdefault(key, [])
            if mine and rows["side"][mine[0]] != side:
                want.add((mine.pop(0), i))
            else:
                mine.append(i)
        left, right = P._partners(rows)
        assert {(min(p), max(p)) for p in zip(left.tolist(), right.tolist())} == want
        assert set(rows["side"].iloc[left]) <= {P.LEFT} and set(rows["side"].iloc[right]) <= {P.RIGHT}


def test_other_types_and_keys_come_through(spark, tmp_path):
    """Numbers with nulls, large numbers, no numbers, dates and lists, with a number as the id, matched over two runs."""
    sides = [T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField(f"n{c}", T.LongType()), T.StructField(f"x{c}", T.DoubleType()), T.StructField(f"d{c}", T.DateType()), T.StructField(f"l{c}", T.ArrayType(T.StringType()))]) for c in "ab"]
    big, day = 2**62 + 1, dt.date(1999, 12, 31)
    sent = [[(big, BASE, big, float("nan"), day, ["é", None, '"']), (2, BASE, None, None, None, None), (3, BASE, -1, -0.1, day, [])], [(big, BASE, None, 0.1, None, ["a"]), (2, BASE, big, None, day, None)]]
    for i, (layout, rows) in enumerate(zip(sides, sent)):
        for j in range(2):
            spark.createDataFrame([], layout).write.mode("append").parquet(f"{tmp_path}/{j}")
        spark.createDataFrame(rows, layout).write.mode("append").parquet(f"{tmp_path}/{i}")
        streams = [X.source(spark, "parquet", {"path": f"{tmp_path}/{j}"}, s) for j, s in enumerate(sides)]
        joined = P.outcomes(*streams, "id", "at", dt.timedelta(minutes=10), groups=4)
        X.drain(X.start(joined, "parquet", f"{tmp_path}/checkpoint", {"path": f"{tmp_path}/out"}, NOW))
    got = {r.id: r for r in spark.read.schema(joined.schema).parquet(f"{tmp_path}/out").collect()}
    assert set(got) == {big, 2} and all(r.outcome == P.MATCHED and r.left_at == r.right_at == BASE for r in got.values())
    assert (got[big].na, got[big].da, got[big].la, got[big].nb, got[big].xb, got[big].db, got[big].lb) == (big, day, ["é", None, '"'], None, 0.1, None, ["a"])
    assert got[big].xa != got[big].xa and (got[2].na, got[2].xa, got[2].da, got[2].la, got[2].nb, got[2].db) == (None, None, None, None, big, day)
