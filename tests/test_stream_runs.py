"""Stream joins run over flights in the order of time, by so many rows a run."""

import os
from functools import reduce

from pyspark.sql import functions as F

from ontime.operators import models as L
from ontime.plans import registry as Q
from ontime.plans.flights import KEY, flights
from ontime.streaming import pipeline as X

SF = "/root/testdata/sf0.001"


def test_spans_part_the_flights_in_order_of_time(spark):
    rows = flights(spark, SF, [*KEY, "year"])
    spans = Q.date_spans(spark, SF, 1000)
    assert len(spans) > 3 and len(Q.date_spans(spark, SF)) == 1
    parts = [rows.where(s).agg(F.count("*"), F.min("FL_DATE"), F.max("FL_DATE")).first() for s in spans]
    assert sum(p[0] for p in parts) == rows.count() and all(p[0] < 1100 for p in parts)
    assert all(a[2] < b[1] for a, b in zip(parts, parts[1:]))
    assert rows.where(~reduce(lambda a, b: a | b, spans)).isEmpty()


def test_join_over_several_runs_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(Q, "RUN_ROWS", 2500)
    want = Q.prediction_join(spark, SF)
    got = Q.stream_join_rules(spark, SF)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_training_rows_are_not_held_in_memory(spark, monkeypatch):
    seen = []
    real = L.classifier

    def spied(*args, **settings):
        model = real(*args, **settings)
        fit = model.fit
        model.fit = lambda df: seen.append(df.storageLevel) or fit(df)
        return model

    monkeypatch.setattr(L, "classifier", spied)
    L.fit(Q.cleaned(spark, SF), "rf", ["cancelled"])
    assert len(seen) == 1 and not seen[0].useMemory


def test_state_partitions_grow_with_cores_and_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = [int(*X.state_parts(spark, n).values()) for n in (0, 1, cores * X.STATE_ROWS, cores * X.STATE_ROWS + 1, 5 * cores * X.STATE_ROWS)]
    assert parts == [cores, cores, cores, 2 * cores, 5 * cores]


def state_of(spark, monkeypatch, name):
    """The batches and state partitions in the stream's checkpoint, after a query of several runs with many shuffle partitions."""
    made, real = {}, Q.fresh_dir
    monkeypatch.setattr(Q, "fresh_dir", lambda s, label: made.setdefault(label, real(s, label)))
    monkeypatch.setattr(Q, "RUN_ROWS", 2500)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = getattr(Q, name)(spark, SF)
        assert got.select("event_id").distinct().count() == got.count() == Q.cleaned(spark, SF).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    root = made["stream-join-checkpoint"].removeprefix("file:")
    return [[n for n in os.listdir(f"{root}/{place}") if n.isdigit()] for place in ("commits", "state/0")]


def test_rules_join_stores_its_state_once_a_run(spark, monkeypatch):
    commits, parts = state_of(spark, monkeypatch, "stream_join_rules")
    assert len(commits) == len(Q.date_spans(spark, SF)) > 1
    assert len(parts) == spark.sparkContext.defaultParallelism


def test_join_of_models_stores_its_state_once_a_run(spark, monkeypatch):
    commits, parts = state_of(spark, monkeypatch, "stream_join")
    assert len(commits) == len(Q.date_spans(spark, SF)) > 1
    assert len(parts) == spark.sparkContext.defaultParallelism
