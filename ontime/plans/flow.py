"""Queries on streams and messages that have to account for every row, and on ingests that count as they read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime.operators import clean as C, evolution as V, messages as M
from ontime.plans import oracle as O
from ontime.plans.flights import EVENT_KEY, KEY, flights
from ontime.plans.registry import _EVENTS, _INBOX, _rule_scores, _state_sql, _typed_sql, _yearly_csv, messages, names, query, write_yearly_csv, year_spans
from ontime.schema import MESSAGE, RAW, RAW_NAMES
from ontime.session import fresh_dir
from ontime.sources import ingest as I
from ontime.sources.parquet import read_years
from ontime.streaming import batches as B, pairing as P, pipeline as X

NOW = {"availableNow": True}

#: Flights for each group of a stream join, about: a third of them meet in one batch.
GROUP_ROWS = 100_000


# ---- streams -----------------------------------------------------------------------------------


@query(O.on_clean("SELECT event_id, 1::BIGINT AS n_table, 1::BIGINT AS n_outbox, TRUE AS same FROM events_", events_=_EVENTS))
def stream_two_sinks(spark, sf):
    """A stream into a table and an outbox in one query, over several batches; each event is once in both."""
    rows = messages(flights(spark, sf, KEY)).select("event_id", "event_time", "airline_identifier", "distance")
    inbox, table, outbox, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "sink-table", "sink-outbox", "sink-checkpoint"))
    # A table of fewer tasks is small; others are written as they come. Either way there are about three batches.
    tasks = rows.rdd.getNumPartitions()
    (rows.repartition(6) if tasks < 6 else rows).write.option("compression", "zstd").parquet(inbox)
    stream = X.source(spark, "parquet", {"path": inbox, "maxFilesPerTrigger": str(max(tasks // 3, 2))}, rows.schema)
    sink = B.message_sink("outbox", "parquet", {"path": outbox, "compression": "zstd"}, lambda df: M.encode(df, ["event_id"], df.columns))
    X.drain(B.fan_out(stream, table, [sink], checkpoint, NOW))
    kept = B.entered(spark, table, checkpoint, rows.schema).select("event_id", "distance", F.lit("table").alias("sink"))
    sent = M.decode(spark.read.schema(_INBOX).parquet(outbox), rows.schema).select("event_id", "distance", F.lit("outbox").alias("sink"))
    both = kept.union(sent).groupBy("event_id").agg(
        F.count_if(F.col("sink") == "table").alias("n_table"), F.count_if(F.col("sink") == "outbox").alias("n_outbox"),
        F.min("distance").eqNullSafe(F.max("distance")).alias("same"),
    )
    return both


#: What the two senders leave out, and whose message of the second one comes when all is over.
_NO_LEFT, _NO_RIGHT, _STALE = "l_linenumber = 2", "l_linenumber = 3", "l_linenumber = 4"


@query(
    O.on_clean(
        "SELECT outcome, count(*) AS n, CAST(sum(CASE WHEN outcome = 'matched' THEN 2 ELSE 1 END) AS BIGINT) AS n_sent, count(DISTINCT event_id) AS n_events FROM ("
        f"SELECT event_id, CASE WHEN {_NO_LEFT} OR {_NO_RIGHT} OR {_STALE} THEN 'unmatched' ELSE 'matched' END AS outcome FROM events_ "
        f"UNION ALL SELECT event_id, 'late' FROM events_ WHERE {_STALE}) GROUP BY outcome",
        events_=_EVENTS,
    )
)
def stream_outcomes(spark, sf):
    """Two prediction streams joined over several runs; every row that was sent is matched, unmatched or late."""
    sides = [fresh_dir(spark, n) for n in ("left", "right")]
    out, checkpoint = fresh_dir(spark, "outcomes"), fresh_dir(spark, "outcomes-checkpoint")
    wait = dt.timedelta(minutes=10)
    # A group's rows are in one task's memory, so groups grow with the rows.
    groups = max(P.GROUPS, flights(spark, sf).count() // GROUP_ROWS)

    def predictions(wanted: str, years: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
        rows = flights(spark, sf, [*KEY, "year"]).where(wanted)
        left, right = _rule_scores((rows.where(F.col("year").isin(years)) if years else rows).drop("year"))
        return left.select("event_id", "event_time", "cancelled_prediction"), right

    layouts = [df.schema for df in predictions("true")]
    for path, layout in zip(sides, layouts):
        spark.createDataFrame([], layout).write.parquet(path)
    streams = [X.source(spark, "parquet", {"path": p}, s) for p, s in zip(sides, layouts)]

    def go_on() -> None:
        joined = P.outcomes(*streams, "event_id", "event_time", wait, groups)
        X.drain(X.start(joined, "parquet", checkpoint, {"path": out}, NOW))

    def send(left: DataFrame | None, right: DataFrame | None) -> None:
        for df, path in ((left, sides[0]), (right, sides[1])):
            if df is not None:
                df.write.mode("append").parquet(path)

    for years in year_spans(spark, sf, 3):
        send(predictions(f"NOT ({_NO_LEFT})", years)[0], predictions(f"NOT ({_NO_RIGHT} OR {_STALE})", years)[1])
        go_on()
    # Time goes on, and only then the held-back messages come.
    end = flights(spark, sf).agg(F.max("FL_DATE")).first()[0]
    later = dt.datetime.fromisoformat(end) + dt.timedelta(days=400)
    send(P.heartbeat(spark, layouts[0], "event_time", later), None)
    go_on()
    send(None, predictions(_STALE)[1])
    go_on()
    found = spark.read.schema(P.outcomes(*streams, "event_id", "event_time", wait, groups).schema).parquet(out)
    return P.outcome_counts(found).join(found.groupBy("outcome").agg(F.count_distinct("event_id").alias("n_events")), "outcome")


@query(O.on_clean("SELECT event_id, 1::BIGINT AS n FROM events_", events_=_EVENTS))
def stream_dedup(spark, sf):
    """Messages of which each is published twice, in the same run and in the next one."""
    inbox, out, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "unique", "unique-checkpoint"))
    rows = messages(flights(spark, sf, KEY)).select("event_id", F.year("event_time").alias("year"))
    layout = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("published", T.TimestampType())])
    spans = year_spans(spark, sf, 3)

    def publish(years: list[int], at: dt.datetime) -> None:
        rows.where(F.col("year").isin(years)).select("event_id", F.lit(at).cast("timestamp").alias("published")).write.mode("append").option("compression", "zstd").parquet(inbox)

    for step in range(len(spans) + 1):
        at = dt.datetime(2020, 1, 1) + dt.timedelta(hours=step)
        if step < len(spans):
            publish(spans[step], at)
            publish(spans[step], at + dt.timedelta(minutes=5))
        if step:
            publish(spans[step - 1], at)
        unique = P.unique_messages(X.source(spark, "parquet", {"path": inbox}, layout), ["event_id"], "published", "3 hours")
        X.drain(X.start(unique, "parquet", checkpoint, {"path": out}, NOW))
    return spark.read.schema(layout).parquet(out).groupBy("event_id").agg(F.count("*").alias("n"))


# ---- schemas -----------------------------------------------------------------------------------


def _record(fields: list[dict], **more) -> dict:
    return {"type": "record", "name": "Flight", "fields": fields, **more}


def _f(name: str, kind, **more) -> dict:
    return {"name": name, "type": kind, **more}


_ROUTE_1 = {"type": "record", "name": "Route", "fields": [_f("from", "string"), _f("to", "string"), _f("miles", "int")]}
_ROUTE_2 = {"type": "record", "name": "Route", "fields": [_f("origin", "string", aliases=["from"]), _f("destination", "string", aliases=["to"]), _f("miles", "double"), _f("hub", "boolean", default=False)]}
_STATES = {"type": "enum", "name": "State", "symbols": ["flown", "cancelled"]}
#: The first version, its successor (which the reader uses), and one that cannot be read by it.
VERSIONS = {
    "1": _record([_f("id", "string"), _f("carrier", "string"), _f("route", _ROUTE_1), _f("late", "int"), _f("causes", {"type": "array", "items": "float"}), _f("note", "string")]),
    "2": _record([_f("event_id", "string"), _f("airline", "string"), _f("route", {**_ROUTE_2, "fields": [{k: v for k, v in f.items() if k != "aliases"} for f in _ROUTE_2["fields"]]}),
                  _f("late", ["null", "long"]), _f("causes", {"type": "array", "items": "double"}), _f("state", {**_STATES, "symbols": ["flown", "cancelled", "diverted"]})]),
    "3": _record([_f("event_id", "long"), _f("route", {**_ROUTE_1, "name": "Way"}), _f("late", "string"), _f("state", _STATES)]),
}
READER = _record([
    _f("event_id", "string", aliases=["id"]), _f("airline", "string", aliases=["carrier"]), _f("route", _ROUTE_2), _f("late", "long"),
    _f("causes", {"type": "array", "items": "double"}), _f("state", {**_STATES, "default": "flown"}, default="flown"), _f("source", ["null", "string"], default=None),
])

# The version of a flight's message, and what each version says.
_VERSION = "CASE l_linenumber % 4 WHEN 1 THEN '1' WHEN 2 THEN '3' ELSE '2' END"
_STATE = "CASE WHEN cancelled = 1 THEN 'cancelled' WHEN diverted = 1 THEN 'diverted' ELSE 'flown' END"
_LATE = "CAST(arrival_delay AS BIGINT)"


def _versioned(spark, sf) -> tuple[DataFrame, dict]:
    """The messages of all flights in three versions, with the schemas stored beside them and read from there."""
    df = C.with_event_id(C.clean(flights(spark, sf, KEY), keep=EVENT_KEY), EVENT_KEY)
    miles, late = F.col("distance"), F.expr(_LATE)
    causes = F.array(F.col("delayed_time"), F.lit(0.5))
    bodies = {
        "1": F.struct(F.col("event_id").alias("id"), F.col("airline_identifier").alias("carrier"), F.struct(F.col("origin_airport").alias("from"), F.col("destination_airport").alias("to"), miles.cast("int").alias("miles")).alias("route"), late.cast("int").alias("late"), causes.cast("array<float>").alias("causes"), F.lit("old").alias("note")),
        "2": F.struct("event_id", F.col("airline_identifier").alias("airline"), F.struct(F.col("origin_airport").alias("origin"), F.col("destination_airport").alias("destination"), miles.alias("miles"), (miles > 2000).alias("hub")).alias("route"), F.when(F.col("distance") < 2500, late).alias("late"), causes.alias("causes"), F.expr(_STATE).alias("state")),
        "3": F.struct(F.lit(1).cast("bigint").alias("event_id"), F.struct(F.lit("A").alias("from"), F.lit("B").alias("to"), F.lit(1).alias("miles")).alias("route"), F.lit("x").alias("late"), F.lit("flown").alias("state")),
    }
    version = F.expr(_VERSION)
    value = F.coalesce(*[F.when(version == v, F.to_json(body, M.JSON_OPTIONS)) for v, body in bodies.items()])
    path, schemas = fresh_dir(spark, "messages"), fresh_dir(spark, "schemas")
    df.select(F.col("event_id").alias("key"), version.alias("version"), value.alias("value")).write.parquet(path)
    V.write_versions(spark, VERSIONS, schemas)
    return spark.read.parquet(path), V.read_versions(spark, schemas)


_READ = f"SELECT event_id, {_VERSION} AS version, * EXCLUDE (event_id) FROM events_"


@query(
    O.on_clean(
        "SELECT event_id AS key, version, CASE WHEN version < '3' THEN event_id END AS event_id, CASE WHEN version < '3' THEN airline_identifier END AS airline, "
        "CASE WHEN version < '3' THEN origin_airport END AS origin, CASE WHEN version < '3' THEN destination_airport END AS destination, "
        "CASE WHEN version < '3' THEN distance END AS miles, CASE version WHEN '1' THEN 'false' WHEN '2' THEN CAST(distance > 2000 AS VARCHAR) END AS hub, "
        f"CASE WHEN version = '1' OR version = '2' AND distance < 2500 THEN {_LATE} END AS late, CASE WHEN version < '3' THEN delayed_time + 0.5 END AS causes, "
        f"CASE version WHEN '1' THEN 'flown' WHEN '2' THEN CASE {_STATE} WHEN 'diverted' THEN 'flown' ELSE {_STATE} END END AS state, "
        "CASE WHEN version = '2' AND distance >= 2500 THEN 'late: null' WHEN version = '3' THEN 'airline: default,causes: default,event_id: type,late: type,route: name' ELSE '' END AS refused FROM read_",
        events_=_EVENTS,
        read_=_READ,
    )
)
def message_versions(spark, sf):
    """Messages of three schema versions in one table, read by the newest schema; what is refused keeps its reason."""
    sent, writers = _versioned(spark, sf)
    read = V.decode_versions(sent, writers, READER, keep=["key", "version"])
    causes = F.aggregate("causes", F.lit(0.0), lambda a, x: a + x).alias("causes")
    refused = F.concat_ws(",", F.array_sort("refused")).alias("refused")
    return read.select("key", "version", "event_id", "airline", "route.origin", "route.destination", "route.miles", F.col("route.hub").cast("string").alias("hub"), "late", causes, "state", refused)


@query(
    O.on_clean(
        "SELECT version, path, rule, n FROM (SELECT version, count(*) AS n FROM read_ GROUP BY version) JOIN (VALUES ('3', 'airline', 'default'), "
        "('3', 'causes', 'default'), ('3', 'event_id', 'type'), ('3', 'late', 'type'), ('3', 'route', 'name')) r(version, path, rule) USING (version)",
        events_=_EVENTS,
        read_=_READ,
    )
)
def message_refusals(spark, sf):
    """The rules that pairs of schemas break, and how many messages each concerns."""
    sent, writers = _versioned(spark, sf)
    counts = sent.groupBy("version").agg(F.count("*").alias("n"))
    return V.refusals(spark, writers, READER).join(counts, "version").select("version", "path", "rule", "n")


# ---- ingest ------------------------------------------------------------------------------------

_YEAR_ROWS = "SELECT 'year=' || year AS name, count(*) AS n, 0 AS n_missing, 0 AS n_rejected FROM flights GROUP BY year"


@query(O.on_text(f'SELECT "column" AS name, n_present AS n, n_missing, n_rejected FROM ({_state_sql("")}) UNION ALL {_YEAR_ROWS}'))
def ingest_observed(spark, sf):
    """An ingest that reports on every column and data set without reading the text again."""
    csv = _yearly_csv(spark, sf)
    report = I.observed(spark, [f"{csv}/year={y}" for part in year_spans(spark, sf, 1) for y in part], fresh_dir(spark, "observed"))
    rows = report.rows_table(spark).select(F.col("dataset").alias("name"), "n", F.lit(0).cast("bigint").alias("n_missing"), F.col("n_malformed").alias("n_rejected"))
    return report.columns_table(spark).select(F.col("column").alias("name"), F.col("n_present").alias("n"), "n_missing", "n_rejected").union(rows)


@query(O.on_flights(f"SELECT year, {names([_typed_sql(c) for c in RAW_NAMES])} FROM flights"))
def ingest_incremental(spark, sf):
    """A folder that grows between three runs; every file is read by one of them."""
    folder = fresh_dir(spark, "growing")
    table = I.Table(fresh_dir(spark, "ingested"))
    for some in year_spans(spark, sf, 2):
        write_yearly_csv(spark, sf, folder, some)
        I.ingest_new(spark, folder, table)
        I.ingest_new(spark, folder, table)
    return table.read(spark).select("year", *RAW_NAMES)
