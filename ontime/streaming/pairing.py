"""A join of two event streams that accounts for every row: matched, unmatched or late.

Each row waits in state until its partner comes or its wait is over; then it is gone. So state is bounded by the events of one waiting
time, and each row of either stream leaves exactly once. Event ids are dealt by hash into a fixed number of groups. A group's waiting rows are
one Arrow table with a timer for the earliest of them, and Python handles whole columns: a call for each group and batch, nothing row by row.
Of the rows of one id, the n-th of one side belongs to the n-th of the other, which is what handling them one by one comes to.

Spark drops rows behind the watermark before a stateful operator sees them. To report them instead, the watermark is declared on a clock
that runs ahead of the event time by a constant, with the same constant as its delay: its value is then the latest event time seen,
and no row is behind it. What is late is decided here.

Cases: repeated rows of one side wait in the order they came and are matched one by one, so nothing is paired twice. A row
without an id is unmatched at once, one without a time late at once. Rows that wait when the stream ends stay in state until time goes on: a
``heartbeat`` row, which has a time and nothing else, moves it. Python sees the other columns as one JSON text, so they keep any type that JSON
holds exactly; the clock stops at the year 2262, so times after 2162 are never over.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ontime.operators.messages import JSON_OPTIONS

#: Days by which the clock runs ahead; more than any event time may lie behind the latest one.
AHEAD_DAYS = 36_500
#: The latest time that a column of pandas holds, to the year.
CLOCK_END = "2262-01-01 00:00:00+00:00"
#: Groups of event ids. Each should hold some tens of thousands of waiting rows at most.
GROUPS = 256
LEFT, RIGHT, BEAT = "left", "right", "beat"
MATCHED, UNMATCHED, LATE = "matched", "unmatched", "late"

_WAITING = ["key", "side", "micros", "body"]
_STATE = T.StructType([T.StructField("waiting", T.BinaryType())])
_FOUND = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "outcome", LEFT, RIGHT)])
_BODY = JSON_OPTIONS | {"ignoreNullFields": "true"}


def _found(outcome: str, rows: pd.DataFrame, other: pd.DataFrame | None = None) -> pd.DataFrame:
    """Rows as they leave: matches, whose left rows come first, with both bodies, others with their own."""
    both = {side: rows["body"].where(rows["side"] == side, None).to_numpy() for side in (LEFT, RIGHT)}
    if other is not None:
        both = {LEFT: rows["body"].to_numpy(), RIGHT: other["body"].to_numpy()}
    return pd.DataFrame({"key": rows["key"].to_numpy(), "outcome": outcome, **both})


def _partners(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of the left and right rows that match: of each key the first with the first, the second with the second, and so on."""
    key, left = pd.factorize(rows["key"])[0].astype(np.int64), (rows["side"] == LEFT).to_numpy()
    turn = pd.Series(key * 2 + left).groupby(key * 2 + left, sort=False).cumcount().to_numpy()
    place = key * len(rows) + turn
    ours, theirs = np.flatnonzero(left), np.flatnonzero(~left)
    _, a, b = np.intersect1d(place[ours], place[theirs], assume_unique=True, return_indices=True)
    return ours[a], theirs[b]


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _opened(state: GroupState) -> list[pd.DataFrame]:
    return [pa.ipc.open_stream(state.get[0]).read_pandas()] if state.exists else []


def _pairing(wait_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What is done with a group's new rows, or when the wait of some of those in state is over."""

    def ends(rows: pd.DataFrame) -> np.ndarray:
        """When the waits for rows' partners are over, in the milliseconds of timers."""
        return rows["micros"].to_numpy() // 1000 + wait_ms

    def keep(state: GroupState, rows: pd.DataFrame, now: int) -> None:
        if len(rows):
            state.update((_packed(rows),))
            # A timer goes off when the watermark is above it; a wait is over when the watermark reaches its end.
            state.setTimeoutTimestamp(max(int(ends(rows).min()) - 1, now + 1))
        elif state.exists:
            state.remove()

    def paired(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        waiting = _opened(state)
        if state.hasTimedOut:
            rows = waiting[0]
            over = ends(rows) <= now
            yield _found(UNMATCHED, rows[over])
            keep(state, rows[~over], now)
            return
        new = pd.concat(list(frames), ignore_index=True)
        new = new[new["side"] != BEAT]
        no_key = new["key"].isna().to_numpy()
        late = ~no_key & (~new["timed"].to_numpy() | (ends(new) < now))
        yield _found(UNMATCHED, new[no_key])
        yield _found(LATE, new[late])
        rows = pd.concat([*waiting, new.loc[~(no_key | late), _WAITING]], ignore_index=True)
        left, right = _partners(rows)
        yield _found(MATCHED, rows.iloc[left], rows.iloc[right])
        alone = np.ones(len(rows), bool)
        alone[left] = alone[right] = False
        keep(state, rows[alone], now)

    return paired


def outcomes(left: DataFrame, right: DataFrame, key: str, time: str, wait: dt.timedelta, groups: int = GROUPS) -> DataFrame:
    """(key, outcome, left_<time>, left's columns, right_<time>, right's columns) for streams of events with an id and a time.

    Matched rows have both sides, others their own. The two streams' other columns need different names. ``groups`` must
    stay the same for as long as the checkpoint is used.
    """
    parts, columns = [], {LEFT: [c for c in left.columns if c not in (key, time)], RIGHT: [c for c in right.columns if c not in (key, time)]}
    if set(columns[LEFT]) & set(columns[RIGHT]):
        raise ValueError("the streams' columns need different names")
    kinds = {f.name: f.dataType for f in [*left.schema.fields, *right.schema.fields]}
    text = isinstance(kinds[key], T.StringType)
    for side, df in ((LEFT, left), (RIGHT, right)):
        # A heartbeat has no id and no column but the time.
        beat = F.forall(F.array(F.col(key).isNull(), *[F.col(c).isNull() for c in columns[side]]), lambda x: x)
        at = F.col(time).cast("timestamp")
        id_ = F.col(key) if text else F.when(F.col(key).isNotNull(), F.to_json(F.struct(F.col(key).cast(kinds[key]).alias("key")), _BODY))
        body = F.struct(F.unix_micros(at).alias("t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns[side])])
        parts.append(df.select(id_.alias("key"), F.when(beat, F.lit(BEAT)).otherwise(F.lit(side)).alias("side"), at.alias("time"), F.to_json(body, _BODY).alias("body")))
    both = parts[0].unionByName(parts[1])
    ahead = F.when(F.col("time").isNotNull(), F.least(F.col("time") + F.expr(f"INTERVAL '{AHEAD_DAYS}' DAY"), F.expr(f"TIMESTAMP '{CLOCK_END}'")))
    # Rows without an id keep no state, so they need not meet.
    group = F.pmod(F.when(F.col("key").isNull(), F.xxhash64("time", "body")).otherwise(F.xxhash64("key")), F.lit(groups)).alias("bucket")
    # Python gets times as whole numbers, so no time zone comes between.
    micros = F.coalesce(F.unix_micros("time"), F.lit(0))
    both = both.select(group, "key", "side", micros.alias("micros"), F.col("time").isNotNull().alias("timed"), "body", ahead.alias("clock"))
    paired = (
        both.withWatermark("clock", f"{AHEAD_DAYS} days")
        .groupBy("bucket")
        .applyInPandasWithState(_pairing(int(wait.total_seconds() * 1000)), _FOUND, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )

    def cells(side: str) -> list[Column]:
        layout = T.StructType([T.StructField("t", T.LongType()), *[T.StructField(f"c{i}", kinds[c]) for i, c in enumerate(columns[side])]])
        read = F.from_json(side, layout, _BODY)
        return [F.timestamp_micros(read["t"]).alias(f"{side}_{time}"), *[read[f"c{i}"].alias(c) for i, c in enumerate(columns[side])]]

    id_ = F.col("key") if text else F.from_json("key", T.StructType([T.StructField("key", kinds[key])]), _BODY)["key"]
    return paired.select(id_.alias(key), "outcome", *cells(LEFT), *cells(RIGHT))


def heartbeat(spark: SparkSession, layout: T.StructType, time: str, at: dt.datetime) -> DataFrame:
    """One row of a stream's layout that only says how late it is, so that rows that wait are let go."""
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in layout.fields])
    return spark.createDataFrame([tuple(at if f.name == time else None for f in layout.fields)], loose)


def outcome_counts(found: DataFrame) -> DataFrame:
    """Rows by outcome, and the rows that were sent: a match is two of them."""
    sent = F.when(F.col("outcome") == MATCHED, 2).otherwise(1)
    return found.groupBy("outcome").agg(F.count("*").alias("n"), F.sum(sent).alias("n_sent"))


def unique_messages(stream: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """A stream without messages published again within ``delay`` of the first, by publishing time.

    State holds the keys of that long only. A copy that is older than the watermark is dropped as late; it had its turn.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)
