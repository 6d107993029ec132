"""Structured Streaming: sources, sinks, and the batch operators applied to streams."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ontime.operators.messages import decode, encode
from ontime.operators.models import TARGETS, score
from ontime.schema import MESSAGE, prediction_layout
from ontime.session import settings

# State in RocksDB spills to disk instead of filling the executors' memory. Counting its rows would
# read every key before writing it.
STATE = {
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# For queries that come back in short runs: each finds its state as files and not as the changes of all runs before, and the
# state of runs long over goes. A run drops the state of the one before in its own batch, not in an empty one behind it, so state is
# stored once a run.
SHORT = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
#: Rows of a state partition in one run, about, and of one side of a join.
STATE_ROWS = 250_000


def state_parts(spark: SparkSession, rows: int) -> dict[str, str]:
    """State partitions for runs of so many rows, as options for ``start``: a task a core, and more where these would hold too much. Each costs its
    files once a run, whatever it holds. A checkpoint keeps the number it began with."""
    cores = max(spark.sparkContext.defaultParallelism, 1)
    return {"spark.sql.shuffle.partitions": str(cores * max(1, math.ceil(rows / (cores * STATE_ROWS))))}


def source(spark: SparkSession, fmt: str, options: dict[str, str], layout: T.StructType | None = None) -> DataFrame:
    """A stream of any format. Brokers, topics, start offsets and credentials come in ``options``."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(layout) if layout is not None else reader).load()


def start(
    df: DataFrame,
    fmt: str,
    checkpoint: str | None = None,
    options: dict[str, str] | None = None,
    trigger: dict | None = None,
    mode: str = "append",
    name: str | None = None,
    state: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start a query. Only the console and memory sinks may go without a checkpoint folder.

    ``state`` overrides options of the state store.
    """
    if checkpoint is None and fmt not in ("console", "memory"):
        raise ValueError(f"a {fmt} stream needs a checkpoint folder to restart from")
    writer = df.writeStream.format(fmt).outputMode(mode).options(**(options or {}))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    with settings(df.sparkSession, STATE | (state or {})):
        return writer.start()


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries that end by themselves; a failure of any is raised."""
    for query in queries:
        query.awaitTermination()


def run(spark: SparkSession) -> None:
    """Wait until any active query ends or fails, so no failure goes unseen."""
    spark.streams.awaitAnyTermination()


def score_messages(messages: DataFrame, model: PipelineModel, targets: list[str] = TARGETS) -> DataFrame:
    """Message values to predictions: all models in one stateless pass, no join."""
    return score(decode(messages, MESSAGE), model, targets).select(*prediction_layout(targets).names)


def prediction_messages(predictions: DataFrame) -> DataFrame:
    return encode(predictions, ["event_id"], predictions.columns)


def two_sinks(
    df: DataFrame, table: str, checkpoints: str, second: tuple[str, dict[str, str]], prepare: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, Callable[[], StreamingQuery]]:
    """One stream into a Parquet table and, from there, into a second sink, so that its rows are computed once.

    Returns the first query and a function that starts the second. The second reads the table as a stream, so call it once the
    table's folder exists; each has a checkpoint folder of its own and restarts by itself.
    """
    first = start(df, "parquet", f"{checkpoints}/first", {"path": table}, trigger)

    def follow() -> StreamingQuery:
        rows = source(df.sparkSession, "parquet", {"path": table}, df.schema)
        fmt, options = second
        return start(prepare(rows) if prepare else rows, fmt, f"{checkpoints}/second", options, trigger)

    return first, follow


def join_predictions(
    left: DataFrame, right: DataFrame, keys: list[str], time: str | None = None, delay: str | None = None
) -> DataFrame:
    """Inner join of two prediction tables or streams.

    Keys should identify an event: a route matches every flight on it with every other. For streams
    give the event time and the longest delay to expect; both sides then drop state older than that. Without them a stream's
    state would grow for ever, so that is an error.
    """
    if (left.isStreaming or right.isStreaming) and not (time and delay):
        raise ValueError("a join of streams needs the event time and the longest delay to expect")
    if time and delay:
        left, right = left.withWatermark(time, delay), right.withWatermark(time, delay)
    return left.join(right, keys + ([time] if time else []))


def route_join_counts(left: DataFrame, right: DataFrame, keys: list[str], outcomes: tuple[str, str]) -> DataFrame:
    """What the join on a non-unique key would return, as a count per pair of outcomes.

    Both sides shrink to one row per key and outcome first, so no pair is ever produced.
    """
    a = left.groupBy(*keys, outcomes[0]).agg(F.count("*").alias("_a"))
    b = right.groupBy(*keys, outcomes[1]).agg(F.count("*").alias("_b"))
    return a.join(b, keys).select(*keys, *outcomes, (F.col("_a") * F.col("_b")).alias("n"))
