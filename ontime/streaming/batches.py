"""Several sinks fed from one micro-batch, each exactly once.

Spark repeats a micro-batch, under the same id, when a run ends between its start and its commit. A sink that was written before
must then not be written again. A ledger beside the checkpoint has one entry for each sink and batch. The first sink is a Parquet table:
a batch is a folder of it that is replaced as a whole, so writing it twice leaves it once. The other sinks read that folder, not the stream: rows
are computed once, all sinks get the same ones, and a lost executor costs nothing.

A sink that can't be replaced (a broker) has its batch again only if the run ends between its write and the ledger entry; messages keep
their keys, so ``unique_messages`` on the other side removes these.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ontime.operators.messages import publish
from ontime.session import settings
from ontime.streaming.pipeline import STATE


class Ledger:
    """Which sink has which batch: an empty file for each, under the checkpoint that numbers the batches."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self._jvm, self.root = spark._jvm, f"{checkpoint.rstrip('/')}/sinks"
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.run = self._name_of_run()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *filter(None, parts)]))

    def _children(self, *parts: str) -> list[str]:
        place = self._path(*parts)
        return [s.getPath().getName() for s in self._files.listStatus(place)] if self._files.exists(place) else []

    def _name_of_run(self) -> str:
        """A name of this checkpoint. Another checkpoint counts its batches from 0 again and must not replace these folders."""
        names = [n for n in self._children() if n.startswith("run-")]
        if not names:
            self._files.create(self._path(f"run-{uuid.uuid4().hex[:12]}"), False).close()
            names = [n for n in self._children() if n.startswith("run-")]
        return min(names)

    def has(self, sink: str, batch: int) -> bool:
        return self._files.exists(self._path(sink, str(batch)))

    def enter(self, sink: str, batch: int) -> None:
        self._files.create(self._path(sink, str(batch)), True).close()

    def batches(self, sink: str) -> list[int]:
        return sorted(int(n) for n in self._children(sink) if n.isdigit())


def folder_of(table: str, run: str, batch: int) -> str:
    return f"{table.rstrip('/')}/batch={run}-{batch}"


@dataclass(frozen=True)
class Sink:
    """A further sink: ``write`` gets the rows of the batch and its id."""

    name: str
    write: Callable[[DataFrame, int], None]


def message_sink(name: str, fmt: str, options: dict[str, str], prepare: Callable[[DataFrame], DataFrame]) -> Sink:
    """Messages to a broker or folder; ``prepare`` makes (key, value) rows."""
    return Sink(name, lambda rows, batch: publish(prepare(rows), fmt, options))


def table_sink(name: str, path: str, run_of: Ledger, prepare: Callable[[DataFrame], DataFrame] | None = None) -> Sink:
    """A further Parquet table, one folder a batch as well."""

    def write(rows: DataFrame, batch: int) -> None:
        (prepare(rows) if prepare else rows).write.mode("overwrite").parquet(folder_of(path, run_of.run, batch))

    return Sink(name, write)


def write_batch(rows: DataFrame, batch: int, table: str, sinks: list[Sink], ledger: Ledger) -> None:
    """One batch into the table and then into every sink that has not had it."""
    spark = rows.sparkSession
    folder = folder_of(table, ledger.run, batch)
    if not ledger.has("table", batch):
        rows.write.mode("overwrite").parquet(folder)
        ledger.enter("table", batch)
    kept = spark.read.schema(rows.schema).parquet(folder)
    for sink in sinks:
        if not ledger.has(sink.name, batch):
            sink.write(kept, batch)
            ledger.enter(sink.name, batch)


def fan_out(df: DataFrame, table: str, sinks: list[Sink], checkpoint: str, trigger: dict | None = None, ledger: Ledger | None = None) -> StreamingQuery:
    """A stream into a Parquet table and further sinks, in one query."""
    names = [s.name for s in sinks]
    if len({*names, "table"}) <= len(names):
        raise ValueError(f"sinks need names of their own, other than 'table': {names}")
    ledger = ledger or Ledger(df.sparkSession, checkpoint)
    writer = df.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, table, sinks, ledger)).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    with settings(df.sparkSession, STATE):
        return writer.start()


def entered(spark: SparkSession, table: str, checkpoint: str, layout, sink: str = "table") -> DataFrame:
    """What a table has of the batches its ledger lists: a batch being replaced just now is not seen half-way."""
    ledger = Ledger(spark, checkpoint)
    folders = [folder_of(table, ledger.run, b) for b in ledger.batches(sink)]
    return spark.read.schema(layout).parquet(*folders) if folders else spark.createDataFrame([], layout)
