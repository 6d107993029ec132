"""CSV folders into a yearly Parquet table, with the report taken along and every file read once.

``observed`` counts while it writes: rows by data set, and of every column what was there, missing or not convertible. The counts are metrics of
the writing job itself, so the text is parsed once; a report afterwards would parse it again.

``ingest_new`` keeps a ledger of files with size and time of change. A run anti-joins the folder's listing with it, reads the new files
only, writes them as a folder of their own and enters them last; readers see the runs that the ledger has. A run that breaks off leaves
nothing that anyone reads, and is made good by the next one. A file that has changed is read again, and its earlier rows no longer count.

Cases: a folder without new files starts no job over text. Files without a readable header are an error, or are left out and stay new.
Removed files keep their rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ontime.operators.clean import union_by_name
from ontime.operators.profile import known_and_converted
from ontime.schema import RAW
from ontime.session import own_session
from ontime.sources import csv
from ontime.sources.parquet import write_years


@dataclass(frozen=True)
class Report:
    """What an ingest has counted: rows by data set, and the fate of each column's cells."""

    rows: list[tuple[str, int, int]]
    columns: list[tuple[str, int, int, int]]

    def rows_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "dataset string, n bigint, n_malformed bigint")

    def columns_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.columns, "column string, n_present bigint, n_missing bigint, n_rejected bigint")


def observe_rows(text: DataFrame, datasets: list[str], layout: T.StructType, by: str, observation: Observation) -> DataFrame:
    """The typed rows of text columns, counted as they pass. ``by`` has the place of each row's data set in the list.

    Metrics belong to the whole table, so each data set is one conditional count; there are as many as paths were given.
    """
    kinds = [(f.name, f.dataType) for f in layout.fields]
    missing = [f.name for f in layout.fields if f.name not in text.columns]
    text = text.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else text
    values = known_and_converted(text, [by, csv.BAD], kinds)
    counts = []
    for i, _ in enumerate(datasets):
        here = F.col(by) == i
        counts += [F.count_if(here).alias(f"rows{i}"), F.count_if(here & F.col(csv.BAD).isNotNull()).alias(f"malformed{i}")]
    for i, _ in enumerate(kinds):
        counts += [F.count(f"_known{i}").alias(f"known{i}"), F.count(f"_converted{i}").alias(f"converted{i}")]
    return values.observe(observation, *counts).select(*[F.col(f"_converted{i}").alias(name) for i, (name, _) in enumerate(kinds)])


def report_of(found: dict[str, int], datasets: list[str], layout: T.StructType) -> Report:
    rows = [(d, found[f"rows{i}"], found[f"malformed{i}"]) for i, d in enumerate(datasets)]
    total = sum(n for _, n, _ in rows)
    return Report(rows, [(c, found[f"known{i}"], total - found[f"known{i}"], found[f"known{i}"] - found[f"converted{i}"]) for i, c in enumerate(layout.names)])


def observed(spark: SparkSession, paths: list[str], out: str, layout: T.StructType = RAW, date: str = "FL_DATE", **options) -> Report:
    """Several CSV data sets into one year-partitioned Parquet table, and what was counted on the way.

    Every task writes its own files: no shuffle lies between the counts and the write, so a repeated task is never counted twice.
    """
    if not paths:
        raise ValueError("no input paths")
    datasets = [p.rstrip("/").rsplit("/", 1)[-1] for p in paths]
    own = own_session(spark)
    parts = [csv.read_text(own, p, **options).withColumn("_dataset", F.lit(i)) for i, p in enumerate(paths)]
    seen = Observation("ingest")
    rows = observe_rows(union_by_name(parts), datasets, layout, "_dataset", seen)
    write_years(rows, out, date, gather=False)
    return report_of(seen.get, datasets, layout)


# ---- file by file ------------------------------------------------------------------------------

_ENTRY = "path string, bytes bigint, changed timestamp, run string"


@dataclass(frozen=True)
class Table:
    """A table of ingested files: rows under ``data``, one folder a run, and the ledger of files under ``ledger``."""

    path: str

    @property
    def data(self) -> str:
        return f"{self.path.rstrip('/')}/data"

    @property
    def ledger(self) -> str:
        return f"{self.path.rstrip('/')}/ledger"

    def entries(self, spark: SparkSession) -> DataFrame:
        """All files of all finished runs; of a file that was read again, each time."""
        place = spark._jvm.org.apache.hadoop.fs.Path(self.ledger)
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return spark.createDataFrame([], _ENTRY)
        return spark.read.schema(_ENTRY).parquet(self.ledger)

    def current(self, spark: SparkSession) -> DataFrame:
        """Of each file the latest run that read it."""
        latest = F.max_by(F.struct("bytes", "changed", "run"), "changed").alias("e")
        return self.entries(spark).groupBy("path").agg(latest).select("path", "e.*")

    def read(self, spark: SparkSession, layout: T.StructType = RAW) -> DataFrame:
        """The rows of every file as last read; ``year``, ``run`` and ``file`` come after the layout's columns."""
        whole = T.StructType([*layout.fields, T.StructField("file", T.StringType()), T.StructField("run", T.StringType()), T.StructField("year", T.IntegerType())])
        if self.entries(spark).isEmpty():
            return spark.createDataFrame([], whole)
        rows = spark.read.schema(whole).parquet(self.data)
        # Spark measures the ledger and sends it to the rows if it is small; a run it lacks has no rows here.
        live = self.current(spark).select(F.col("path").alias("file"), "run")
        return rows.join(live, ["file", "run"], "left_semi").select(*whole.names)


def listing(spark: SparkSession, folder: str, pattern: str = csv.PATTERN) -> DataFrame:
    """(path, bytes, changed) of every matching file; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return found.select(csv.plain_path("path").alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def new_files(spark: SparkSession, folder: str, table: Table, pattern: str = csv.PATTERN) -> DataFrame:
    """Files the ledger does not have with this size and time."""
    return listing(spark, folder, pattern).join(table.current(spark), ["path", "bytes", "changed"], "left_anti")


def ingest_new(spark: SparkSession, folder: str, table: Table, layout: T.StructType = RAW, date: str = "FL_DATE", skip_unreadable: bool = False) -> list[tuple[str, int]]:
    """Read what is new in a folder, and say which files and how many rows of each."""
    run = uuid.uuid4().hex
    fresh = new_files(spark, folder, table).collect()
    if not fresh:
        return []
    groups = csv.by_header(spark, [r.path for r in fresh], skip_unreadable)
    if not groups:
        return []
    text = csv.read_groups(spark, groups, skip_unreadable=skip_unreadable, file_column="_file")
    rows = csv.typed(text.withColumn("file", csv.plain_path("_file")), layout, ["file"])
    target = f"{table.data}/run={run}"
    write_years(rows, target, date, gather=False)
    # Counted from the written column alone.
    counts = spark.read.schema("file string").parquet(target).groupBy("file").agg(F.count("*").alias("n"))
    read = {f for files in groups.values() for f in files}
    entries = spark.createDataFrame([(*r, run) for r in fresh if r.path in read], _ENTRY)
    found = entries.join(counts, F.col("path") == F.col("file"), "left").select("path", F.coalesce("n", F.lit(0)).alias("n")).collect()
    entries.coalesce(1).write.mode("append").parquet(table.ledger)
    return sorted((r.path, r.n) for r in found)
