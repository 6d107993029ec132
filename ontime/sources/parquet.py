"""Year-partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime.functions.values import calendar_date, finite
from ontime.operators.clean import union_by_name
from ontime.schema import RAW
from ontime.session import FOLDERS, WIDE_STAGES, settings
from ontime.sources import csv


def write_years(df: DataFrame, path: str, date: str = "FL_DATE", mode: str = "overwrite", gather: bool = True) -> None:
    """Write one folder per year.

    ``gather`` shuffles each year's rows into files of the advised size: small years do not become
    many small files, and a year with most of the rows is split over many tasks. Without it every task
    writes its own file per year; that saves the shuffle where tasks are large already.
    """
    dated = df if "year" in df.columns else df.withColumn("year", F.year(calendar_date(date, df.schema[date].dataType)))
    with settings(df.sparkSession, WIDE_STAGES | FOLDERS):
        (dated.hint("rebalance", "year") if gather else dated).write.mode(mode).partitionBy("year").parquet(path)


def read_years(spark: SparkSession, path: str, columns: T.StructType, years: list[int] | None = None) -> DataFrame:
    """Read such a table; ``years`` skips the folders of all others."""
    layout = T.StructType([f for f in columns.fields if f.name != "year"] + [T.StructField("year", T.IntegerType())])
    df = spark.read.schema(layout).parquet(path)
    return df.filter(F.col("year").isin(years)) if years is not None else df


def csv_to_years(spark: SparkSession, paths: list[str], out: str, layout: T.StructType = RAW, **options) -> None:
    """CSV data sets straight to one year-partitioned Parquet table, in one job."""
    write_years(csv.require_rows(csv.ingest(spark, paths, layout, **options)), out)


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """The columns of ``layout`` by name, cast; extra columns go, absent ones are null.

    Files of different years disagree on types. Reading them with one forced schema fails, so each is
    read with its own and cast here.
    """
    columns = []
    for f in layout.fields:
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{f.name}`").try_cast(f.dataType)
        columns.append((finite(value) if isinstance(f.dataType, T.DoubleType) else value).alias(f.name))
    return df.select(*columns)


def read_conformed(spark: SparkSession, paths: list[str], layout: T.StructType) -> DataFrame:
    """Several Parquet data sets with differing types as one table."""
    if not paths:
        raise ValueError("no input paths")
    return union_by_name([conform(spark.read.parquet(p), layout) for p in paths])
