"""Row counts, known values and ranges out of Parquet footers: no data column is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime.session import kept, settings

# Spark pushes aggregates into its second-generation source only.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
#: Types whose least and largest value footers give exactly.
RANGED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def footer_aggregate(spark: SparkSession, path: str, layout: T.StructType, by: list[str]) -> DataFrame:
    """One row per group of partition folders: ``n``, and for each column its known values (and range). Must be planned while the
    settings hold, which ``footer_report`` sees to."""
    df = spark.read.schema(layout).parquet(path)
    cells = [F.count("*").alias("n")]
    for i, f in enumerate(c for c in layout.fields if c.name not in by):
        cells.append(F.count(F.col(f"`{f.name}`")).alias(f"known{i}"))
        if isinstance(f.dataType, RANGED):
            cells += [F.min(F.col(f"`{f.name}`")).alias(f"low{i}"), F.max(F.col(f"`{f.name}`")).alias(f"high{i}")]
    return df.groupBy(*by).agg(*cells)


def footer_report(spark: SparkSession, path: str, layout: T.StructType, by: list[str] | None = None) -> DataFrame:
    """(by, column, n, n_known, min, max) of a Parquet table, by its partition folders or as a whole.

    Ranges of numbers are doubles, others have none. Tasks read footers only, and as many rows come out as there are groups and
    columns. Footers without statistics are an error of Spark's; such a table needs ``numeric_stats``.
    """
    by = by or []
    columns = [f for f in layout.fields if f.name not in by]
    with settings(spark, _FOOTERS):
        # Stored at once: planned later, the query would scan the columns.
        found = kept(footer_aggregate(spark, path, layout, by), "footers")
    rows = []
    for i, f in enumerate(columns):
        number = isinstance(f.dataType, T.NumericType) and isinstance(f.dataType, RANGED)
        # Footers write a least zero as a negative one; adding zero mends that.
        limits = [F.col(f"{end}{i}").cast("double") + 0.0 if number else F.lit(None).cast("double") for end in ("low", "high")]
        rows.append(F.struct(F.lit(f.name).alias("column"), F.col("n"), F.col(f"known{i}").alias("n_known"), limits[0].alias("min"), limits[1].alias("max")))
    return found.select(*by, F.inline(F.array(*rows)))
