"""The 16-column analysis table, and the small row operators it is made of."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontime.functions.values import calendar_date, key_text, known, number, total, weekday_name
from ontime.schema import CANCEL_REASONS, CAUSES, CLEAN_NAMES, RENAMES, ZERO_FILLED


def fill_nulls(df: DataFrame, value: float, columns: list[str]) -> DataFrame:
    return df.fillna(value, subset=columns)


def filter_known(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column holds a value; NaN is none."""
    return df.filter(known(df.schema[column]).isNotNull())


def date_parts(df: DataFrame, column: str = "FL_DATE") -> DataFrame:
    """Add year, month, day and the English weekday name; all null for an impossible date."""
    # A column of its own, so that the text is parsed once per row and not once per part.
    dated = df.withColumn("_date", calendar_date(column, df.schema[column].dataType))
    date = F.col("_date")
    return dated.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
            "day_of_week": weekday_name(date),
        }
    ).drop("_date")


def any_positive(columns: list[Column]) -> Column:
    """1 where any value is above zero, else 0."""
    return (F.greatest(*columns) > 0).cast("int")


def clean(df: DataFrame, variant: str = "v3", keep: list[str] | None = None) -> DataFrame:
    """Raw flights to the cleaned layout, in one projection and one filter.

    ``v3`` drops rows without a scheduled departure and fills four measures with zero; ``v1`` does
    neither and returns its flags as doubles. ``keep`` names extra columns to carry in front.
    """
    if variant not in ("v1", "v3"):
        raise ValueError(f"unknown variant {variant!r}")
    if variant == "v3":
        # Said of the raw column too, so that Parquet can skip row groups without a value.
        df = df.filter(F.col("CRS_DEP_TIME").isNotNull())
    causes = [F.coalesce(number(c), F.lit(0.0)) for c in CAUSES]
    measures = ["CRS_DEP_TIME", "DEP_DELAY", "TAXI_OUT", "TAXI_IN", "DISTANCE", "ARR_DELAY"]
    renamed = date_parts(df).withColumnsRenamed(RENAMES)
    flag_type = "double" if variant == "v1" else "int"
    renamed = renamed.withColumns(
        {RENAMES[m]: number(RENAMES[m]) for m in measures}
        | {flag: number(flag).try_cast("int").cast(flag_type) for flag in ("cancelled", "diverted")}
        | {"delayed": any_positive(causes).cast(flag_type), "delayed_time": total(causes)}
    )
    if variant == "v3":
        renamed = fill_nulls(filter_known(renamed, "scheduled_departure_time"), 0.0, ZERO_FILLED)
    return renamed.select(*(keep or []), *CLEAN_NAMES)


def label_codes(df: DataFrame, code: str, label: str, pairs: list[tuple[str, str]] = CANCEL_REASONS) -> DataFrame:
    """Add the text for a code. The lookup has a few fixed rows, so it is written into the expression."""
    choice = reduce(lambda acc, p: acc.when(F.col(code) == p[0], F.lit(p[1])), pairs, F)
    return df.withColumn(label, choice)


def lookup_codes(df: DataFrame, code: str, lookup: DataFrame, lookup_code: str) -> DataFrame:
    """Left join to a lookup table of any size; Spark broadcasts it only if it is small enough."""
    return df.join(lookup, df[code] == lookup[lookup_code], "left").drop(lookup[lookup_code])


def drop_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows. With ``columns``, only those are kept, so the result never depends on row order."""
    return (df.select(*columns) if columns else df).distinct()


def first_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """One whole row per key: the one whose other columns come first in order, whatever the order of rows.

    A grouped minimum, so copies shrink before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_least")
    kept = df.groupBy(*key).agg(least)
    return kept.select(*[F.col("_least")[c].alias(c) if c in rest else F.col(f"`{c}`") for c in df.columns])


def constant_table(spark: SparkSession, rows: list[tuple], columns: list[str], kinds: list[str] | None = None) -> DataFrame:
    """A few fixed rows as an inline relation, whose size Spark knows when it plans a join."""
    types = [getattr(pa, k)() for k in kinds or ["string"] * len(columns)]
    return spark.createDataFrame(pa.table({c: pa.array([r[i] for r in rows], types[i]) for i, c in enumerate(columns)}))


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, matched by column name; a column one part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_event_id(df: DataFrame, key: list[str], name: str = "event_id") -> DataFrame:
    """Add an id made from the natural key, so publishing the same rows again gives the same ids."""
    return df.withColumn(name, key_text(key))


