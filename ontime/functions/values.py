"""Column expressions for reading untidy values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from ontime.schema import NA_TOKENS

FLOATS = (T.FloatType, T.DoubleType)


def known_text(column: Column | str) -> Column:
    """The text, or null where it is one of the tokens that mean "no value"."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(~F.trim(c).isin(NA_TOKENS), c)


def finite(column: Column) -> Column:
    """A double with NaN turned into null."""
    return F.nanvl(column, F.lit(None).cast("double"))


def real(column: str) -> Column:
    """A numeric column as a double, NaN as null."""
    return finite(F.col(column).cast("double"))


def number(column: Column | str) -> Column:
    """Any value as a double; null where it is not one."""
    c = F.col(column) if isinstance(column, str) else column
    return finite(c.try_cast("double"))


def convert_known(text: Column, kind: T.DataType) -> Column:
    """Text as the wanted type; null where it does not convert."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, FLOATS):
        return finite(text.try_cast(kind))
    if isinstance(kind, T.DateType):
        return iso_date(text)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # "5.0" is a whole number too.
        value = text.try_cast("double")
        return F.when(value == F.floor(value), value).try_cast(kind)
    return text.try_cast(kind)


def convert(column: Column | str, kind: T.DataType) -> Column:
    """Known text as the wanted type; null for a "no value" token or where it does not convert."""
    return convert_known(known_text(column), kind)


def iso_date(text: Column) -> Column:
    """A yyyy-MM-dd text as a date, null for any other text.

    A plain cast is several times faster than parsing by pattern, but it also takes a year alone or
    a time of day behind the date; the pattern check rules those out.
    """
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))


def calendar_date(column: str, kind: T.DataType) -> Column:
    """The column as a date, whether it holds text, a date or a timestamp."""
    if isinstance(kind, T.StringType):
        return iso_date(F.col(column))
    return F.col(column).cast("date")


# English weekday names.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_name(date: Column) -> Column:
    """The English name whatever the session's locale; a lookup, not a formatter call per row."""
    return F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(date))


def known(field: T.StructField) -> Column:
    """The value in its own type, NaN as null."""
    c = F.col(f"`{field.name}`")
    return F.nanvl(c, F.lit(None).cast(field.dataType)) if isinstance(field.dataType, FLOATS) else c


def missing(field: T.StructField) -> Column:
    """True where the value is null, or NaN for floating-point columns."""
    c = F.col(f"`{field.name}`")
    return c.isNull() | F.isnan(c) if isinstance(field.dataType, FLOATS) else c.isNull()


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def key_text(columns: list[str]) -> Column:
    """One text key out of several columns; stable across runs, partitionings and engines.

    Nulls are written as \\N and separators in the values are escaped, so different rows never share a key.
    A single column is its own key; only a null, and a text that reads like one, are written otherwise.
    """
    null = F.lit("\\N")
    if len(columns) == 1:
        text = F.col(columns[0]).cast("string")
        return F.when(text.isNull(), null).when(text == null, F.lit("\\\\N")).otherwise(text)
    parts = [
        F.coalesce(F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("-"), F.lit("\\-")), null)
        for c in columns
    ]
    return F.concat_ws("-", *parts)
