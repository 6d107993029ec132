"""Counts, frequencies and statistics; few aggregates over the table, whatever its width."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ontime.functions.stats import equal_width_bin
from ontime.functions.values import convert_known, known, known_text, missing, real
from ontime.operators.ordered import pick_quantiles, value_ranks
from ontime.schema import REPORT_CATEGORIES, REPORT_FLAGS, REPORT_MEASURES, categorical_columns, exact_columns, numeric_columns


def long_rows(df: DataFrame, by: list[str], rows: list[list[Column]]) -> DataFrame:
    """One aggregate, then one output row per entry of ``rows``."""
    entries = F.array(*[F.struct(*cells) for cells in rows])
    return df.groupBy(*by).agg(entries.alias("_rows")).select(*by, F.inline_outer("_rows"))


def tall(df: DataFrame, by: list[str], columns: list[str], kind: str) -> DataFrame:
    """Columns as rows (``_at``, ``value``), where ``_at`` is the place of the column in ``columns``.

    Always aggregate the result directly: the rows then die in the map-side aggregate and none is
    shuffled. One aggregate over tall rows compiles to a small loop; one aggregate per column would
    grow past what the JVM compiles.
    """
    # The array is a projection of its own: as an argument of the generator it would be interpreted.
    # It is never empty; the outer form only keeps Spark from filtering on its size, which computes it twice.
    values = F.array(*[real(f"`{c}`") if kind == "double" else known(df.schema[c]).cast(kind) for c in columns])
    return df.select(*by, values.alias("_values")).select(*by, F.posexplode_outer("_values").alias("_at", "value"))


def named(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Put the column name back in place of ``_at``, on the small aggregated rows."""
    names = F.array(*[F.lit(c) for c in columns])
    rest = [c for c in df.columns if c != "_at" and c not in (by or [])]
    return df.select(*(by or []), F.get(names, F.col("_at")).alias("column"), *rest)


def row_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.lit(len(df.columns) - len(by)).cast("bigint").alias("n_columns"))


def null_profile(df: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Missing values per column, most first."""
    rows = [[F.lit(f.name).alias("column"), F.count_if(missing(f)).alias("n_missing")] for f in df.schema.fields]
    profile = long_rows(df, [], rows)
    if not keep_zero:
        profile = profile.filter("n_missing > 0")
    return profile.orderBy(F.desc("n_missing"), "column")


def frequencies(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """How often each value of each column occurs (nulls are a value), in one pass for all columns."""
    by = by or []
    counts = tall(df, by, columns, "string").groupBy(*by, "_at", "value").agg(F.count("*").alias("n"))
    return named(counts, columns, by)


def top_values(df: DataFrame, columns: list[str] | None = None, n: int = 15) -> DataFrame:
    """The ``n`` most frequent values per column, and the percentage of all rows they cover together."""
    columns = columns or categorical_columns(df.schema)
    counts = frequencies(df, columns)
    rank = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    top = counts.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= n)
    covered = F.sum("n").over(Window.partitionBy("column"))
    rows = df.agg(F.count("*").alias("rows"))
    return top.select("column", "value", "n", "rank", (covered * 100.0 / rows.scalar()).alias("covered_pct"))


def share(df: DataFrame, by: str, flag: str) -> DataFrame:
    """Count and fraction of each flag value inside each group."""
    counts = df.groupBy(by, known(df.schema[flag]).alias(flag)).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def known_counts(df: DataFrame, by: str, column: str) -> DataFrame:
    return df.filter(known(df.schema[column]).isNotNull()).groupBy(by, column).agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, by: list[str], columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct known values per column and group.

    Values are grouped before they are counted, so the work spreads over the values even when one
    group has most rows. ``approximate`` keeps a fixed-size sketch per column instead.
    """
    if approximate:
        rows = [[F.lit(c).alias("column"), F.approx_count_distinct(known(df.schema[c])).alias("n_distinct")] for c in columns]
        return long_rows(df, by, rows)
    return frequencies(df, columns, by).groupBy(*by, "column").agg(F.count("value").alias("n_distinct"))


def numeric_stats(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Mean, minimum, maximum and sample deviation per column and group, in one scan."""
    stats = tall(df, by, columns, "double").groupBy(*by, "_at").agg(
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_samp("value").alias("stddev"),
    )
    return named(stats, columns, by)


def year_report(df: DataFrame, by: str = "year") -> DataFrame:
    """Per group and column: rows, distinct values, statistics and flag counts, as (section, column, item, value)."""
    names = F.array(*[F.lit(c) for c in REPORT_MEASURES])
    stats = tall(df, [by], REPORT_MEASURES, "double").groupBy(by, "_at").agg(
        F.count("*").cast("double").alias("count"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_samp("value").alias("stddev"),
    )

    def cell(section: str, column: Column, item: str) -> Column:
        return F.struct(F.lit(section).alias("section"), column.alias("column"), F.lit(item).alias("item"), F.col(item).alias("value"))

    cells = F.array(*[cell("statistic", F.get(names, F.col("_at")), i) for i in ("mean", "min", "max", "stddev")])
    # Every row has one entry per measure, so the entries of the first one are the rows.
    rows = F.when(F.col("_at") == 0, F.array(cell("rows", F.lit("*"), "count"))).otherwise(F.slice(cells, 1, 0))
    statistics = stats.select(by, F.inline(F.concat(cells, rows)))

    # Distinct values and flag counts come from one frequency pass: per column either one cell, or one for each value.
    both = [*REPORT_CATEGORIES, *[c for c in REPORT_FLAGS if c not in REPORT_CATEGORIES]]
    counts = frequencies(df, both, [by])
    as_flag = F.col("column").isin(REPORT_FLAGS)
    entry = lambda section, item, value: F.struct(F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value"))
    # Grouped by (column, value) no more than once: a flag's value keeps its row, a category's values become a count.
    sections = F.concat(
        F.when(F.col("column").isin(REPORT_CATEGORIES), F.array(entry("distinct", F.lit("count"), F.when(F.col("value").isNotNull(), 1).otherwise(0)))).otherwise(F.array().cast("array<struct<section:string,item:string,value:double>>")),
        F.when(as_flag, F.array(entry("flag", F.col("value"), F.col("n")))).otherwise(F.array().cast("array<struct<section:string,item:string,value:double>>")),
    )
    cells = counts.select(by, "column", F.inline(sections))
    counted = cells.groupBy(by, "section", "column", "item").agg(F.sum("value").alias("value")).select(by, "section", "column", "item", "value")
    return statistics.unionByName(counted)


def describe_table(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation and range of every column.

    Text columns have a text range; so have decimals and whole numbers, since a double may not hold theirs exactly.
    """
    numbers, exact = numeric_columns(df.schema), exact_columns(df.schema)
    texts = [c for c in df.columns if c not in numbers]
    nothing, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    parts = []
    if numbers:
        stats = tall(df, [], numbers, "double").groupBy("_at").agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("stddev"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        stats = named(stats, numbers)
        if exact:
            # The ranges, in each column's own type, are plain totals of the same table.
            ends = F.struct(*[F.struct(F.min(f"`{c}`").cast("string").alias("lo"), F.max(f"`{c}`").cast("string").alias("hi")).alias(f"c{i}") for i, c in enumerate(exact)])
            ranges = df.agg(ends.alias("ranges")).scalar()
            stats = stats.withColumn("_r", ranges)
            pick = lambda side: reduce(lambda w, ic: w.when(F.col("column") == ic[1], F.col("_r")[f"c{ic[0]}"][side]), enumerate(exact), F)
            parts.append(stats.withColumns({"min_text": pick("lo"), "max_text": pick("hi")}).drop("_r"))
        else:
            parts.append(stats.withColumns({"min_text": no_text, "max_text": no_text}))
    if texts:
        # Ranges of text in a grouped aggregate would sort every value, so these are plain totals.
        rows = [
            [
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                *[nothing.alias(a) for a in ("mean", "stddev", "min", "max")],
                F.min(F.col(c).cast("string")).alias("min_text"),
                F.max(F.col(c).cast("string")).alias("max_text"),
            ]
            for c in texts
        ]
        parts.append(long_rows(df, [], rows))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def delay_by(df: DataFrame, by: str, delay: str, exact: bool = False) -> DataFrame:
    """Mean delay, median delay and number of flights per group, worst mean first."""
    df = df.select(by, real(delay).alias(delay))
    if not exact:
        summary = df.groupBy(by).agg(
            F.avg(delay).alias("avg_delay"),
            F.percentile_approx(delay, 0.5).alias("median_delay"),
            F.count("*").alias("flight_count"),
        )
    else:
        mean = F.try_divide(F.sum(F.col(delay) * F.col("n")), F.sum("known")).alias("avg_delay")
        summary = pick_quantiles(
            value_ranks(df, [by], delay), [by], delay, {"median_delay": 0.5}, mean, F.sum("n").alias("flight_count")
        ).select(by, "avg_delay", "median_delay", "flight_count")
    return summary.orderBy(F.desc("avg_delay"), by)


def mean_by(df: DataFrame, by: str, value: str, name: str = "avg_delay") -> DataFrame:
    return df.groupBy(by).agg(F.avg(real(value)).alias(name)).orderBy(by)


def bounds(df: DataFrame, columns: list[str]) -> Column:
    """Minima and maxima of the columns, as a scalar subquery of two arrays: using it needs no join."""
    lows = F.array(*[F.min(real(c)) for c in columns]).alias("lo")
    highs = F.array(*[F.max(real(c)) for c in columns]).alias("hi")
    return df.agg(F.struct(lows, highs).alias("bounds")).scalar()


def histograms(df: DataFrame, columns: list[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bin counts of every numeric column: one pass for all bounds, one for all counts."""
    columns = columns or numeric_columns(df.schema)
    edges = bounds(df, columns)
    lo, hi = F.get(F.col("_b.lo"), F.col("_at")), F.get(F.col("_b.hi"), F.col("_at"))
    counts = (
        tall(df, [], columns, "double")
        .filter(F.col("value").isNotNull())
        .withColumn("_b", edges)
        .select("_at", equal_width_bin(F.col("value"), lo, hi, bins).alias("bin"))
        .groupBy("_at", "bin")
        .agg(F.count("*").alias("n"))
    )
    placed = counts.withColumn("_b", edges).select(
        "_at", "bin", (lo + F.col("bin") * ((hi - lo) / bins)).alias("bin_start"), "n"
    )
    return named(placed, columns)


def box_stats(df: DataFrame, by: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and the number of outliers per group, all exact."""
    ranks = value_ranks(df, [by], value)
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxes = pick_quantiles(ranks, [by], value, wanted, F.sum("known").alias("n_known"))
    fences = boxes.select(
        F.col(by).alias("_by"),
        "q1", "median", "q3",
        "n_known",
        (F.col("q1") - reach * (F.col("q3") - F.col("q1"))).alias("_low"),
        (F.col("q3") + reach * (F.col("q3") - F.col("q1"))).alias("_high"),
    )
    x = F.col(value)
    inside = x.between(F.col("_low"), F.col("_high"))
    return (
        # The ranks hold one row per distinct value, not per input row.
        ranks.join(fences, F.col(by).eqNullSafe(F.col("_by")))
        .groupBy(by, "q1", "median", "q3", "n_known")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("known")).otherwise(0)).alias("n_outliers"),
        )
    )


def schema_drift(df: DataFrame, by: list[str], kinds: T.StructType) -> DataFrame:
    """Per group and column: values present, missing, and present but not of the wanted type, in one scan."""
    values = known_and_converted(df, by, [(f.name, f.dataType) for f in kinds.fields])
    rows = []
    for i, f in enumerate(kinds.fields):
        present = F.count(f"_known{i}")
        rows.append(
            [
                F.lit(f.name).alias("column"),
                present.alias("n_present"),
                (F.count("*") - present).alias("n_missing"),
                (present - F.count(f"_converted{i}")).alias("n_rejected"),
            ]
        )
    return long_rows(values, by, rows)


def known_and_converted(df: DataFrame, by: list[str], kinds: list[tuple[str, T.DataType]]) -> DataFrame:
    """For the i-th column its known text and that text's converted value, as _known{i} and _converted{i}.

    Two projections, so that a text used twice is still computed once. Counting what is not null in
    them costs far less than one tall row per value.
    """
    texts = [known_text(F.col(f"`{c}`").cast("string")).alias(f"_known{i}") for i, (c, _) in enumerate(kinds)]
    values = [convert_known(F.col(f"_known{i}"), kind).alias(f"_converted{i}") for i, (_, kind) in enumerate(kinds)]
    return df.select(*by, *texts).select("*", *values)


def coercion_report(df: DataFrame, kinds: T.StructType) -> DataFrame:
    """Per column: values known as text, and how many of those do not convert."""
    return schema_drift(df, [], kinds)


def compare_schemas(tables: dict[str, DataFrame]) -> DataFrame:
    """Column types by data set, with a flag where they differ. Reads schemas only, no data."""
    cells = [(name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema.fields]
    spark = next(iter(tables.values())).sparkSession
    wide = spark.createDataFrame(cells, "dataset string, column string, type string").groupBy("column").pivot(
        "dataset", sorted(tables)
    ).agg(F.first("type"))
    seen = F.array_distinct(F.array(*[F.coalesce(F.col(f"`{t}`"), F.lit("absent")) for t in sorted(tables)]))
    return wide.withColumn("mismatch", F.size(seen) > 1)
