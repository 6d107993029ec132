"""Quantile and distinct sketches as a table of states: one row a group, merged instead of scanning the rows again.

A state has a fixed size whatever the number of rows, and states of any groups can be merged, so a store by (year, carrier) answers by
carrier, by year or overall. Building is one aggregate whose states combine before the shuffle; a year that comes later is read alone and
added as one more folder.

Cases: NaN is missing, as everywhere. A group without known values has a count of 0 and null quantiles. Null group keys are a
group. Adding a year again replaces it, so a repeated or broken-off run changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime.functions.values import known, real

#: Size parameters: entries of the quantile sketch's top level, and the logarithm of the distinct sketch's registers.
QUANTILE_SIZE = 400
DISTINCT_LOG = 12
YEAR = "year"


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far the rank of a returned quantile may be off, as a share of all rows, in 99 of 100 cases (fixed values: the
    constants published with the sketch)."""
    return 2.296 / size**0.9021


def distinct_error(log: int = DISTINCT_LOG) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / 2 ** (log / 2)


def states(df: DataFrame, by: list[str], measures: list[str], values: list[str], size: int = QUANTILE_SIZE, log: int = DISTINCT_LOG) -> DataFrame:
    """Per group: rows, known values and a quantile state of each measure, and a distinct state of each value column."""
    cells = [F.count("*").alias("n")]
    for m in measures:
        cells += [F.count(real(m)).alias(f"{m}_known"), F.kll_sketch_agg_double(real(m), F.lit(size)).alias(f"{m}_quantiles")]
    cells += [F.hll_sketch_agg(known(df.schema[v]).cast("string"), F.lit(log)).alias(f"{v}_distinct") for v in values]
    return df.groupBy(*by).agg(*cells)


def quantiles(stored: DataFrame, by: list[str], measure: str, wanted: dict[str, float]) -> DataFrame:
    """Known rows and quantiles of a measure per group, out of stored states."""
    # An empty state has no quantile, and asking it for one is an error.
    some = F.when(F.col(f"{measure}_known") > 0, F.col(f"{measure}_quantiles"))
    merged = stored.groupBy(*by).agg(F.sum(f"{measure}_known").alias("n_known"), F.kll_merge_agg_double(some).alias("_state"))
    found = [F.when(F.col("n_known") > 0, F.kll_sketch_get_quantile_double("_state", F.lit(float(p)))).alias(n) for n, p in wanted.items()]
    return merged.select(*by, "n_known", *found)


def distinct(stored: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Estimated distinct known values per column and group."""
    merged = stored.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_distinct")).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in columns])
    return merged.select(*by, F.inline(cells))


@dataclass(frozen=True)
class Store:
    """States by year and further columns, as a year-partitioned Parquet table."""

    path: str
    by: list[str] = field(default_factory=list)
    measures: list[str] = field(default_factory=list)
    values: list[str] = field(default_factory=list)
    size: int = QUANTILE_SIZE
    log: int = DISTINCT_LOG

    def years(self, spark: SparkSession) -> set[int]:
        """Years the store has, by its folders."""
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return set()
        names = (s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())
        return {int(n.split("=", 1)[1]) for n in names if n.startswith(f"{YEAR}=")}

    def add(self, spark: SparkSession, years: list[int], read: Callable[[list[int]], DataFrame], again: bool = False) -> list[int]:
        """Add the years that are missing (with ``again``: all of them), and say which. ``read`` gives the rows of some years,
        with their year, and is asked for the missing ones only."""
        wanted = sorted(set(years) if again else set(years) - self.years(spark))
        if wanted:
            rows = read(wanted)
            built = states(rows, [YEAR, *self.by], self.measures, self.values, self.size, self.log)
            # Only the folders of these years are replaced.
            built.write.partitionBy(YEAR).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return wanted

    def read(self, spark: SparkSession, like: T.StructType) -> DataFrame:
        """The states; ``like`` gives the group columns their types."""
        fields = [*(like[b] for b in self.by), T.StructField("n", T.LongType())]
        for m in self.measures:
            fields += [T.StructField(f"{m}_known", T.LongType()), T.StructField(f"{m}_quantiles", T.BinaryType())]
        fields += [T.StructField(f"{v}_distinct", T.BinaryType()) for v in self.values]
        return spark.read.schema(T.StructType([*fields, T.StructField(YEAR, T.IntegerType())])).parquet(self.path)
