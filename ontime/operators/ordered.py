"""Exact running totals, ranks and quantiles in which no group has to fit one task.

Rows are range-partitioned on (group, order), so a group that holds most of the data is spread over
many slices. Totals per slice are tiny; a running sum over them gives every slice its starting
offset, and the rest is a running sum inside each slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ontime.functions.values import FLOATS, real
from ontime.schema import exact_columns
from ontime.session import kept_parts


def _columns(names: list[str]) -> list[Column]:
    return [F.col(n) for n in names]


def _comparable(value):
    """A group key as Spark groups by it: NaN equals NaN."""
    return ("NaN",) if value != value else value


def _running(sums: list[str], by: list[str], names: list[str]):
    """For a sorted slice: each row's sums over the earlier rows of its group in this slice, as ``_<s>_inner``; and, marked by
    ``_part`` 1, a row with the sums of each group of each batch."""

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, {s: 0 for s in sums}
        for batch in batches:
            if not batch.num_rows:
                continue
            begins = np.zeros(batch.num_rows, bool)
            for c in by:
                codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                begins[1:] |= codes[1:] != codes[:-1]
            first, end = (tuple(_comparable(batch.column(c)[i].as_py()) for c in by) for i in (0, batch.num_rows - 1))
            goes_on = last == first
            begins[0] = True
            starts = np.flatnonzero(begins)
            group = np.cumsum(begins) - 1
            inner, totals = [], {}
            for s in sums:
                values = batch.column(s).fill_null(0).to_numpy(zero_copy_only=False)
                before = np.cumsum(values) - values
                own = before - before[starts][group]
                totals[s] = pa.array(np.add.reduceat(values, starts), batch.column(s).type)
                if goes_on:
                    own[group == 0] += carried[s]
                carried[s] = own[-1] + values[-1]
                inner.append(pa.array(own, batch.column(s).type))
            last = end
            one = lambda n, part: pa.array(np.full(n, part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, *inner, one(batch.num_rows, 0)], names=names)
            heads = batch.take(pa.array(starts))
            cells = [totals.get(n, heads.column(n) if n in by or n == "_slice" else pa.nulls(len(starts), heads.column(n).type)) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*cells, *totals.values(), one(len(starts), 1)], names=names)

    return walked


def running_totals(
    df: DataFrame, by: list[str], order: list[Column], sums: list[str], ranged: int | None = None
) -> DataFrame:
    """Add ``<s>_before`` (sum over earlier rows of the group) and ``<s>_total`` for every column in ``sums``.

    ``order`` must be unique inside a group, so aggregate equal values first; the sums are of whole numbers. Rows are shuffled once, by range.
    One job keeps the slices in the shared work folder, with the running sums inside each, and beside them the few totals by slice and
    group: slice bounds come from a sample, and all uses below must see the same ones. Then each slice only needs the totals of those before it.
    """
    keys = _columns(by) + order
    # Spark groups by a negative zero as by zero.
    df = df.withColumns({f.name: F.col(f.name) + F.lit(0).cast(f.dataType) for f in df.schema.fields if f.name in by and isinstance(f.dataType, FLOATS)})
    df = df.withColumns({s: F.coalesce(F.col(s).cast("bigint"), F.lit(0)) for s in sums})
    sliced = df.repartitionByRange(ranged, *keys) if ranged else df.repartitionByRange(*keys)
    sliced = sliced.withColumn("_slice", F.spark_partition_id()).sortWithinPartitions(*keys)
    loose = [T.StructField(f.name, f.dataType) for f in sliced.schema.fields]
    layout = T.StructType(loose + [T.StructField(f"_{s}_inner", T.LongType()) for s in sums] + [T.StructField("_part", T.IntegerType())])
    parts = sliced.mapInArrow(_running(sums, by, layout.names), layout)
    sliced, totals = kept_parts(parts, "_part", 2, "slices")

    # A group spans at most as many slices as there are partitions. Spark knows how small the stored totals are, and moves them
    # instead of the rows.
    per_slice = totals.groupBy(*by, "_slice").agg(*[F.sum(s).alias(s) for s in sums])
    in_group = Window.partitionBy(*by) if by else Window.partitionBy()
    earlier_slices = in_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)],
        F.col("_slice").alias("_s"),
        *[F.coalesce(F.sum(s).over(earlier_slices), F.lit(0)).alias(f"_{s}_offset") for s in sums],
        *[F.sum(s).over(in_group).alias(f"{s}_total") for s in sums],
    )

    same = F.col("_slice") == F.col("_s")
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return sliced.join(offsets, same).select(
        *df.columns,
        *[(F.col(f"_{s}_offset") + F.col(f"_{s}_inner")).alias(f"{s}_before") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
    )


def value_ranks(df: DataFrame, by: list[str], value: str, ranged: int | None = None) -> DataFrame:
    """Each distinct value per group with its row count ``n`` and, over known values, running counts.

    A null value stays as a row with ``known`` 0, so groups without any known value are not lost.
    Counting equal values first happens map-side: a hot group shrinks before any shuffle.
    """
    # In its own type: a double would merge large whole numbers and decimals.
    exact = value in exact_columns(df.schema)
    df = df.select(*by, (F.col(value) if exact else real(value)).alias(value))
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"), F.count(value).alias("known"))
    return running_totals(counts, by, [F.col(value)], ["known"], ranged)


def pick_quantiles(ranks: DataFrame, by: list[str], value: str, wanted: dict[str, float], *extra: Column) -> DataFrame:
    """Linearly interpolated quantiles per group out of ``value_ranks`` rows."""

    def at(rank: Column) -> Column:
        inside = (F.col("known_before") <= rank) & (rank < F.col("known_before") + F.col("known"))
        return F.max(F.when(inside, F.col(value)))

    picks, finals = [], []
    for name, p in wanted.items():
        place = F.lit(float(p)) * (F.col("known_total") - 1)
        picks += [at(F.floor(place)).alias(f"_{name}_lo"), at(F.ceil(place)).alias(f"_{name}_hi")]
        picks.append(F.max(place - F.floor(place)).alias(f"_{name}_part"))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        finals.append((lo + (hi - lo) * F.col(f"_{name}_part")).alias(name))
    picked = ranks.groupBy(*by).agg(*picks, *extra)
    added = [c for c in picked.columns if c not in by and not c.startswith("_")]
    return picked.select(*by, *finals, *added)


def grouped_quantiles(
    df: DataFrame, by: list[str], value: str, wanted: dict[str, float], exact: bool = True, accuracy: int = 10000
) -> DataFrame:
    """Quantiles per group; ``exact=False`` takes one pass with a bounded sketch."""
    if exact:
        return pick_quantiles(value_ranks(df, by, value), by, value, wanted)
    return df.groupBy(*by).agg(*[F.percentile_approx(real(value), p, accuracy).alias(n) for n, p in wanted.items()])


def positions(df: DataFrame, by: list[str], order: list[Column], ranged: int | None = None) -> DataFrame:
    """Add ``position``: the row number from 0 inside the group, in an order unique within it."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(ones, by, order, ["_one"], ranged)
    return ranked.select(*df.columns, F.col("_one_before").alias("position"))
