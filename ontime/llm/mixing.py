"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in an order fixed by hash, are cut into blocks of equal size. Its weight is a whole number of parts, and all parts
together make one period of slots. Block i of a source with weight w may not come before floor((i - 1) / w) and must come
before ceil(i / w); in each slot the released block with the earliest deadline goes next. So after any number of slots, every
source is less than one block away from its share, until one of them runs out; the slots it would have had then stay empty.

The schedule repeats after each period, so it is worked out once for the parts (as many steps as there are parts, which grow
with the number of sources only), and each document finds its slot by arithmetic. Positions inside a source come from totals of hashed slices and a
running sum inside each slice; a source of any size is spread over many tasks.

Cases: a null source is a source of its own. Null or empty texts have size 0 and stay with the document before them. A document
longer than a block takes the slot in which it starts. Repeated rows are each placed. An empty table gives an empty table; columns of the
input stay, and a name in use gets an underscore. No document is dropped or repeated.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ontime.llm.quality import spare_name

#: Parts of all weights together: one period of the schedule, at least.
PARTS = 10_000
#: Parts for each source, at least: the period grows with the sources, so that the one part each has first stays a small share.
PARTS_A_SOURCE = 16
#: Characters in a block.
BLOCK = 100_000
#: Rows in a slice, on average.
SLICE_ROWS = 20_000
#: Slices at least, so that a hot source is spread however small the table.
SLICES = 256


def source_key(source: Column) -> Column:
    """Never null, and different for null and any text."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def whole_parts(weights: dict[str, float], parts: int = PARTS) -> dict[str, int]:
    """Weights as whole parts, one at least each, by largest remainder."""
    if len(weights) > parts:
        raise ValueError(f"{len(weights)} sources need at least as many parts; {parts} given")
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be above 0")
    spare, total = parts - len(weights), sum(weights.values())
    exact = {k: spare * w / total for k, w in weights.items()}
    out = {k: 1 + int(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))[: parts - sum(out.values())]:
        out[k] += 1
    return out


def tempered_weights(df: DataFrame, source: str, size: Column, exponent: float = 0.5, parts: int = PARTS) -> dict[str, int]:
    """Parts in proportion to size ** exponent, so that large sources are held back; more parts for many sources. One row per source reaches the driver."""
    sizes = df.groupBy(source_key(F.col(f"`{source}`")).alias("k")).agg(F.sum(size).alias("n")).collect()
    return whole_parts({r.k: max(r.n or 0, 1) ** exponent for r in sizes}, max(parts, PARTS_A_SOURCE * len(sizes))) if sizes else {}


def period(parts: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source in one period: earliest deadline first among released blocks."""
    total = sum(parts.values())
    slots: dict[str, list[int]] = {k: [] for k in parts}
    waiting, ready = [(0, k) for k in sorted(parts)], []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[k]) + 1) * total // parts[k]), k))
        _, k = heapq.heappop(ready)
        slots[k].append(t)
        if len(slots[k]) < parts[k]:
            heapq.heappush(waiting, (len(slots[k]) * total // parts[k], k))
    return slots


def _schedule(spark: SparkSession, parts: dict[str, int]) -> DataFrame:
    """One row per source. Its size is known to Spark, which then decides whether to broadcast it."""
    slots = period(parts)
    columns = {"key": pa.array(list(slots), pa.string()), "slots": pa.array(list(slots.values()), pa.list_(pa.int32()))}
    return spark.createDataFrame(pa.table(columns))


def interleave(df: DataFrame, parts: dict[str, int], source: str, size: Column, order: list[str], block: int = BLOCK) -> DataFrame:
    """The table with two more columns: the block of its source that each row is in, and that block's slot in the mixture."""
    spark, total = df.sparkSession, sum(parts.values())
    slices = max(SLICES, df.count() // SLICE_ROWS)
    block_name, slot_name = spare_name(df, "block"), spare_name(df, "slot")
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in order])
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), source_key(F.col(f"`{source}`")).alias("key"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), mixed.alias("h"))
    rows = rows.withColumn("slice", F.pmod("h", F.lit(slices)).cast("int"))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("key", "slice").agg(F.sum("size").alias("n")).select("key", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    keys = [F.col("row")[c] for c in order]
    inside = Window.partitionBy("key", "slice").orderBy("h", *keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["key", "slice"])
    placed = placed.withColumn("block", F.floor((F.col("offset") + F.col("inner")) / block)).join(_schedule(spark, parts), "key")
    turns = F.size("slots")
    slot = F.floor(F.col("block") / turns) * total + F.element_at("slots", (F.col("block") % turns + 1).cast("int"))
    return placed.select("row.*", F.col("block").cast("long").alias(block_name), slot.cast("long").alias(slot_name))


def in_order(df: DataFrame, slot: str, order: list[str]) -> DataFrame:
    """Rows in the order of the mixture: ranges of slots, each sorted."""
    return df.repartitionByRange(slot, *order).sortWithinPartitions(slot, *order)
