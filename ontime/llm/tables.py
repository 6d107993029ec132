"""Stored intermediate tables, bounded samples, groups in sorted streams, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ontime.session import fresh_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written as Parquet under the shared work folder and read again: cuts the lineage, survives lost executors, and tells
    Spark the true size, by which it chooses between broadcast and shuffle."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About nine tenths of ``rows`` distinct rows, and never more, picked by hash; all of them when there are fewer.

    A count sets the share of hash values to take, so that no task sends on more than its part of the sample. Copies count once
    in the sample, however many there are of a picked one.
    """
    n = df.count()
    if n > rows:
        span = 1 << 31
        df = df.where(F.pmod(F.xxhash64(key), F.lit(span)) < int(0.9 * rows / n * span))
    return df.distinct().limit(rows)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows with equal keys, one at a time, from batches sorted by the keys. A group may span batches."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            values = c.to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        first = tuple(c[0].as_py() for c in columns)
        change[0] = last is not None and first != last
        cuts = np.flatnonzero(change).tolist()
        at = 0
        for cut in cuts:
            if cut > at:
                kept.append(batch.slice(at, cut - at))
            if kept:
                yield pa.Table.from_batches(kept)
            kept, at = [], cut
        kept.append(batch.slice(at))
        last = tuple(c[-1].as_py() for c in columns)
    if kept:
        yield pa.Table.from_batches(kept)


def components(edges: DataFrame, a: str, b: str, label: str = "component") -> DataFrame:
    """(id, component) for every end of an edge; the component is the smallest id reachable.

    Large stars and small stars in turn (Kiveris et al. 2014): each is a grouped minimum and a join, so a vertex of any
    degree is only counted, never gathered, and few rounds suffice. The driver sees two numbers for each round.
    """
    u, v = F.col("u"), F.col("v")
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(u != v).distinct()
    now = stored(now, label)
    state = None
    while True:
        both = now.union(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(v.alias("u"), F.col("m").alias("v")).where(u != v).union(least)
        now = stored(small.distinct(), label)
        before, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
    return now.select(u.alias("id"), v.alias("component")).union(now.select(v.alias("id"), v.alias("component")).distinct())
