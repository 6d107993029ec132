"""Relations between pairs of numeric columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ontime.functions.stats import equal_width_bin, intercept, pearson, slope
from ontime.functions.values import real
from ontime.operators.profile import long_rows, bounds
from ontime.schema import numeric_columns


def correlations(df: DataFrame, columns: list[str] | None = None, nulls: str = "zero") -> DataFrame:
    """The Pearson matrix in long form (col_x, col_y, corr); null where a column is constant.

    ``nulls="zero"`` counts missing values as zero; ``"pairwise"`` uses the rows where both are known. Each batch of rows becomes one
    small row of cross products, around a centre near the data; these are added up. Nothing runs before the result is used.
    """
    columns = columns or numeric_columns(df.schema)
    if nulls not in ("zero", "pairwise"):
        raise ValueError(f"unknown null rule {nulls!r}")
    k = len(columns)
    filled = nulls == "zero"
    values = df.select(*[(F.coalesce(real(c), F.lit(0.0)) if filled else real(c)).alias(f"c{i}") for i, c in enumerate(columns)])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each pair: rows with both, their means, and the centred sums of squares and products; merged batch by batch."""
        n, mx, my, xx, yy, xy = (np.zeros((k, k)) for _ in range(6))
        for batch in batches:
            if not batch.num_rows:
                continue
            data = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            here = ~np.isnan(data)
            mask = here.astype(np.float64)
            # Around the batch's own means, so that large values do not swallow small differences.
            centre = np.where(here.any(0), np.nansum(data, 0) / np.maximum(here.sum(0), 1), 0.0)
            data = np.where(here, data - centre, 0.0)
            m, sx, sy = mask.T @ mask, data.T @ mask, mask.T @ data
            many = np.maximum(m, 1)
            ax, ay = sx / many, sy / many
            bxx = (data * data).T @ mask - sx * ax
            byy = mask.T @ (data * data) - sy * ay
            bxy = data.T @ data - sx * ay
            ax, ay = ax + centre[:, None], ay + centre[None, :]
            # Two parts with their means and centred sums become one (Chan, Golub and LeVeque).
            both = np.maximum(n + m, 1)
            dx, dy, w = ax - mx, ay - my, n * m / both
            xx, yy, xy = xx + bxx + dx * dx * w, yy + byy + dy * dy * w, xy + bxy + dx * dy * w
            mx, my, n = mx + dx * m / both, my + dy * m / both, n + m
        if n.any():
            cells = [pa.array([x.ravel().tolist()], pa.list_(pa.float64())) for x in (n, mx, my, xx, yy, xy)]
            yield pa.RecordBatch.from_arrays(cells, names=_PARTS)

    parts = values.mapInArrow(products, ", ".join(f"{p} array<double>" for p in _PARTS))
    # One row for each partition and pair, added up map-side in the same way, in plain sums around a common centre.
    at = F.posexplode(F.arrays_zip(*_PARTS)).alias("p", "s")
    cells = parts.select(at).select("p", "s.*").filter("n > 0")
    centre = Window.partitionBy("p")
    total = F.sum("n").over(centre)
    cells = cells.withColumns({"gx": F.sum(F.col("mx") * F.col("n")).over(centre) / total, "gy": F.sum(F.col("my") * F.col("n")).over(centre) / total})
    dx, dy = F.col("mx") - F.col("gx"), F.col("my") - F.col("gy")
    sums = cells.groupBy("p").agg(
        F.sum(F.col("xx") + F.col("n") * dx * dx).alias("xx"), F.sum(F.col("yy") + F.col("n") * dy * dy).alias("yy"),
        F.sum(F.col("xy") + F.col("n") * dx * dy).alias("xy"), F.sum("n").alias("n"), F.max(F.greatest(F.abs("gx"), F.abs("gy"))).alias("size"),
    )
    # A constant column leaves only rounding in its sum of squares.
    noise = F.col("n") * F.pow(F.col("size") * 1e-14, F.lit(2.0))
    spread = (F.col("xx") > noise) & (F.col("yy") > noise)
    corr = F.when(spread, F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")))
    names = F.array(*[F.lit(c) for c in columns])
    x, y = F.get(names, F.floor(F.col("p") / k).cast("int")), F.get(names, F.col("p") % k)
    return sums.select(x.alias("col_x"), y.alias("col_y"), F.when(corr.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr))).alias("corr"))


_PARTS = ["n", "mx", "my", "xx", "yy", "xy"]

#: Rows whose cross products become one set of partial sums.
_CHUNK = 1 << 16
_SUMS = ["n", "sx", "sy", "xx", "yy", "xy"]


def correlations_tiled(df: DataFrame, columns: list[str] | None = None, nulls: str = "zero", tile: int = 64) -> DataFrame:
    """The same matrix for thousands of columns: blocks of ``tile`` columns, and for each pair of blocks partial sums of their own.

    A first pass gives the means, which become the common centre. A task then holds the rows of a chunk and the sums of one pair of
    blocks; each pair's sums leave it at once and are added up in the aggregate that follows, map-side first, which may spill. Only pairs
    of blocks on and above the diagonal are worked out; the others are their mirror image.
    """
    columns = columns or numeric_columns(df.schema)
    if nulls not in ("zero", "pairwise"):
        raise ValueError(f"unknown null rule {nulls!r}")
    filled = nulls == "zero"
    values = df.select(*[(F.coalesce(real(c), F.lit(0.0)) if filled else real(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    k = len(columns)
    centre = np.zeros(k)
    # One number a column; a column at a time in the aggregate's tall form would not gain anything here.
    for at in range(0, k, 256):
        part = range(at, min(k, at + 256))
        means = values.agg(*[F.avg(f"c{i}") for i in part]).first()
        centre[list(part)] = [m if m is not None and np.isfinite(m) else 0.0 for m in means]

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in _chunks(batches, _CHUNK):
            here = ~np.isnan(data)
            data = np.where(here, data - centre, 0.0)
            mask = here.astype(np.float64)
            for a in range(0, k, tile):
                x, mx = data[:, a : a + tile], mask[:, a : a + tile]
                for b in range(a, k, tile):
                    y, my = data[:, b : b + tile], mask[:, b : b + tile]
                    sums = mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y
                    i, j = np.indices(sums[0].shape)
                    keep = (sums[0] > 0) & (i + a <= j + b)
                    index = [pa.array((part[keep] + at).astype(np.int32)) for part, at in ((i, a), (j, b))]
                    yield pa.RecordBatch.from_arrays(index + [pa.array(s[keep]) for s in sums], names=["i", "j", *_SUMS])

    parts = values.mapInArrow(tiles, "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS))
    sums = parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])
    n = F.col("n")
    xx, yy, xy = F.col("xx") - F.col("sx") * F.col("sx") / n, F.col("yy") - F.col("sy") * F.col("sy") / n, F.col("xy") - F.col("sx") * F.col("sy") / n
    middle = F.array(*[F.lit(float(c)) for c in centre])
    # A constant column leaves only rounding in its sum of squares.
    noise = n * F.pow(F.greatest(F.abs(F.get(middle, F.col("i"))), F.abs(F.get(middle, F.col("j")))) * 1e-14, F.lit(2.0))
    corr = F.when((xx > noise) & (yy > noise), xy / F.sqrt(xx) / F.sqrt(yy))
    limited = F.when(corr.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr))).alias("corr")
    names = F.array(*[F.lit(c) for c in columns])
    half = sums.select(F.get(names, F.col("i")).alias("one"), F.get(names, F.col("j")).alias("two"), limited)
    cell = lambda x, y: F.struct(F.col(x).alias("col_x"), F.col(y).alias("col_y"), F.col("corr"))
    mirrored = F.when(F.col("one") == F.col("two"), F.array(cell("one", "two"))).otherwise(F.array(cell("one", "two"), cell("two", "one")))
    return half.select(F.inline(mirrored))


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    """The batches' columns side by side, in blocks of up to about ``rows`` rows."""
    kept, n = [], 0
    for batch in batches:
        if batch.num_rows:
            kept.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]))
            n += batch.num_rows
        if n >= rows:
            yield np.concatenate(kept)
            kept, n = [], 0
    if kept:
        yield np.concatenate(kept)


def strongest(matrix: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` pairs with the largest absolute correlation, each pair once."""
    return (
        matrix.filter("col_x < col_y AND corr IS NOT NULL")
        .select("col_x", "col_y", F.abs("corr").alias("abs_corr"))
        .orderBy(F.desc(F.round("abs_corr", 9)), "col_x", "col_y")
        .limit(n)
    )


def pair_density(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """Row counts on a bins x bins grid over the pairs where both values are known."""
    known = df.select(real(x).alias(x), real(y).alias(y)).filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    bounded = known.withColumn("_b", bounds(known, [x, y]))

    def place(i: int, c: str) -> Column:
        lo, hi = F.get(F.col("_b.lo"), F.lit(i)), F.get(F.col("_b.hi"), F.lit(i))
        return equal_width_bin(F.col(c), lo, hi, bins)

    cells = bounded.select(place(0, x).alias("x_bin"), place(1, y).alias("y_bin"))
    return cells.groupBy("x_bin", "y_bin").agg(F.count("*").alias("n"))


def pair_fits(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Least-squares line, correlation and number of known pairs, for all pairs in one scan."""
    rows = []
    for x, y in pairs:
        cx, cy = real(x), real(y)
        rows.append(
            [
                F.lit(x).alias("x"),
                F.lit(y).alias("y"),
                F.count_if(cx.isNotNull() & cy.isNotNull()).alias("n"),
                slope(cx, cy).alias("slope"),
                intercept(cx, cy).alias("intercept"),
                pearson(cx, cy).alias("corr"),
            ]
        )
    return long_rows(df, [], rows)
