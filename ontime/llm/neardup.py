"""Near-duplicate vectors by collision-counting projections.

Vectors are compared only inside a group (equal, known label and equal length). For two unit vectors at the wanted cosine, their values
on a random line differ by a normal variable of known width; so the chance to fall into a window around the other is known. Of many
such lines, the number of windows in which a pair collides must reach a count calibrated so that a pair at the wanted cosine passes with
probability PASS; only pairs that pass are verified, by cosine in double precision. Lines are sorted and windows
centred on each vector; a pair leaves as soon as it has missed too many windows.

So that not all pairs of a group meet, further lines cut into cells send vectors to buckets: the larger the group, the more lines
a bucket needs, and the more tables of buckets there are, again so that a pair at the wanted cosine shares one with probability
PASS. Buckets are cut into tiles of bounded size. Recall is about PASS ** 2 at the limit, higher above it; no bucket or group is capped.

Cases: equal vectors of a group are one vector with a multiplicity, and link with each other. Vectors that are null, empty, zero, or hold
null or non-finite components, and those without a label, link with nothing. Vectors of different length never link. Rows with equal ids are each counted;
a component takes the smallest id in it, null ids last. Extra columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ontime.llm.tables import components, runs, stored

#: Lines on which collisions are counted.
LINES = 32
#: Half a window, and the width of a cell, in standard deviations of a pair's difference at the wanted cosine.
WINDOW = 2.0
CELL = 4.0
#: Half the first window, in the same deviations: wide enough that a pair outside it is no pair (1 in 15,000 at the limit).
START = 4.0
#: Chance that a pair at the wanted cosine shares a bucket, and that it reaches the count.
PASS = 0.9995
#: Vectors that a bucket should hold, about, and most rows of one side of a tile, about.
BUCKET_ROWS = 500
TILE_ROWS = 1000


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def cell_chance(ratio: float) -> float:
    """Chance that two values share a randomly placed cell ``ratio`` times as wide as the deviation of their difference."""
    return 1 - 2 * _normal(-ratio) - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-(ratio**2) / 2))


def least_count(lines: int = LINES, window: float = WINDOW, chance: float = PASS) -> int:
    """The largest count that a binomial number of collisions reaches with the wanted chance."""
    hit = 2 * _normal(window) - 1
    reached = 0.0
    for count in range(lines, -1, -1):
        reached += math.comb(lines, count) * hit**count * (1 - hit) ** (lines - count)
        if reached >= chance:
            return count
    return 0


def spread(cosine: float) -> float:
    """Standard deviation of the difference, on a line of normal entries, of two unit vectors at this cosine."""
    return math.sqrt(2 - 2 * cosine)


def tables_for(depth: int) -> int:
    """Tables of buckets from ``depth`` lines that give a pair the wanted chance to share one."""
    return 1 if not depth else math.ceil(math.log(1 - PASS) / math.log(1 - cell_chance(CELL) ** depth))


def depth_for(n: Column, cosine: float) -> Column:
    """Lines for each bucket, by the size of the group: unrelated vectors are a right angle apart."""
    apart = cell_chance(CELL * spread(cosine) / math.sqrt(2))
    return F.greatest(F.lit(0), F.ceil(F.log(n / BUCKET_ROWS) / -math.log(apart))).cast("int")


def _unit(cells: list) -> np.ndarray:
    rows = np.array(cells, np.float64)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _buckets(vectors: DataFrame, cosine: float, seed: int) -> DataFrame:
    """One row for each vector, with its bucket in every table."""
    width = CELL * spread(cosine)

    def placed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            vector, depth = batch.column("vector").to_pylist(), batch.column("depth").to_numpy()
            size = np.array([len(v) for v in vector], np.int64)
            out: list = [None] * len(vector)
            for length, k in sorted(set(zip(size.tolist(), depth.tolist()))):
                mine = np.flatnonzero((size == length) & (depth == k))
                tables = tables_for(k)
                rng = np.random.default_rng([seed, 1, length, k])
                lines = rng.standard_normal((length, tables * k))
                cells = np.floor((_unit([vector[i] for i in mine]) @ lines) / width + rng.random(tables * k)).astype(np.int64)
                code = np.zeros((len(mine), tables), np.uint64)
                for j in range(k):
                    code = (code ^ cells[:, j::k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    code ^= code >> np.uint64(29)
                for i, row in zip(mine, code.view(np.int64)):
                    out[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names[:-1], "buckets"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields if f.name != "depth")
    return vectors.mapInArrow(placed, schema + ", buckets array<long>")


def _passing(values: np.ndarray, side: np.ndarray, window: float, start: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (i, j) that collide on enough lines. With two sides, only pairs across them.

    The first line is sorted and searched in wide windows around each row; collisions are then counted on all lines.
    """
    first = np.argsort(values[:, 0], kind="stable")
    line = values[first, 0]
    until = np.searchsorted(line, line + start, side="right")
    found_i, found_j = [], []
    at = 0
    across = side.any()
    while at < len(line):
        # As many window centres at a time as give a bounded number of pairs.
        sizes = until[at:] - np.arange(at + 1, len(line) + 1)
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes), 1 << 20, side="right")))
        sizes = sizes[: end - at]
        i = np.repeat(np.arange(at, end), sizes)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        i, j = first[i], first[j]
        if across:
            use = side[i] != side[j]
            i, j = i[use], j[use]
        missed = np.zeros(len(i), np.int16)
        for k in range(values.shape[1]):
            missed += np.abs(values[i, k] - values[j, k]) > window
            use = missed <= values.shape[1] - count
            if not use.all():
                i, j, missed = i[use], j[use], missed[use]
        found_i.append(i)
        found_j.append(j)
        at = end
    return np.concatenate(found_i), np.concatenate(found_j)


def _smallest_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of each of n rows, the first row reachable by the pairs."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def _links(vectors: DataFrame, cosine: float, seed: int) -> DataFrame:
    """(node, links, other): links counted for a node in one tile, with multiplicity, and one node that it links with, if any."""
    rows = vectors.select("node", "kind", "times", "vector", "buckets", F.posexplode("buckets").alias("table", "bucket"))
    keys = ["kind", "table", "bucket"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys, F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("cuts"))
    cut = rows.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    # A row of part p meets parts p.. as the first side, and parts up to p as the second.
    tiles = cut.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    tiles = tiles.withColumns({"low": F.least("part", "tile"), "high": F.greatest("part", "tile"), "side": (F.col("part") > F.col("tile")).cast("int")})
    window, start, count = WINDOW * spread(cosine), START * spread(cosine), least_count()

    def compared(batches: Iterator[pa.RecordBatch]):
        lines: dict[int, np.ndarray] = {}
        layout = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])
        for tile in runs(batches, [*keys, "low", "high"]):
            if tile.num_rows < 2:
                continue
            vector = tile.column("vector").to_pylist()
            length = len(vector[0])
            if length not in lines:
                lines[length] = np.random.default_rng([seed, 2, length]).standard_normal((length, LINES))
            raw = np.array(vector, np.float64)
            norm = np.sqrt((raw * raw).sum(1))
            side = tile.column("side").to_numpy()
            i, j = _passing((raw / norm[:, None]) @ lines[length], side, window, start, count)
            near = [(raw[i[a : a + 65536]] * raw[j[a : a + 65536]]).sum(1) / (norm[i[a : a + 65536]] * norm[j[a : a + 65536]]) >= cosine for a in range(0, len(i), 65536)]
            use = np.concatenate(near) if near else np.zeros(0, bool)
            i, j = i[use], j[use]
            if not len(i):
                continue
            # A pair is counted in the first table in which it shares a bucket.
            buckets = np.array(tile.column("buckets").to_pylist(), np.int64)
            first = np.concatenate([(buckets[i[a : a + 65536]] == buckets[j[a : a + 65536]]).argmax(1) for a in range(0, len(i), 65536)])
            use = first == tile.column("table")[0].as_py()
            i, j = i[use], j[use]
            times, node = tile.column("times").to_numpy(), tile.column("node").to_numpy()
            degree = np.zeros(len(node), np.int64)
            np.add.at(degree, i, times[j])
            np.add.at(degree, j, times[i])
            has = np.flatnonzero(degree)
            yield pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(degree[has]), pa.array(node[_smallest_reachable(len(node), i, j)[has]])], schema=layout)

    columns = [*keys, "low", "high", "side", "node", "times", "vector", "buckets"]
    ordered = tiles.select(*columns).repartition(*keys, "low", "high").sortWithinPartitions(*keys, "low", "high")
    return ordered.mapInArrow(compared, "node long, links long, other long")


def classes(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98, seed: int = 7) -> DataFrame:
    """(id, n_links, component_id) for each row."""
    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.col(f"`{label}`").cast("string").alias("label"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    # Divided by the largest component first, so that squares neither overflow nor vanish.
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    usable = F.col("label").isNotNull() & F.coalesce(F.forall("vector", finite) & (largest > 0), F.lit(False))
    scaled = F.when(usable, F.transform("vector", lambda x: x / largest))
    kind = F.when(usable, F.concat_ws("/", F.size("vector"), "label"))
    rows = rows.select("id", F.col("vector"), kind.alias("kind"), scaled.alias("scaled"))

    # Equal vectors are grouped by all their components; the join back on them leaves a hot vector's rows where Spark can split them.
    same = ["kind", "vector"]
    place = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"))
    distinct = rows.where("kind IS NOT NULL").groupBy(*same).agg(F.count("*").alias("times"), F.min(place).alias("first"), F.first("scaled").alias("scaled"))
    distinct = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = distinct.groupBy("kind").agg(F.count("*").alias("n"))
    vectors = distinct.join(sizes, "kind").select("node", "kind", "times", F.col("scaled").alias("vector"), depth_for(F.col("n"), cosine).alias("depth"))
    found = stored(_links(_buckets(vectors, cosine, seed), cosine, seed), "vector-links")

    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.where("node != other"), "node", "other")
    parts = distinct.select("node", "kind", "vector", "times", "first").join(grouped.select(F.col("id").alias("node"), "component"), "node", "left").join(degrees, "node", "left")
    parts = parts.withColumn("component", F.coalesce("component", "node"))
    named = parts.groupBy("component").agg(F.min("first")["id"].alias("component_id"))
    parts = parts.join(named, "component").select(*same, "times", "links", "component_id")
    out = rows.select("id", *same).join(parts, same, "left")
    linked = F.col("times").isNotNull()
    n_links = F.when(linked, F.col("times") - 1 + F.coalesce("links", F.lit(0))).otherwise(0)
    return out.select("id", n_links.cast("long").alias("n_links"), F.when(linked, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
