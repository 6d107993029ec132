"""Near-duplicate texts by the Jaccard similarity of their word shingles, with count vectors in R-tree leaves.

Two texts link when 100 * |A & B| >= percent * |A | B|. The answer is exact up to 64-bit hashes of shingles:

1. Texts with equal sets are one: a fingerprint of the set (128 bits) is grouped, the smallest id stands for all.
2. The root level of the tree sends sets to leaves. Sets of similar size (a class) have at most D differing shingles if they link,
   so of more than D blocks of the hash range, one at least must hold the same shingles in both. A leaf is (class, block, content). Blocks empty
   in both would meet by chance; there are enough blocks that a pair with only such in common has more empty ones
   than ``spare`` allows, and only those sets are sent to the leaves of empty blocks as well.
3. Shingles are hashed into groups, and the group counts are a set's point. Two points survive only if the sum of smaller coordinates, an upper
   bound of the overlap, reaches the overlap that a link needs. Survivors are verified on whole sets.
4. In a leaf, each set is first held against the leaf's smallest id, then, where components remain apart, against its set of most links: as a rule the
   one that the others are copies of. What a leaf still holds of different components is packed into nodes in order of size and counts; pairs of nodes
   whose bounds allow a link are compared point by point.

Leaves and nodes are rows to join and sort, so that no leaf has to fit one task: a leaf's rows stream past its smallest id, and
nodes are cut to a bounded number of rows.

Cases: a null or empty text has no shingles and links with nothing. A text with fewer words than a shingle is one shingle. Rows with equal ids
are one document for links, and each keeps its own count. A null id links with nothing and has a null component. Extra columns
are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm import textblocks as B
from ontime.llm.tables import components, runs, stored
from ontime.operators.ordered import positions

#: Groups of a point at least; texts with more shingles have about as many groups as shingles, or half.
GROUPS = 64
#: Coordinates of a node's bounds: groups folded together.
FOLDED = 16
#: Rows of a node at most.
NODE_ROWS = 1024
#: Rows of a leaf that a task holds back to name the leaf after them.
LEAF_ROWS = 50_000
#: Binary logarithm of the bits in the map of candidates: 8 MB, which the driver gathers and sends out.
BITMAP_BITS = 26
#: Texts held against one other text in a task, about.
VERIFY_ROWS = 500

_U = np.uint64


# ---- sets --------------------------------------------------------------------------------------


def shingle_sets(block: B.Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted inside each row, and their rows."""
    start, end, row = block.words()
    hashes = block.hashes(B.lowered(block.data))
    word = B.Rolling(hashes.of(start, end))
    bounds = np.searchsorted(row, np.arange(block.rows + 1))
    sizes = np.diff(bounds)
    at = np.arange(len(start))
    at = at[at + width <= bounds[row + 1]] if len(start) else at
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    begin = np.concatenate((at, bounds[short]))
    values = word.of(begin, np.concatenate((at + width, bounds[short + 1])))
    rows = row[begin] if len(begin) else begin
    order = np.argsort(rows, kind="stable") if len(short) else slice(None)
    values, rows = values[order], rows[order]
    edges = np.searchsorted(rows, np.arange(block.rows + 1))
    for a, b in zip(edges[:-1], edges[1:]):
        values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[fresh], rows[fresh]


def _row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of the values of each row; rows ascend."""
    out = np.zeros(n, _U)
    if len(values):
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        out[rows[first]] = np.add.reduceat(values, first)
    return out


def _described(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    sizes = np.bincount(rows, minlength=n)
    prints = [_row_sums(B.mix(values ^ _U(salt)), rows, n).view(np.int64) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return sizes, *prints


def _points(values: np.ndarray, rows: np.ndarray, n: int) -> list[bytes]:
    """Each row's point: shingles counted by the low bits of their hashes, a byte for each group.

    With about as many groups as shingles nearly every difference of two sets shows. Most counts are 0 to 2, so cells are
    compressed. A row with a count above 255 gets an empty cell, which bounds nothing.
    """
    edges = np.searchsorted(rows, np.arange(n + 1))
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        groups = max(GROUPS, 1 << max(0, int(b - a).bit_length() - 1))
        counts = np.bincount((values[a:b] & _U(groups - 1)).astype(np.int64), minlength=groups)
        out.append(zlib.compress(counts.astype(np.uint8).tobytes(), 1) if counts.max(initial=0) <= 255 else b"")
    return out


def _opened(cell: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(cell), np.uint8) if cell else np.zeros(0, np.uint8)


def _folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """The point over fewer groups; one that bounds nothing is as large as can be."""
    if not len(counts):
        return np.full(groups, 1 << 30, np.int32)
    return counts.reshape(-1, groups).sum(0, dtype=np.int32)


def _bound(a: bytes, b: bytes) -> int:
    """No more shingles than this are shared: the sum of the smaller coordinates."""
    x, y = _opened(a), _opened(b)
    groups = min(len(x), len(y)) or GROUPS
    return int(np.minimum(_folded(x, groups), _folded(y, groups)).sum(dtype=np.int64))


class Classes:
    """Size classes, and for each the number of blocks that makes a link share one with content."""

    def __init__(self, percent: int):
        self.percent = percent
        # As narrow as lets a text link into the next class at most: wide classes have room for differences that small sets lack.
        ratio = 105 / percent
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1] + 1, int(lows[-1] * ratio)))
        self.lows = np.array(lows, np.int64)
        high = self.lows[1:] - 1
        self.differ = 2 * high * (100 - percent) // (100 + percent)
        # Any number gives right results; one that hashed sets seldom exceed sends few of them to leaves of empty blocks, where
        # unrelated sets meet. The smallest sets of a class, also of those that reach into it from below, have the most empty blocks:
        # as many as balls thrown at random leave, and rarely three deviations more.
        fewest = -(-percent * self.lows[:-1] // 100)
        blocks = self.differ + 1.0
        for _ in range(60):
            missed = np.exp(-fewest / blocks)
            empty = blocks * missed
            deviation = np.sqrt(empty * np.maximum(1 - (1 + fewest / blocks) * missed, 0))
            blocks = np.minimum(self.differ + 3 + np.ceil(empty + 3 * deviation), 3.0 * self.differ + 3)
        # At low percentages a class has more room for differences than its smallest sets have shingles; no number is enough there.
        enough = blocks < 2 * self.differ + 3
        self.spare = np.where(enough, blocks.astype(np.int64) - self.differ - 1, 2 + self.differ // 16)
        self.blocks = self.differ + 1 + self.spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, side="right") - 1

    def reaches_next(self, sizes: np.ndarray) -> np.ndarray:
        """True where a text of the next class can still link."""
        return 100 * sizes >= self.percent * self.lows[self.of(sizes) + 1]


def _leaf(kind: np.ndarray, block: np.ndarray, content: np.ndarray) -> np.ndarray:
    return B.mix(content + B.mix(kind.astype(_U) * _U(0x9E3779B97F4A7C15) + block.astype(_U)))


def leaves(values: np.ndarray, rows: np.ndarray, n: int, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Leaf of each block of each row's set, in its own class and, where that can link, the next; and the rows."""
    sizes = np.bincount(rows, minlength=n)
    out_leaf, out_row = [], []
    content = B.mix(values ^ _U(0xD1342543DE82EF95))
    for step in (0, 1):
        use = sizes > 0
        kind = np.where(use, classes.of(np.maximum(sizes, 1)) + step, 0)
        # Without room for a difference, only equal sets link, and those are one already.
        use &= classes.differ[kind] > 0
        if step:
            use &= classes.reaches_next(np.maximum(sizes, 1))
        mine = use[rows]
        r, v, c = rows[mine], values[mine], content[mine]
        if not len(r):
            continue
        total = classes.blocks[kind]
        # The top 32 bits, scaled to the number of blocks: ascends with the sorted values. Blocks number far below 2**32.
        block = ((v >> _U(32)) * total[r].astype(_U)) >> _U(32)
        first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (block[1:] != block[:-1]))))
        at_row, at_block = r[first], block[first]
        out_leaf.append(_leaf(kind[at_row], at_block, np.add.reduceat(c, first)))
        out_row.append(at_row)
        empty = total - np.bincount(at_row, minlength=n)
        for i in np.flatnonzero(use & (empty > classes.spare[kind])):
            gaps = np.setdiff1d(np.arange(total[i]), at_block[at_row == i].astype(np.int64))
            out_leaf.append(_leaf(np.full(len(gaps), kind[i]), gaps, np.zeros(len(gaps), _U)))
            out_row.append(np.full(len(gaps), i))
    if not out_leaf:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(out_leaf), np.concatenate(out_row)


# ---- tables of sets ----------------------------------------------------------------------------


def _text_blocks(batches: Iterator[pa.RecordBatch], width: int):
    for batch in batches:
        for block in B.blocks(batch.column("text")):
            yield batch.column("id").slice(block.first, block.rows), block, *shingle_sets(block, width)


def _summaries(docs: DataFrame, width: int) -> DataFrame:
    """id, size of the set, its fingerprint, and its point."""

    def summed(batches):
        for ids, block, values, rows in _text_blocks(batches, width):
            sizes, one, two = _described(values, rows, block.rows)
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(one), pa.array(two), pa.array(_points(values, rows, block.rows), pa.binary())], names=["id", "n", "one", "two", "point"])

    return docs.mapInArrow(summed, f"id {docs.schema['id'].dataType.simpleString()}, n long, one long, two long, point binary")


def _leaf_rows(docs: DataFrame, width: int, classes: Classes) -> DataFrame:
    """(leaf, id). Inside a task, equal sets go once: a group of copies shrinks before it is shuffled."""

    def sent(batches):
        seen: set[tuple[int, int, int]] = set()
        for ids, block, values, rows in _text_blocks(batches, width):
            prints = list(zip(*(x.tolist() for x in _described(values, rows, block.rows))))
            new = np.zeros(block.rows, bool)
            for i, p in enumerate(prints):
                if p not in seen:
                    seen.add(p)
                    new[i] = True
            new &= ids.is_valid().to_numpy(zero_copy_only=False)
            mine = new[rows]
            leaf, row = leaves(values[mine], rows[mine], block.rows, classes)
            order = np.argsort(row, kind="stable")
            offsets = np.searchsorted(row[order], np.arange(block.rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(leaf[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids, lists], names=["id", "leaves"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(sent, f"id {kind}, leaves array<long>").select(F.explode("leaves").alias("leaf"), "id")


def _against_first(rows: DataFrame) -> DataFrame:
    """(leaf, first, id) for each row of a leaf but that of its smallest id. Leaves with one id vanish here.

    Leaves that hold the same ids are one: a leaf is renamed after its ids, where it has no more of them than a task will wait for.
    """

    def passed(batches):
        held_leaf, held_ids, open_first = np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def emit(leaf: np.ndarray, ids: np.ndarray, first: int | None = None, rename: bool = True) -> pa.RecordBatch:
            """Whole leaves; or, with first, more of one that has begun."""
            fresh = np.ones(len(leaf), bool)
            fresh[1:] = (leaf[1:] != leaf[:-1]) | (ids[1:] != ids[:-1])
            leaf, ids = leaf[fresh], ids[fresh]
            starts = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1])) if len(leaf) else np.zeros(0, np.int64)
            size = np.diff(np.append(starts, len(leaf)))
            firsts = np.repeat(ids[starts], size) if first is None else np.full(len(ids), first)
            if rename and len(leaf):
                leaf = np.repeat(np.add.reduceat(B.mix(ids.view(_U)), starts).view(np.int64), size)
            use = ids != firsts
            return pa.RecordBatch.from_arrays([pa.array(x[use]) for x in (leaf, firsts, ids)], names=["leaf", "first", "id"])

        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = np.concatenate((held_leaf, batch.column("leaf").to_numpy()))
            ids = np.concatenate((held_ids, batch.column("id").cast(pa.int64()).to_numpy()))
            if open_first is not None:
                # A leaf too large to wait for goes on; it keeps its own name.
                end = int(np.searchsorted(leaf != open_first[0], True))
                yield emit(leaf[:end], ids[:end], open_first[1], False)
                open_first = open_first if end == len(leaf) else None
                leaf, ids = leaf[end:], ids[end:]
            if not len(leaf):
                held_leaf, held_ids = leaf, ids
                continue
            changes = np.flatnonzero(leaf[1:] != leaf[:-1])
            last = int(changes[-1]) + 1 if len(changes) else 0
            yield emit(leaf[:last], ids[:last])
            held_leaf, held_ids = leaf[last:], ids[last:]
            if len(held_ids) > LEAF_ROWS:
                yield emit(held_leaf, held_ids, int(held_ids[0]), False)
                open_first = (held_leaf[0], int(held_ids[0]))
                held_leaf, held_ids = held_leaf[:0], held_ids[:0]
        yield emit(held_leaf, held_ids)

    ordered = rows.repartition("leaf").sortWithinPartitions("leaf", "id")
    return ordered.mapInArrow(passed, "leaf long, first long, id long").distinct()


# ---- verification ------------------------------------------------------------------------------


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _needed(sizes, percent: int):
    """A link needs 100 * o >= percent * (sizes - o), so (100 + percent) times its overlap o is at least this."""
    return percent * sizes


def _possible(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose points allow a link."""

    def bounded(batches):
        for batch in batches:
            bound = np.array([_bound(a, b) for a, b in zip(batch.column("point_a").to_pylist(), batch.column("point_b").to_pylist())], np.int64)
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(bound >= -(-_needed(sizes, percent) // (100 + percent))))

    for c in "ab":
        pairs = pairs.join(points.select(F.col("id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "point")]), c)
    kind = points.schema["id"].dataType.simpleString()
    return pairs.mapInArrow(bounded, f"a {kind}, b {kind}").distinct()


def _maybe(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id may be among the ids: a bitmap of fixed size, whatever the number of ids, leaves most others behind without a shuffle.

    The more ids, the more rows pass; none of the ids is ever lost, and rows that pass by chance meet no pair later.
    """

    def place(values: pa.Array) -> np.ndarray:
        return B.mix(values.cast(pa.int64()).to_numpy(zero_copy_only=False).view(_U)) >> _U(64 - BITMAP_BITS)

    def marked(batches):
        for batch in batches:
            at = place(batch.column("id"))
            words, which = np.unique((at >> _U(6)).astype(np.int64), return_inverse=True)
            bits = np.zeros(len(words), _U)
            np.bitwise_or.at(bits, which, _U(1) << (at & _U(63)))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits.view(np.int64))], names=["word", "bits"])

    rows = ids.mapInArrow(marked, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), _U)
    bitmap[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(_U)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def passed(batches):
        for batch in batches:
            batch = batch.filter(batch.column("id").is_valid())
            at = place(batch.column("id"))
            hit = (shared.value[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1)
            yield batch.filter(pa.array(hit.astype(bool)))

    return docs.mapInArrow(passed, docs.schema)


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link. Texts of the members stream past that of a; an a with many members is cut."""
    kind = texts.schema["id"].dataType.simpleString()
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / VERIFY_ROWS).cast("int").alias("parts"))
    members = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"), F.col("b").alias("id"))
    heads = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"), F.col("a").alias("id"))
    places = stored(heads.union(members), "verify")
    rows = places.join(_maybe(texts, places), "id").select("a", "part", "side", "id", "text")

    def checked(batches):
        now, head = None, []
        for batch in batches:
            found = []
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("a", "part", "side", "id"))))
            for block in B.blocks(batch.column("text")):
                values, row = shingle_sets(block, width)
                edges = np.searchsorted(row, np.arange(block.rows + 1)).tolist()
                for (a, part, side, other), begin, end in zip(keys[block.first :], edges, edges[1:]):
                    if (a, part) != now:
                        now, head = (a, part), []
                    if not side:
                        head.append(values[begin:end].copy())
                    elif any(linked(h, values[begin:end], percent) for h in head):
                        found.append((a, other))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], batch.column("a").type) for i in (0, 1)], names=["a", "b"])

    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", "side")
    return ordered.mapInArrow(checked, f"a {kind}, b {kind}").distinct()


# ---- nodes of count vectors --------------------------------------------------------------------


def _node_pairs(rows: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one leaf and different components whose points allow a link.

    rows: leaf, id, component, n; one row for each leaf and id.
    """
    kind = rows.schema["id"].dataType.simpleString()
    sizes = rows.groupBy("leaf").agg(F.count("*").alias("held"))
    rows = stored(rows.join(sizes, "leaf"), "leaf-rows")
    # A leaf that fits a node is one. Larger ones are cut in order of size, without a leaf having to fit a task.
    small = rows.where(F.col("held") <= NODE_ROWS).select("leaf", F.lit(0).cast("long").alias("node"), "id", "component", "n")
    large = rows.where(F.col("held") > NODE_ROWS).drop("held")
    placed = positions(large, ["leaf"], [F.col("n"), F.col("id")]).withColumn("node", F.floor(F.col("position") / NODE_ROWS))
    packed = stored(small.union(placed.select("leaf", "node", "id", "component", "n")), "nodes")

    nodes = packed.groupBy("leaf", "node").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    one, two = (nodes.select("leaf", *[F.col(c).alias(f"{c}_{side}") for c in nodes.columns[1:]]) for side in "ab")
    sized = (100 * F.col("high_a") >= percent * F.col("low_b")) & (100 * F.col("high_b") >= percent * F.col("low_a"))
    mixed = (F.least("c0_a", "c0_b") != F.greatest("c1_a", "c1_b")) & (F.col("node_a") <= F.col("node_b"))
    tiles = stored(one.join(two, "leaf").where(mixed & sized).select("leaf", "node_a", "node_b"), "tiles")

    def side(mine: str, number: int, use: DataFrame) -> DataFrame:
        return use.join(packed.withColumnRenamed("node", mine), ["leaf", mine]).select("leaf", "node_a", "node_b", F.lit(number).alias("side"), "id", "component", "n")

    def once(found: list[np.ndarray]) -> pa.RecordBatch:
        """A pair that several leaves hold goes on once."""
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def compared(batches):
        found, waiting = [], 0
        for tile in runs(batches, ["leaf", "node_a", "node_b"]):
            second = tile.column("side").to_numpy() == 1
            ids, parts, sizes = (tile.column(c).to_numpy() for c in ("id", "component", "n"))
            cells = [_opened(c) for c in tile.column("point").to_pylist()]
            groups = min((len(c) for c in cells if len(c)), default=GROUPS)
            counts = np.stack([_folded(c, groups) for c in cells])
            a = np.flatnonzero(~second)
            b = np.flatnonzero(second) if second.any() else a
            # The nodes' own bounds first: corners of the boxes around their points.
            folded = counts.reshape(len(counts), FOLDED, -1).sum(2, dtype=np.int64)
            corner = np.minimum(folded[a].max(0, initial=0), folded[b].max(0, initial=0)).sum()
            if not len(a) or not len(b) or (100 + percent) * corner < _needed(sizes[a].min() + sizes[b].min(), percent):
                continue
            differ = parts[a][:, None] != parts[b][None, :]
            if b is a:
                differ &= np.triu(np.ones(differ.shape, bool), 1)
            i, j = np.nonzero(differ)
            step = max(1, (1 << 22) // groups)
            for at in range(0, len(i), step):
                x, y = a[i[at : at + step]], b[j[at : at + step]]
                bound = np.minimum(counts[x], counts[y]).sum(1, dtype=np.int64)
                use = (100 + percent) * bound >= _needed(sizes[x] + sizes[y], percent)
                x, y = ids[x[use]], ids[y[use]]
                found.append(np.column_stack((np.minimum(x, y), np.maximum(x, y))))
                waiting += len(x)
            if waiting > 1 << 18:
                yield once(found)
                found, waiting = [], 0
        if waiting:
            yield once(found)

    tiled = side("node_a", 0, tiles).union(side("node_b", 1, tiles.where("node_a != node_b"))).join(points, "id")
    ordered = tiled.repartition("leaf", "node_a", "node_b").sortWithinPartitions("leaf", "node_a", "node_b", "side")
    return ordered.mapInArrow(compared, f"a {kind}, b {kind}").distinct()


# ---- the join ----------------------------------------------------------------------------------


def classes(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85, width: int = 4) -> DataFrame:
    """(id, n_shingles, component_id) for each row: the smallest id that its links reach. Ids are whole numbers."""
    docs = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sizing = Classes(percent)
    summary = stored(_summaries(docs, width), "sets-summary")
    known = summary.where("n > 0 AND id IS NOT NULL")
    same = ["one", "two", "n"]
    members = stored(known.join(known.groupBy(*same).agg(F.min("id").alias("first")), same).select("id", "first").distinct(), "sets-copies")
    shared = stored(_against_first(_leaf_rows(docs, width, sizing)), "leaves")

    # Every document stands for itself by the first of its copies; texts of those that share a leaf are needed again.
    met = shared.select("first", "id").distinct()
    left, right = (members.select(F.col("id").alias(x), F.col("first").alias(y)) for x, y in (("first", "a"), ("id", "b")))
    met = stored(met.join(left, "first").join(right, "id").where("a != b"), "met")
    ends = met.select(F.col("a").alias("id")).union(met.select(F.col("b").alias("id"))).distinct()
    ends = stored(ends, "candidates")
    texts = stored(_maybe(docs, ends), "texts")
    sets = stored(_maybe(known.select("id", "n", "point"), ends), "points")
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    asked = stored(_possible(met.select(*ordered("a", "b")).distinct(), sets, percent), "pairs")
    links = stored(_verify(asked, texts, width, percent), "links")
    grouped = components(links.union(members.where("id != first")), *links.columns)

    def apart(rows: DataFrame) -> DataFrame:
        """Rows (leaf, id) of leaves that hold several components, with the component."""
        parted = rows.join(grouped.select("id", "component"), "id", "left").select("leaf", "id", F.coalesce("component", "id").alias("component"))
        open_leaves = parted.groupBy("leaf").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 != c1")
        return stored(parted.join(open_leaves, "leaf", "left_semi"), "open-leaves")

    # Only leaves whose smallest id is apart from another of the leaf are open; what they hold is listed once.
    stands = met.join(grouped.select(F.col("id").alias("a"), F.col("component").alias("x")), "a", "left").join(grouped.select(F.col("id").alias("b"), F.col("component").alias("y")), "b", "left")
    stands = stands.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("first", "id").distinct()
    open_leaves = shared.join(stands, ["first", "id"], "left_semi").select("leaf").distinct()
    held = shared.join(open_leaves, "leaf", "left_semi")
    held = held.select("leaf", "id").union(held.select("leaf", "first").distinct())
    held = apart(held.join(members, "id").select("leaf", F.col("first").alias("id")).distinct())

    # The set of most links in each leaf, against those apart from it.
    degrees = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("links"))
    ranked = held.join(degrees, "id", "left").fillna(0, ["links"])
    hubs = ranked.groupBy("leaf").agg(F.max(F.struct("links", "id", "component")).alias("hub"))
    tried = held.join(hubs, "leaf").where(F.col("component") != F.col("hub.component")).select(*ordered("id", "hub.id")).distinct()
    tried = stored(_possible(tried.join(asked, ["a", "b"], "left_anti"), sets, percent), "pairs")
    more = stored(_verify(tried, texts, width, percent), "links")
    star = lambda: grouped.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    if not more.isEmpty():
        grouped = components(more.union(star()), "a", "b")
        held = apart(held.select("leaf", "id"))

    # All others of different components.
    rest = _node_pairs(held.join(sets.select("id", "n"), "id"), sets.drop("n"), percent)
    rest = stored(rest.join(asked.union(tried), ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        grouped = components(_verify(rest, texts, width, percent).union(star()), "a", "b")

    found = grouped.select("id", "component").distinct()
    return summary.join(found, "id", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def keep_first(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85, width: int = 4) -> DataFrame:
    """One row of each component, the one of its smallest id; rows equal in id and text are one. Rows without an id stay.

    Different texts of one id are documents of their own: one of them keeps the id, the others get ids above all in use.
    """
    column, value = F.col(f"`{id}`"), F.col(f"`{text}`")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = df.where(column.isNotNull()).select(row, column.cast("long").alias("id"), value.alias("text"))
    print_ = F.struct(F.xxhash64("text"), F.hash("text"))
    shared = rows.groupBy("id").agg(F.min(print_).alias("p0"), F.max(print_).alias("p1")).where("p0 != p1").select("id")
    shared = stored(shared, "shared-ids")
    if not shared.isEmpty():
        digest = F.coalesce(F.sha2("text", 256), F.lit(""))
        several = rows.join(shared, "id").select("id", digest.alias("digest")).distinct()
        first = several.groupBy("id").agg(F.min("digest").alias("digest"))
        top = rows.agg(F.max("id")).first()[0]
        others = positions(several.join(first, ["id", "digest"], "left_anti"), [], [F.col("id"), F.col("digest")])
        fresh = stored(others.select("id", "digest", (F.col("position") + 1 + F.lit(top)).alias("fresh")), "fresh-ids")
        rows = rows.withColumn("digest", digest).join(fresh, ["id", "digest"], "left")
        rows = stored(rows.select("row", F.coalesce("fresh", "id").alias("id"), "text"), "rows-by-text")
    first = classes(rows.select("id", "text"), "id", "text", percent, width).where("id = component_id").select("id").distinct()
    kept = rows.join(first, "id").groupBy("id").agg(F.min_by("row", F.struct(F.col("text").isNull(), "text")).alias("row"))
    return kept.select("row.*").union(df.where(column.isNull()))
