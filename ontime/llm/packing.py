"""Best-fit packing of tokenised documents into sequences, by a grouping genetic algorithm on islands.

Documents are tokenised once and cut only if they are longer than a sequence. Pieces are dealt by hash into shards of a few thousand. For each
shard several islands breed packings of the same pieces: a crossover puts whole well-filled sequences of one parent into the other,
drops the other's sequences that hold any of the same pieces, and packs what was displaced by best fit. After each round an island
gets the best packing of the island before it. Shards are rows, so islands run wherever Spark puts them, and migration
is a join. Sequences that stay badly filled are dissolved and their pieces dealt again, until one shard is left or dealing again
saves too few sequences to go on; of the last two packings the one with fewer sequences stays. So every level but the last
saves a share of its sequences, and no shard has to hold more than its part, however badly the pieces fit together.

With a source column, pieces are numbered in the order of the mixture (the slots of ``mixing``, worked out from the same documents)
and dealt by ranges of that order. A sequence is called by its first piece, so sequences in the order of their ids keep the shares of
the mixture as far as a block and a shard allow.

Breeding ends as soon as a packing needs no more sequences than the sum of lengths demands. Random numbers are seeded by shard and
island, so a lost task gives the same packing again.

Cases: a null or empty text is one piece that holds only the end token. A long text is cut whole, whatever its length. Repeated rows
are packed each. A text that the fast tokeniser refuses, or that spells a special token, goes through the reference tokeniser.
Extra columns are not read; a null source is a source of its own. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ontime.llm import mixing
from ontime.llm.tables import stored
from ontime.operators.ordered import positions

CAPACITY = 2048
END = 0
#: Pieces of a shard, on average.
SHARD = 4096
ISLANDS = 2
ROUNDS = 2
GENERATIONS = 3
POPULATION = 4
#: A sequence filled less than this is dissolved while several shards are left.
WELL_FILLED = 0.97
#: A level that saves no more than one in so many of the sequences it dissolved is the last.
LEAST_SAVED = 256
#: Runs of one kind of character longer than this go through the reference tokeniser.
LONG_RUN = 100_000

_loaded: dict[tuple[str, str, str], tuple] = {}


# ---- tokens ------------------------------------------------------------------------------------


def tokenizers_at(json_path: str, ranks_path: str, pattern: str):
    """What gives the reference tokeniser, the same vocabulary in a library several times as fast, and the special tokens; loaded once for
    each worker, the reference (34 MB) only when a text first needs it."""
    key = (json_path, ranks_path, pattern)
    if key not in _loaded:
        import tiktoken

        @cache
        def reference():
            from tokenizers import Tokenizer

            return Tokenizer.from_file(json_path)

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        with open(json_path, encoding="utf-8") as text:
            special = [t["content"] for t in json.load(text)["added_tokens"]]
        _loaded[key] = reference, tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), special
    return _loaded[key]


def token_ids(text: str | None, loaded: tuple) -> np.ndarray:
    """Ids as the reference gives them, and the end token."""
    reference, fast, special = loaded
    text = text or ""
    # The fast library's pattern engine gives up on very long runs, so long texts without spaces and such runs are left to the reference.
    plain = not any(t in text for t in special) and (len(text) < LONG_RUN or _longest_word(text) < LONG_RUN)
    ids = fast.encode_ordinary(text) if plain else reference().encode(text, add_special_tokens=False).ids
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1] = ids
    out[-1] = END
    return out


def _longest_word(text: str) -> int:
    """Longest run of blanks or of anything else."""
    blank = np.array([c.isspace() for c in text])
    edges = np.flatnonzero(np.concatenate(([True], blank[1:] != blank[:-1], [True])))
    return int(np.diff(edges).max())


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece: all full but, maybe, the first."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def _pieces(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, capacity: int) -> DataFrame:
    """Pieces of each text; with a source, the first of a text also has that and the text's size, and likewise with a place."""
    with_source, with_place = "source" in docs.columns, "place" in docs.columns

    def cut(batches: Iterator[pa.RecordBatch]):
        loaded = tokenizers_at(json_path, ranks_path, pattern)
        for batch in batches:
            rows, piece, start, length, crc, firsts, chars = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                ids = token_ids(text, loaded)
                for k, (a, n) in enumerate(cuts(len(ids), capacity)):
                    rows.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(ids[a : a + n].tobytes()))
                    firsts.append(None if k else i)
                    chars.append(None if k else len(text or ""))
            columns = [batch.column("id").take(pa.array(rows, pa.int32())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_source:
                columns += [batch.column("source").take(pa.array(firsts, pa.int32())), pa.array(chars, pa.int64())]
                names += ["source", "chars"]
            if with_place:
                columns.append(batch.column("place").take(pa.array(firsts, pa.int32())))
                names.append("place")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["id"].dataType.simpleString()
    more = ", source string, chars long" * with_source + ", place string" * with_place
    return docs.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long{more}")


# ---- breeding ----------------------------------------------------------------------------------

Bins = list[list[int]]


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: Bins | None = None) -> Bins:
    """Put each piece where the least room stays. Bins by room left; one bit for each room that some bin has."""
    bins = bins if bins is not None else []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for k, b in enumerate(bins):
        room = capacity - sum(sizes[i] for i in b)
        by_room[room].append(k)
        mask |= 1 << room
    for i in order:
        size = sizes[i]
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
            bins[k].append(i)
            room -= size
        else:
            k, room = len(bins), capacity - size
            bins.append([i])
        by_room[room].append(k)
        mask |= 1 << room
    return bins


def least_bins(sizes: list[int], capacity: int) -> int:
    return -(-sum(sizes) // capacity)


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; then unequal filling, which leaves room together."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(one: Bins, two: Bins, sizes: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """Some well-filled bins of ``two`` whole, those of ``one`` without any of their pieces, and the rest by best fit."""
    fill = np.array([sum(sizes[i] for i in b) for b in two])
    good = np.argsort(-fill, kind="stable")[: max(1, len(two) // 2)]
    chosen = rng.choice(good, size=max(1, len(good) // 2), replace=False)
    injected = [list(two[k]) for k in chosen]
    held = {i for b in injected for i in b}
    kept, displaced = injected, []
    # With the duplicates, the emptiest bins go too: mutation by which their pieces find better places.
    mine = [sum(sizes[i] for i in b) for b in one]
    weak = set(np.argsort(mine, kind="stable")[: max(1, len(one) // 50)].tolist())
    for k, b in enumerate(one):
        if k in weak or not held.isdisjoint(b):
            displaced += [i for i in b if i not in held]
        else:
            kept.append(list(b))
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, capacity, kept)


def breed(sizes: list[int], capacity: int, rng: np.random.Generator, start: list[Bins]) -> Bins:
    """The best packing after some generations, from the given ones and noisy best fits."""
    value = lambda b: fitness(b, sizes, capacity)
    least, weights = least_bins(sizes, capacity), np.array(sizes, float)
    people = list(start)
    while len(people) < POPULATION and not any(len(p) <= least for p in people):
        noise = 1 + 0.1 * rng.standard_normal(len(sizes)) * bool(people)
        people.append(best_fit(np.argsort(-weights * noise, kind="stable").tolist(), sizes, capacity))
    for _ in range(GENERATIONS):
        people = sorted(people, key=value, reverse=True)[:POPULATION]
        if len(people[0]) <= least or len(people) < 2:
            break
        pairs = [rng.choice(len(people), 2, replace=False) for _ in range(POPULATION // 2)]
        people += [crossover(people[a], people[b], sizes, capacity, rng) for a, b in pairs]
    return max(people, key=value)


def _assigned(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _listed(assigned: list[int]) -> Bins:
    bins: Bins = [[] for _ in range(max(assigned) + 1)]
    for i, k in enumerate(assigned):
        bins[k].append(i)
    return bins


# ---- on Spark ----------------------------------------------------------------------------------

_ISLAND = "shard long, island int, items array<long>, sizes array<int>, bins array<int>, score double"
_ISLAND_ARROW = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("items", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("bins", pa.list_(pa.int32())), ("score", pa.float64())])


def _round(islands: DataFrame, number: int, capacity: int) -> DataFrame:
    """Each island breeds from what it has, and from the immigrant."""

    def bred(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                start = [_listed(x) for x in (r["bins"], r["migrant"]) if x]
                best = breed(r["sizes"], capacity, np.random.default_rng([number, r["shard"], r["island"]]), start)
                few, filled = fitness(best, r["sizes"], capacity)
                rows.append({"shard": r["shard"], "island": r["island"], "items": r["items"], "sizes": r["sizes"], "bins": _assigned(best, len(r["sizes"])), "score": few + filled / (1 + filled)})
            yield pa.RecordBatch.from_pylist(rows, _ISLAND_ARROW)

    return islands.mapInArrow(bred, _ISLAND)


def _dealt(items: DataFrame, n: int, shards: int, level: int, ordered: bool) -> DataFrame:
    """With the shard of each of the n items: a range of them if ordered, else by hash."""
    if ordered:
        return positions(items, [], [F.col("item")]).withColumn("shard", F.expr(f"position * {shards} div {n}")).drop("position")
    # With the level, so that as many shards as before still hold other pieces.
    return items.withColumn("shard", F.pmod(F.xxhash64("item", F.lit(shards), F.lit(level)), F.lit(shards)).cast("long"))


def _evolved(dealt: DataFrame, capacity: int) -> DataFrame:
    """(shard, items, sizes, bins): the best packing of each shard. dealt: item, length, shard."""
    # Hashed or by ranges, a shard holds about SHARD pieces: its list is bounded.
    listed = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("all"))
    start = listed.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("all.item").alias("items"), F.col("all.length").cast("array<int>").alias("sizes"))
    none = F.lit(None).cast("array<int>")
    islands = start.repartition("shard", "island").select("*", none.alias("bins"), none.alias("migrant"))
    islands = stored(_round(islands, 0, capacity), "islands")
    for number in range(1, ROUNDS):
        # The elite of each island moves on to the next.
        elite = islands.select("shard", ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"), F.col("bins").alias("migrant"))
        islands = islands.drop("score").join(elite, ["shard", "island"])
        islands = stored(_round(islands, number, capacity), "islands")
    best = F.max_by(F.struct("items", "sizes", "bins"), F.struct("score", -F.col("island"))).alias("best")
    return islands.groupBy("shard").agg(best).select("shard", "best.*")


def assign(items: DataFrame, capacity: int = CAPACITY, ordered: bool = False) -> DataFrame:
    """(item, sequence_id, offset) for pieces (item, length) of at most ``capacity`` tokens; items are distinct and not negative.

    A sequence is called by its smallest item. If ordered, a sequence holds pieces that are near each other by item.
    """
    placed = ("item", "sequence_id", "offset")
    full = items.where(F.col("length") == capacity)
    out = [full.select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left, level = items.where(F.col("length") < capacity).select("item", "length"), 0
    n, before, weak = left.count(), None, None
    while n:
        shards = -(-n // SHARD)
        rows = _evolved(_dealt(left, n, shards, level, ordered), capacity).select("shard", F.explode(F.arrays_zip("items", "sizes", "bins")).alias("r"))
        rows = rows.select("shard", F.col("r.items").alias("item"), F.col("r.sizes").cast("long").alias("length"), F.col("r.bins").alias("bin"))
        in_bin = Window.partitionBy("shard", "bin")
        ahead = in_bin.orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
        rows = stored(rows.select("item", "length", F.min("item").over(in_bin).alias("sequence_id"), offset, F.sum("length").over(in_bin).alias("fill")), "packed")
        thin, first = F.col("fill") < WELL_FILLED * capacity, (F.col("item") == F.col("sequence_id")).cast("long")
        made, thinner, left_over = rows.agg(F.sum(first), F.coalesce(F.sum(F.when(thin, first)), F.lit(0)), F.count(F.when(thin, 1))).first()
        if before is not None and made > before:
            out.append(weak)
            break
        if shards == 1 or (before is not None and (before - made) * LEAST_SAVED <= before):
            out.append(rows.select(*placed))
            break
        out.append(rows.where(~thin).select(*placed))
        weak, left = rows.where(thin).select(*placed), rows.where(thin).select("item", "length")
        n, before, level = left_over, thinner, level + 1
    total = out[0]
    for part in out[1:]:
        total = total.union(part)
    return total


def _ordered(pieces: DataFrame, heads: DataFrame, by: str) -> DataFrame:
    """The pieces, with items numbered by a column of their documents' first pieces (item and that column), then as they were."""
    # Pieces of a document are numbered one after the other.
    pieces = pieces.withColumn("head", F.col("item") - F.col("piece"))
    placed = pieces.join(heads.select(F.col("item").alias("head"), by), "head").drop("head")
    return positions(placed, [], [F.col(by), F.col("item")]).drop(by, "item").withColumnRenamed("position", "item")


def _mixed(pieces: DataFrame) -> DataFrame:
    """The pieces, with items numbered in the order of the mixture: by the slot of their document."""
    heads = pieces.where("piece = 0").select("item", "id", "source", "chars")
    size = F.col("chars")
    placed = mixing.interleave(heads, mixing.tempered_weights(heads, "source", size), "source", size, ["id"])
    return _ordered(pieces.drop("source", "chars"), placed, "slot")


def pack(
    df: DataFrame, json_path: str, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, source: str | None = None, place: Column | None = None
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row. With a source column, in the order of the mixture;
    with a place, a text by which rows are in order, in that order."""
    if source and place is not None:
        raise ValueError("give a source or a place: either sets the order")
    own = [F.col(f"`{source}`").cast("string").alias("source")] if source else [place.alias("place")] if place is not None else []
    docs = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), *own)
    # Items are numbered once and kept, so that a second run of a task can't renumber them.
    pieces = stored(_pieces(docs, json_path, ranks_path, pattern, capacity).withColumn("item", F.monotonically_increasing_id()), "pieces")
    if source:
        pieces = stored(_mixed(pieces), "mixed")
    elif own:
        pieces = stored(_ordered(pieces.drop("place"), pieces.where("piece = 0"), "place"), "in-place")
    return pieces.join(assign(pieces.select("item", "length"), capacity, bool(own)), "item").drop("item")
