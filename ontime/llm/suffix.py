"""Suffix-array de-duplication: bytes covered by a string of ``length`` bytes that also starts anywhere else are removed.

1. Anchors. Each window of ``length`` bytes has a smallest gram by hash (the leftmost, if equal); windows that follow each other with the same one form a range.
   Equal windows have equal grams, so a repeated window is found among the ranges that share a gram; a gram that occurs once needs no
   further look. Ranges with equal bytes are repeated as a whole, and one of them stands for all.
2. Shards. What ranges of one gram differ in is settled by suffix arrays: their bytes, cut from the texts, are put into shards of bounded
   size, whole grams together. A shard's array is built by induced sorting (Nong, Zhang and Chan 2009): suffixes are classified, the
   leftmost-smaller substrings sorted and named, recursively while names repeat, and all others induced from them in two linear
   passes. The common prefix of each suffix with the one before it in the array, in text order, then tells the repeated windows.
3. Each text loses the union of its repeated windows.

A gram with so many different ranges that they would not fit a shard is settled by 128-bit hashes of its windows, grouped by Spark. Texts travel in
pieces, so a long text is not copied for each of its ranges.

Cases: a null text counts as empty, and texts shorter than ``length`` lose nothing. Rows with equal id and text are separate
occurrences, so they lose the same bytes. Extra columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ontime.llm import textblocks as B
from ontime.llm.tables import runs, stored

LENGTH = 200
#: Bytes of a gram. Longer ones make more ranges; shorter ones are found more often around places where copies differ.
GRAM = 48
#: Bytes of a shard, about, and of one gram's ranges in it at most.
SHARD_BYTES = 1 << 18
GRAM_BYTES = 1 << 20
#: Bytes of a piece in which texts travel, without the overlap.
PIECE = 1 << 16
#: Windows looked at in one go; positions must fit 23 bits.
_SPAN = 1 << 20
_U = np.uint64


# ---- anchors -----------------------------------------------------------------------------------


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from running minima inside blocks, left and right."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(_U).max, _U)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def ranges(block: B.Block, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, first and last window start (in the block), gram hash and content hash of each range."""
    data, out = block.data, []
    size = np.diff(block.bounds)
    wide = length - gram + 1
    for at in range(0, max(len(data) - length + 1, 0), _SPAN):
        piece = data[at : at + _SPAN + length - 1]
        grams = np.arange(len(piece) - gram + 1)
        hashes = block.hashes(piece)
        keys = hashes.of(grams, grams + gram)
        least = _sliding_least((keys & ~_U((1 << 24) - 1)) | grams.astype(_U), wide)
        anchor = (least & _U((1 << 24) - 1)).astype(np.int64)
        starts = np.arange(len(anchor))
        row = block.row_of(at + starts)
        inside = at + starts + length <= block.bounds[row + 1]
        edge = np.ones(len(starts) + 1, bool)
        edge[1:-1] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
        first, last = np.flatnonzero(edge[:-1]), np.flatnonzero(edge[1:])
        use = inside[first]
        first, last = first[use], last[use]
        out.append((row[first], at + first, at + last, keys[anchor[first]], hashes.of(first, last + length)))
    if not out or not size.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, _U)
    return tuple(np.concatenate(x) for x in zip(*out))


_RANGE = "d1 long, d2 int, place long, key long, content long"


def _place(lo: np.ndarray, hi: np.ndarray, times: np.ndarray) -> np.ndarray:
    """A range and how often it was seen, in one number: texts are shorter than 2**31 bytes, and times is 0, 1 or 2."""
    lo, hi, times = (x.astype(_U) for x in (lo, hi, times))
    return ((lo << _U(33)) | ((hi - lo) << _U(2)) | times).view(np.int64)


def _placed(df: DataFrame) -> DataFrame:
    """Columns lo, hi and times in place of ``place``."""
    lo = F.shiftrightunsigned("place", 33)
    span = F.shiftrightunsigned("place", 2).bitwiseAND((1 << 31) - 1)
    return df.withColumns({"lo": lo, "hi": lo + span, "times": F.col("place").bitwiseAND(3)}).drop("place")


def _anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row for each range. Ranges with equal bytes in one batch: one of them with times 2; all of them, neighbours merged, without key."""

    def found(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            parts = []
            for block in B.blocks(batch.column("text"), 1 << 20):
                row, lo, hi, key, content = ranges(block, length, gram)
                start = block.bounds[row]
                parts.append((block.first + row, lo - start, hi - start, key, content))
            if not parts:
                continue
            row, lo, hi, key, content = (np.concatenate(x) for x in zip(*parts))
            both = B.mix(key * _U(0x9E3779B97F4A7C15) + content)
            _, where, which, number = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
            again = number[which] > 1
            flagged = np.flatnonzero(again)
            joins = np.zeros(len(flagged), bool)
            joins[1:] = (row[flagged[1:]] == row[flagged[:-1]]) & (lo[flagged[1:]] == hi[flagged[:-1]] + 1)
            begins = np.flatnonzero(~joins)
            ends = np.append(begins[1:], len(flagged))[: len(begins)] - 1
            rows = np.concatenate((row[where], row[flagged[begins]])).astype(np.int64)
            empty = pa.nulls(len(begins), pa.int64())
            take = pa.array(rows)
            place = np.concatenate((_place(lo[where], hi[where], np.minimum(number, 2)), _place(lo[flagged[begins]], hi[flagged[ends]], np.zeros(len(begins)))))
            yield pa.RecordBatch.from_arrays([
                batch.column("d1").take(take), batch.column("d2").take(take), pa.array(place),
                pa.concat_arrays([pa.array(key[where].view(np.int64)), empty]), pa.concat_arrays([pa.array(content[where].view(np.int64)), empty]),
            ], names=[x.split()[0] for x in _RANGE.split(", ")])

    return docs.mapInArrow(found, _RANGE)


# ---- suffix arrays -----------------------------------------------------------------------------


def _types(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the one that follows. The last symbol is the only least one."""
    step = np.sign(np.diff(s.astype(np.int64)))
    known = np.flatnonzero(step)
    smaller = np.ones(len(s), bool)
    smaller[:-1] = step[known[np.searchsorted(known, np.arange(len(step)))]] > 0
    return smaller


def _split(values: np.ndarray, symbols: np.ndarray, into: dict[int, list[np.ndarray]]) -> None:
    """Append the values to the lists of their symbols, in order."""
    if not len(values):
        return
    order = np.argsort(symbols, kind="stable")
    values, symbols = values[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for symbol, part in zip(symbols[np.concatenate(([0], cuts))].tolist(), np.split(values, cuts)):
        into.setdefault(symbol, []).append(part)


def _induce_by_symbol(s: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order: one symbol's suffixes at a time."""
    given: dict[int, list[np.ndarray]] = {}
    _split(leftmost, s[leftmost], given)
    symbols = np.unique(s).tolist()
    larger: dict[int, list[np.ndarray]] = {}
    done: dict[int, np.ndarray] = {}

    def preceding(x: np.ndarray, kind: bool) -> np.ndarray:
        before = x[x > 0] - 1
        return before[smaller[before] == kind]

    for c in symbols:
        wave, mine = larger.pop(c, []), []
        while wave:
            now = np.concatenate(wave)
            mine.append(now)
            before = preceding(now, False)
            same = s[before] == c
            _split(before[~same], s[before[~same]], larger)
            wave = [before[same]] if same.any() else []
        done[c] = np.concatenate(mine) if mine else np.zeros(0, np.int64)
        for part in given.get(c, []):
            before = preceding(part, False)
            _split(before, s[before], larger)

    # The second pass runs from the right; its lists are kept right to left.
    small: dict[int, list[np.ndarray]] = {}
    out = []
    for c in reversed(symbols):
        wave, mine = small.pop(c, []), []
        while wave:
            now = np.concatenate(wave)
            mine.append(now)
            before = preceding(now, True)
            same = s[before] == c
            _split(before[~same], s[before[~same]], small)
            wave = [before[same]] if same.any() else []
        left = done[c][::-1]
        before = preceding(left, True)
        same = s[before] == c  # a smaller suffix before a larger one starts with a smaller symbol
        _split(before[~same], s[before[~same]], small)
        # The last symbol has no follower to be induced from.
        tail = [np.array([len(s) - 1])] if c == s[-1] else []
        out.append(np.concatenate([*mine, *tail, left]))
    return np.concatenate(out)[::-1]


def _induce_in_turn(s: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The same for many symbols with few suffixes each: one suffix at a time."""
    n = len(s)
    ends = np.cumsum(np.bincount(s))
    heads, tails = (ends - np.bincount(s)).tolist(), ends.tolist()
    # Of each suffix, the symbol before it if that begins a suffix of the wanted kind, else -1; place n stands for "none yet".
    before_larger, before_smaller = np.full(n + 1, -1), np.full(n + 1, -1)
    before_larger[1:n] = np.where(smaller[:-1], -1, s[:-1])
    before_smaller[1:n] = np.where(smaller[:-1], s[:-1], -1)
    larger_at, smaller_at = before_larger.tolist(), before_smaller.tolist()
    out = [n] * n
    free = list(tails)
    for i, c in zip(leftmost[::-1].tolist(), s[leftmost[::-1]].tolist()):
        free[c] -= 1
        out[free[c]] = i
    for j in out:  # the list grows ahead of the loop
        c = larger_at[j]
        if c >= 0:
            head = heads[c]
            out[head] = j - 1
            heads[c] = head + 1
    for at in range(n - 1, -1, -1):
        j = out[at]
        c = smaller_at[j]
        if c >= 0:
            tail = tails[c] - 1
            out[tail] = j - 1
            tails[c] = tail
    out[0] = n - 1
    return np.array(out, np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start of each suffix, in order. ``s`` holds whole numbers and ends with its only least one."""
    if len(s) < 3:
        return np.arange(len(s), dtype=np.int64)[::-1]
    induce = _induce_by_symbol if len(s) > 256 * len(np.unique(s)) else _induce_in_turn
    smaller = _types(s)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = induce(s, smaller, leftmost)
    first = np.zeros(len(s), bool)
    first[leftmost] = True
    order = order[first[order]]
    # Substrings from one leftmost-smaller suffix to the next get equal names if they are equal, by length and hash.
    until = np.empty(len(s), np.int64)
    until[leftmost] = np.append(leftmost[1:], len(s) - 1) + 1
    hashes = B.Rolling(B.mix(s.astype(_U) + _U(1)))
    value, size = hashes.of(order, until[order]), until[order] - order
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = (value[1:] != value[:-1]) | (size[1:] != size[:-1])
    names = np.cumsum(fresh) - 1
    if names[-1] + 1 < len(order):
        name = np.empty(len(s), np.int64)
        name[order] = names
        order = leftmost[suffix_array(name[leftmost])]
    return induce(s, smaller, order)


def permuted_prefixes(data: np.ndarray, before: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Of each start, bytes in common with the start before it in suffix order, up to ``most``; eight at a time."""
    padded = np.concatenate((data, np.zeros(8 + most, np.uint8)))
    word = np.zeros(len(padded) - 7, _U)
    for k in range(8):
        word |= padded[k : len(word) + k].astype(_U) << _U(8 * k)
    out = np.zeros(len(starts), np.int64)
    going = np.arange(len(starts))
    for at in range(0, most, 8):
        differ = word[starts[going] + at] ^ word[before[going] + at]
        same = differ == 0
        stop = going[~same]
        low = differ[~same] & (~differ[~same] + _U(1))
        out[stop] = at + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        going = going[same]
    out[going] = most
    return np.minimum(out, most)


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """Of each piece, for each of its windows, whether an equal window starts elsewhere in any piece."""
    sizes = np.array([len(p) for p in pieces])
    data = np.frombuffer(b"".join(p + b"\0" for p in pieces), np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(len(data) + 1, np.int64)
    symbols[:-1] = data.astype(np.int64) + 2
    symbols[begin + sizes] = 1  # between pieces
    counted = np.zeros(len(symbols), bool)
    windows = np.maximum(sizes - length + 1, 0)
    starts = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    counted[starts] = True
    order = suffix_array(symbols)
    order = order[counted[order]]
    before = np.zeros(len(symbols), np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(symbols), bool)
    if len(order) > 1:
        second = starts[starts != order[0]]
        match = second[permuted_prefixes(data, before[second], second, length) >= length]
        out[match] = True
        out[before[match]] = True
    return [out[a : a + w] for a, w in zip(begin.tolist(), windows.tolist())]


# ---- on Spark ----------------------------------------------------------------------------------

_FLAG = "d1 long, d2 int, lo long, hi long"
_FLAG_ARROW = pa.schema([("d1", pa.int64()), ("d2", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64())])


def _flag_batch(d1: list, d2: list, lo: list, marks: list[np.ndarray]) -> pa.RecordBatch:
    """Runs of marked windows."""
    rows = []
    for a, b, at, mark in zip(d1, d2, lo, marks):
        if mark.any():
            edge = np.diff(np.concatenate(([0], mark.astype(np.int8), [0])))
            rows += [(a, b, at + x, at + y - 1) for x, y in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, _FLAG_ARROW.types)], schema=_FLAG_ARROW)


def _by_shard(snippets: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the single ranges, from a suffix array for each shard."""

    def settled(batches: Iterator[pa.RecordBatch]):
        def settle(groups: list[pa.Table]) -> pa.RecordBatch:
            table = pa.concat_tables(groups)
            marks = repeated_starts(table.column("bytes").to_pylist(), length)
            single = table.column("single").to_numpy()
            marks = [m if s else np.zeros(0, bool) for m, s in zip(marks, single)]
            return _flag_batch(*(table.column(c).to_pylist() for c in ("d1", "d2", "lo")), marks)

        groups, size = [], 0
        for group in runs(batches, ["key"]):
            # Rows of the same id and text ask for the same range; one is enough.
            place = np.column_stack([group.column(c).to_numpy() for c in ("d1", "d2", "lo")])
            fresh = np.append(True, (place[1:] != place[:-1]).any(1))
            group = group if fresh.all() else group.filter(pa.array(fresh))
            groups.append(group)
            size += group.nbytes
            if size >= SHARD_BYTES:
                yield settle(groups)
                groups, size = [], 0
        if groups:
            yield settle(groups)

    columns = ["key", "d1", "d2", "lo", "single", "bytes"]
    return snippets.select(*columns).repartition("key").sortWithinPartitions("key", "d1", "d2", "lo").mapInArrow(settled, _FLAG)


def _by_window(snippets: DataFrame, length: int) -> DataFrame:
    """The same where one gram has too many ranges for a shard: windows with equal hashes are counted."""

    def hashed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in B.blocks(batch.column("bytes").cast(pa.large_binary()).view(pa.large_string())):
                sizes = np.diff(block.bounds)
                windows = np.maximum(sizes - length + 1, 0)
                row = np.repeat(np.arange(block.rows), windows)
                offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
                at = block.bounds[row] + offset
                one, two = block.hashes().of(at, at + length), B.Rolling(B.mix(block.data.astype(_U) + _U(77))).of(at, at + length)
                take = pa.array(block.first + row)
                lo = pa.array(batch.column("lo").take(take).to_numpy() + offset)
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), batch.column("d1").take(take), batch.column("d2").take(take), lo, batch.column("single").take(take)], names=["one", "two", "d1", "d2", "lo", "single"])

    windows = snippets.dropDuplicates(["key", "d1", "d2", "lo"]).mapInArrow(hashed, "one long, two long, d1 long, d2 int, lo long, single boolean")
    again = windows.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1")
    return windows.where("single").join(again, ["one", "two"], "left_semi").select("d1", "d2", "lo", F.col("lo").alias("hi"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(d1, d2, lo, hi): every repeated window of ``length`` bytes starts in one of a text's ranges. docs: d1, d2, text."""
    anchors = stored(_anchors(docs.where(F.octet_length("text") >= length), length, gram), "anchors")
    same_gram, same_bytes = Window.partitionBy("key"), Window.partitionBy("key", "content")
    times = F.col("place").bitwiseAND(3)
    met = anchors.where("key IS NOT NULL").withColumns({"n": F.sum(times).over(same_bytes), "turn": F.row_number().over(same_bytes.orderBy("d1", "d2", "place"))})
    met = met.withColumns({"least": F.min("n").over(same_gram), "c0": F.min("content").over(same_gram), "c1": F.max("content").over(same_gram)})
    # A gram whose ranges are all repeated as wholes, or that has one range only, is settled.
    met = met.withColumn("ask", (F.col("turn") == 1) & (F.col("c0") != F.col("c1")) & (F.col("least") == 1))
    met = stored(met.where(F.col("ask") | ((F.col("n") > 1) & (times == 1))).select("d1", "d2", "place", "key", "ask", "n"), "met-anchors")
    whole = anchors.where("key IS NULL").select("d1", "d2", "place").union(met.where((F.col("n") > 1) & (times == 1)).select("d1", "d2", "place"))
    whole, met = _placed(whole).select("d1", "d2", "lo", "hi"), _placed(met)

    span = F.col("hi") - F.col("lo") + length
    asked = met.where("ask").select("key", "d1", "d2", "lo", (F.col("n") == 1).alias("single"), span.cast("int").alias("size"), F.floor(F.col("lo") / PIECE).cast("int").alias("piece"))
    begin = F.col("piece") * PIECE
    raw = docs.where(F.octet_length("text") >= length).select("d1", "d2", F.col("text").cast("binary").alias("raw"))
    last = F.floor((F.octet_length("raw") - 1) / PIECE).cast("int")
    pieces = raw.select("d1", "d2", "raw", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select("d1", "d2", "piece", F.substring("raw", begin + 1, F.lit(PIECE + 2 * length)).alias("part"))
    cut = F.substring("part", (F.col("lo") - begin + 1).cast("int"), F.col("size"))
    snippets = asked.join(pieces, ["d1", "d2", "piece"]).select("key", "d1", "d2", "lo", "single", cut.alias("bytes"))
    snippets = stored(snippets, "snippets")

    large = snippets.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("size")).where(F.col("size") > GRAM_BYTES).select("key")
    flags = whole.union(_by_shard(snippets.join(large, "key", "left_anti"), length))
    return flags.union(_by_window(snippets.join(large, "key", "left_semi"), length))


def _spans(found: list, length: int) -> list[tuple[int, int]]:
    """Removed runs: the union of the windows."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in found or []):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + length)
        else:
            out.append([lo, hi + length])
    return [(a, b) for a, b in out]


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, spans): for each row, the runs of bytes to remove, as (start, end) pairs, with the counts and digest of what is left."""
    if not 8 <= gram <= length:
        raise ValueError("a gram has 8 bytes at least and the window's length at most")
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    column = F.col(f"`{id}`")
    # Two hashes name a row by its id and text; rows equal in both lose the same bytes.
    docs = df.select(column.alias("id"), value.alias("text"), F.xxhash64(column, value).alias("d1"), F.hash(column, value).alias("d2"))
    flags = repeated_ranges(docs.select("d1", "d2", "text"), length, gram)
    listed = flags.groupBy("d1", "d2").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    layout = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def judged(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for value, found in zip(batch.column("text"), batch.column("found").to_pylist()):
                raw = value.as_buffer()
                spans, at, digest = _spans(found, length), 0, hashlib.sha256()
                for a, b in spans:
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                rows.append({"n_bytes": len(raw), "n_removed": sum(b - a for a, b in spans), "n_spans": len(spans), "kept_sha256": digest.hexdigest(), "spans": [{"start": a, "end": b} for a, b in spans]})
            made = pa.RecordBatch.from_pylist(rows, layout)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made.columns], names=["id", *layout.names])

    joined = docs.join(listed, ["d1", "d2"], "left").select("id", "text", "found")
    kind = docs.schema["id"].dataType.simpleString()
    return joined.mapInArrow(judged, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")
