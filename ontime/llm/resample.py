"""Target-distribution importance resampling: documents drawn in proportion to how much more likely their features are in a target.

Features are runs of consecutive words, hashed to a fixed number of buckets by CRC-32. A bucket's gain is the logarithm of its share in the
target over its share in the documents, both smoothed by one; a document's weight is the sum of its features' gains, and the draw takes
the highest weights after adding Gumbel noise that depends on the id alone (so it is the same in every run).

The CRCs of a block of texts are worked out together: its distinct features are grouped by length into matrices of bytes, one row
a feature, and a whole column updates all rows' registers at a time. Features longer than ``ROW`` bytes lie in several rows of that
length (zero bytes in front leave an empty register as it is) and their rows' registers are joined, which a table lookup for each byte
does, since a CRC is linear. The counts of a task are one vector over the buckets; tasks send no more than one row a bucket.

The gains reach the tasks as one fixed-size vector, whatever the input. The draw ranks by range partitions, not in one task.

Cases: a null or empty text has no features and weight 0. Long texts are read whole, cut between words while they are hashed. Repeated
rows count as often as they occur, and each has a rank of its own. A null id is hashed as an empty one and comes after all
others in ties. Empty documents or an empty target leave the smoothing: no gain is undefined. An empty table gives an empty table.
Columns beyond id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ontime.llm import textblocks as B
from ontime.llm.tables import stored
from ontime.operators.ordered import positions

BUCKETS = 10_000
#: Longest run of words that is a feature.
LONGEST = 1
#: Seed of the noise, least number of words of a document that may be drawn, and percentage drawn.
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
#: Bytes of a matrix row for features longer than that.
ROW = 64

_FULL = np.uint32(0xFFFFFFFF)


def _registers() -> np.ndarray:
    """What a CRC-32 register with one low byte set becomes after eight bits (polynomial 0xEDB88320, bits reversed)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


TABLE = _registers()


def _advance(register: np.ndarray, column: np.ndarray | int) -> np.ndarray:
    return TABLE[(register ^ column) & 0xFF] ^ (register >> np.uint32(8))


def _zeros(n: int) -> np.ndarray:
    """Four tables by which a register moves on over n zero bytes: one for each of its bytes."""
    out = np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    for _ in range(n):
        out = _advance(out, 0)
    return out


_OVER_ROW = _zeros(ROW)


def _short(matrix: np.ndarray) -> np.ndarray:
    """CRCs of the rows of a matrix of bytes."""
    register = np.full(len(matrix), _FULL)
    for column in np.ascontiguousarray(matrix.T):
        register = _advance(register, column)
    return register ^ _FULL


def _long(features: list[bytes]) -> np.ndarray:
    """CRCs of features of any length above four bytes, as rows of one matrix."""
    sizes = np.array([len(f) for f in features])
    rows = -(-sizes // ROW)
    ends = np.cumsum(rows)
    data = np.zeros(int(ends[-1]) * ROW, np.uint8)
    source = np.frombuffer(b"".join(features), np.uint8)
    first = ends * ROW - sizes
    place = np.repeat(first - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(len(source))
    data[place] = source
    # A register that starts full instead of empty is the same as the first four bytes inverted.
    data[(first[:, None] + np.arange(4)).ravel()] ^= 0xFF
    part = np.zeros(len(data) // ROW, np.uint32)
    for column in np.ascontiguousarray(data.reshape(-1, ROW).T):
        part = _advance(part, column)
    # Longest first, so that the features that still have a row to join are a prefix.
    order = np.argsort(-rows, kind="stable")
    starts, left = (ends - rows)[order], rows[order]
    register = np.zeros(len(features), np.uint32)
    for k in range(int(left[0])):
        n = int(np.searchsorted(-left, -k, side="left"))
        r = register[:n]
        moved = _OVER_ROW[0][r & 0xFF] ^ _OVER_ROW[1][(r >> 8) & 0xFF] ^ _OVER_ROW[2][(r >> 16) & 0xFF] ^ _OVER_ROW[3][r >> 24]
        register[:n] = moved ^ part[starts[:n] + k]
    out = np.empty(len(features), np.uint32)
    out[order] = register ^ _FULL
    return out


def crcs(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each feature."""
    sizes = np.array([len(f) for f in features], np.int64)
    out = np.zeros(len(features), np.uint32)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts):
        if not len(group) or not (n := int(sizes[group[0]])):
            continue
        if n > ROW:
            break
        out[group] = _short(np.frombuffer(b"".join([features[i] for i in group]), np.uint8).reshape(-1, n))
    rest = order[int(np.searchsorted(sizes[order], ROW, side="right")) :]
    if len(rest):
        out[rest] = _long([features[i] for i in rest])
    return out


# ---- features ----------------------------------------------------------------------------------

#: Bytes of words: digits, letters, and all bytes beyond ASCII; others become a blank.
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.lower().translate(_WORD_BYTES).split()


def _slices(data: np.ndarray, limit: int = B.BLOCK_BYTES) -> Iterator[bytes]:
    """A long text in parts that are cut after a byte of no word; a word of any length stays whole."""
    at = 0
    blank = np.frombuffer(_WORD_BYTES, np.uint8) == 32
    while at < len(data):
        end = at + limit
        while end < len(data):
            inside = np.flatnonzero(blank[data[end : end + limit]])
            if len(inside):
                end += int(inside[0]) + 1
                break
            end += limit
        yield data[at:end].tobytes()
        at = end


class _Buckets:
    """Buckets of features, those of the latest blocks remembered."""

    def __init__(self, buckets: int, remembered: int = 1 << 18):
        self.n, self.remembered, self.known = buckets, remembered, {}

    def of(self, features: list[bytes]) -> np.ndarray:
        missing = list(set(features).difference(self.known))
        if len(self.known) + len(missing) > self.remembered:
            self.known = {}
            missing = list(set(features))
        self.known.update(zip(missing, (crcs(missing) % np.uint32(self.n)).tolist()))
        return np.fromiter(map(self.known.__getitem__, features), np.int64, len(features))


def _runs(words: list[bytes], before: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` words that end in ``words``; ``before`` are the words ahead of them."""
    if longest == 1:
        return words
    line = before + words
    skip = len(before)
    out = list(words)
    for n in range(2, longest + 1):
        out += [b" ".join(line[i : i + n]) for i in range(max(0, skip - n + 1), len(line) - n + 1)]
    return out


def hashed(texts: pa.Array, buckets: _Buckets, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of a column of texts, in order: bucket and row of each feature, and the number of words of each row of the part.

    A long text comes in several parts.
    """
    for block in B.blocks(texts):
        if block.rows == 1:
            before: list[bytes] = []
            for part in _slices(block.data):
                words = words_of(part)
                features = _runs(words, before, longest)
                yield buckets.of(features), np.full(len(features), block.first), _counts(block, [len(words)])
                before = (before + words)[-(longest - 1) :] if longest > 1 else []
            if not len(block.data):
                yield np.zeros(0, np.int64), np.zeros(0, np.int64), _counts(block, [0])
            continue
        data, cuts = block.data.tobytes(), block.bounds.tolist()
        words = [words_of(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        features = [_runs(w, [], longest) for w in words]
        rows = np.repeat(np.arange(block.first, block.first + block.rows), [len(f) for f in features])
        yield buckets.of(list(chain.from_iterable(features))), rows, _counts(block, [len(w) for w in words])


def _counts(block: B.Block, n: list[int]) -> np.ndarray:
    """Row and number of words."""
    return np.stack([np.arange(block.first, block.first + block.rows), np.array(n, np.int64)])


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) over all texts; a task sends at most one row a bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), _Buckets(buckets)
        for batch in batches:
            for bucket, _, _ in hashed(batch.column(0), known, longest):
                total += np.bincount(bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met])], names=["bucket", "n"])

    return df.select(F.col(f"`{text}`").alias("text")).mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the ``bucket_counts`` of the documents and of the target."""
    joined = (
        source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    )
    sums = joined.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).first()
    up = (F.col("t") + 1) * F.lit(float(sums.all_s + buckets))
    down = (F.col("s") + 1) * F.lit(float(sums.all_t + buckets))
    return joined.select("bucket", F.floor(1000 * F.log(up / down)).cast("long").alias("gain"))


def weighted(df: DataFrame, gain: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(id, n_words, n_features, weight) for each row. The driver reads one number a bucket."""
    vector = np.zeros(buckets, np.int64)
    for r in gain.collect():
        vector[r.bucket] = r.gain
    session = df.sparkSession
    shared = session.sparkContext.broadcast(vector)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains_of, known = shared.value, _Buckets(buckets)
        for batch in batches:
            n = batch.num_rows
            words, features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for bucket, rows, counts in hashed(batch.column(1), known, longest):
                np.add.at(words, counts[0], counts[1])
                features += np.bincount(rows, minlength=n)
                # Whole numbers throughout: a sum of doubles would be inexact for very long texts.
                if len(rows):
                    begins = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
                    weight[rows[begins]] += np.add.reduceat(gains_of[bucket], begins)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))], names=["id", "n_words", "n_features", "weight"])

    kind = df.schema[key].dataType.simpleString()
    taken = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return taken.mapInArrow(weighed, f"id {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: str = SEED) -> Column:
    """Whole thousandths of Gumbel noise from the id: the first 32 bits of a digest as a uniform number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(weights: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """All rows with their score; the drawn ones with their rank from 1, by falling score and then by id."""
    # Kept: both halves of the result read it, and texts should be weighed once.
    scored = stored(weights.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    able = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    ranked = positions(scored.where(able), [], order)
    drawn = ranked.count() * percent // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1).cast("long").alias("rank")
    columns = ["id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, rank).union(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST, **drawing) -> DataFrame:
    """Every document with its weight and score; the drawn ones with a rank."""
    # Kept, as the sums and the gains both read them: texts are hashed once for the counts and once for the weights.
    counts = [stored(bucket_counts(df, column, buckets, longest), "buckets") for df, column in ((docs, text), (target, "text"))]
    gain = gains(*counts, buckets)
    return draw(weighted(docs, gain, key, text, buckets, longest), **drawing)
