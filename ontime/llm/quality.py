"""Quality rules: how much of a text lies inside repeated word sequences and lines.

Each text is scored by itself, in one pass and without a shuffle. Rolling hashes of word sequences of several lengths mark the
words that lie in a sequence found twice in the text; the share of characters so covered decides. A sequence of n words that
occurs twice begins with three words that occur twice, so all longer lengths look only at those places.

Only later occurrences count towards the limits: of a line or sequence that is set twice, the second is the repetition. With the
first counted as well, as the base rule does, no text between the base rule and a limit would be left to decide on.

Cases: a null or empty text has no words and fails the base rule. Repeated rows are scored alike. Columns of the input are never
read beyond the text, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ontime.llm import textblocks as B

#: As published with the Gopher language model (Rae et al. 2021): the largest share of characters inside later occurrences of sequences of each length, and of lines; the largest
#: share of lines that are later occurrences; symbols for each word.
MOST_REPEATED = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LENGTHS = tuple(MOST_REPEATED)
MOST_LINE_CHARS = 0.20
MOST_LINES = 0.30
MOST_SYMBOLS = 0.10
#: Fewer repeated lines than this are headings, whose share says nothing in a text of three lines.
LEAST_DUP_LINES = 2

MIN_WORDS = 50
#: Percentage of words in repeated three-word windows above which a text fails.
MOST_REPEAT_WORDS = 50
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["dup_line_share", "dup_line_chars", *(f"dup_{n}_chars" for n in LENGTHS)]
SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    + [T.StructField(c, T.DoubleType()) for c in SHARES]
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """True for words inside a window of n words that begins at one of the places."""
    change = np.zeros(total + 1, np.int64)
    change[:total] += np.bincount(starts, minlength=total)
    ends = np.bincount(starts + n, minlength=total + 1)
    return np.cumsum(change - ends)[:total] > 0


def _score(block: B.Block) -> dict[str, np.ndarray]:
    rows, data = block.rows, block.data
    start, end, row = block.words()
    chars = np.concatenate(([0], np.cumsum(block.characters())))
    size = chars[end] - chars[start]
    n_words, word_chars = np.bincount(row, minlength=rows), B.sums(size, row, rows)
    hashes = block.hashes()
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": B.sums(np.ones(len(at := np.flatnonzero(_SYMBOL[data]))), block.row_of(at), rows)}

    # Lines: cut at line feeds and at text bounds.
    cuts = np.unique(np.concatenate((block.bounds[:-1], np.flatnonzero(data == 10) + 1, block.bounds[-1:])))
    line_start, line_end = cuts[:-1], cuts[1:] - (data[cuts[1:] - 1] == 10) if len(cuts) > 1 else cuts[1:]
    first_word = np.searchsorted(start, line_start)
    with_word = (first_word < len(start)) & (line_end > line_start)
    with_word[with_word] = start[first_word[with_word]] < line_end[with_word]
    line_start, line_end = line_start[with_word], line_end[with_word]
    line_row = block.row_of(line_start)
    line_hash = hashes.of(line_start, line_end) ^ B.mix(line_row.astype(np.uint64))
    again = B.later(line_hash)
    line_chars = chars[line_end] - chars[line_start]
    out["n_dup_lines"] = B.sums(again, line_row, rows)
    out["dup_line_share"] = out["n_dup_lines"] / np.maximum(np.bincount(line_row, minlength=rows), 1)
    out["dup_line_chars"] = B.sums(line_chars * again, line_row, rows) / np.maximum(B.sums(line_chars, line_row, rows), 1)

    # Word sequences: the hash of a window is that of its words' hashes, and the row, so that texts never match each other.
    word = B.Rolling(hashes.of(start, end))
    salt = B.mix(row.astype(np.uint64) + np.uint64(1))
    total = len(start)

    def repeats(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of windows found twice, and which of them are not the first of their kind; places ascend."""
        places = places[places <= total - n]
        places = places[row[places] == row[places + n - 1]]
        windows = word.of(places, places + n) ^ salt[places]
        twice = B.repeated(windows)
        places = places[twice]
        return places, B.later(windows[twice])

    three, _ = repeats(np.arange(total), 3)
    out["n_repeat_words"] = B.sums(_covered(three, 3, total), row, rows)
    failed = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEAT_WORDS * n_words)
    lines = (out["dup_line_share"] <= MOST_LINES) | (out["n_dup_lines"] < LEAST_DUP_LINES)
    good = lines & (out["dup_line_chars"] <= MOST_LINE_CHARS) & (out["n_symbols"] <= MOST_SYMBOLS * n_words)
    places = three
    for n in LENGTHS:
        places, again = repeats(places, n)
        share = B.sums(size * _covered(places[again], n, total), row, rows) / np.maximum(word_chars, 1)
        out[f"dup_{n}_chars"] = share
        good &= share <= MOST_REPEATED[n]
    return out | {"base_failed": failed, "kept": ~failed & good}


def score_texts(texts: pa.Array) -> pa.StructArray:
    parts = [_score(block) for block in B.blocks(texts)]
    kinds = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64()}
    arrays = [pa.array(np.concatenate([p[f.name] for p in parts]) if parts else [], kinds[f.dataType]) for f in SCHEMA]
    return pa.StructArray.from_arrays(arrays, names=SCHEMA.names)


def score(text: str | Column) -> Column:
    """A struct of counts, shares and the verdict for each text."""

    def scored(texts: pa.Array) -> pa.Array:
        return score_texts(texts)

    # Not deterministic only by name: else a filter on the verdict would score every text a second time.
    return F.arrow_udf(scored, SCHEMA).asNondeterministic()(text)


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not use, compared as Spark compares names."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text passes every rule, with the columns they came with."""
    verdict = spare_name(df, "quality")
    return df.withColumn(verdict, score(F.col(f"`{text}`"))).where(F.col(verdict)["kept"]).drop(verdict)
