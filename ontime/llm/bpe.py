"""Byte-level BPE, encoded and decoded as a tree of joins.

An element is a stretch of text, encoded as if it stood alone: where its pattern matches end, how many ids each match has, and the
ids. Elements form a monoid (the empty stretch is its identity), so a text is encoded by halves and neighbours are joined:

* Matches. Whether a match stays does not depend on characters two or more beyond its end, and what follows a match's end depends
  only on the text from there on. So a join keeps the left matches that end two characters before the boundary, matches again from
  there, one match at a time, and stops at the first end that the right side has too: all matches beyond it are the right side's.
* Tokens of a match that the boundary cuts. If each two neighbours of a token sequence encode to themselves, the sequence is the
  encoding of its bytes, and every stretch of an encoding is the encoding of its own bytes: the first merge that would cross a bound
  would be the best merge of those two tokens alone as well. So a window around the boundary is encoded anew and grows, on the side
  that has not settled, until its outermost tokens stand beside their outer neighbours unchanged. Then all tokens outside are final.

Both hold for windows of any size, up to the whole of both sides, so the result is exact, whatever the text. Stretches are cut at the
largest power of two below their length: long runs of one character then meet at multiples of the longest token, where nothing moves.
Decoding concatenates the tokens' bytes up a tree of the same kind.

Texts are encoded row by row without a shuffle; the files of the vocabulary are read where they are needed and never copied.

Cases: a null or empty text has no ids, and no ids decode to no bytes. Long texts are read whole; a run of any length is one match.
Strings of special tokens are ordinary text. Repeated rows are encoded each. Columns beyond the text are never read. A match that is
a vocabulary entry by itself is that one id, also where merges would not arrive there. Ids outside the vocabulary are an error when
decoding. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import gc
import heapq
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import accumulate, chain

import pyarrow as pa
import regex
import tiktoken
import unicodedata
from pyspark.sql import Column, functions as F, types as T

#: Characters and bytes up to which a stretch is encoded directly, and ids up to which it is decoded directly.
LEAF_CHARS = 1024
LEAF_BYTES = 16
LEAF_IDS = 1024
#: Bytes above which neighbours wait in a queue, and a number above all ranks.
LONG_WINDOW = 128
NONE = 1 << 32
#: Two ids in one number; ids are smaller than that.
SHIFT = 32
#: Matches and token pairs that a worker remembers at a time, and the longest match it does.
REMEMBERED = 1 << 18
LONGEST_REMEMBERED = 64


def half(n: int) -> int:
    """The largest power of two below n."""
    return 1 << (n - 1).bit_length() - 1


class Words:
    """Tokens of single matches: merges by rank on bytes, and joins of their results."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        # What two tokens merge to, which is also the rank of that merge.
        splits = ((ranks.get(b[:i]), ranks.get(b[i:]), token) for b, token in ranks.items() for i in range(1, len(b)))
        self.merge = {x << SHIFT | y: token for x, y, token in splits if x is not None and y is not None}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until none is in the vocabulary."""
        if len(data) > LONG_WINDOW:
            return self.merged_by_queue(data)
        get = self.merge.get
        parts = [self.single[b] for b in data]
        ranks = [get(a << SHIFT | b, NONE) for a, b in zip(parts, parts[1:])]
        ranks.append(NONE)
        while (best := min(ranks)) != NONE:
            i = ranks.index(best)
            parts[i] = best
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << SHIFT | best, NONE)
            if i + 1 < len(parts):
                ranks[i] = get(best << SHIFT | parts[i + 1], NONE)
        return parts

    def merged_by_queue(self, data: bytes) -> list[int]:
        """The same for long windows: a queue of neighbours by rank instead of a search for each merge."""
        n, rank = len(data), self.ranks.get
        start, after, before = list(range(n + 1)), list(range(1, n + 2)), list(range(-1, n))
        ends = list(range(1, n + 1))
        queue = [(r, i) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            # An entry is out of date if its left part is gone or what both parts spell has changed.
            if ends[i] < 0 or j >= n or rank(data[start[i] : ends[j]]) != r:
                continue
            ends[i], after[i] = ends[j], after[j]
            ends[j] = -1
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(data[i : ends[after[i]]])) is not None:
                    heapq.heappush(queue, (r, i))
            if before[i] >= 0 and (r := rank(data[before[i] : ends[i]])) is not None:
                heapq.heappush(queue, (r, before[i]))
        return [self.ranks[data[i : ends[i]]] for i in range(n) if ends[i] > 0]

    def apart(self, a: int, b: int) -> bool:
        """Whether two tokens side by side encode to themselves."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both sides' bytes together, from the encoding of each."""
        if not left or not right:
            return left or right
        i, j, width, of = len(left), 0, 1, self.bytes_of.__getitem__
        window: list[int] = []
        while True:
            first, last = (window[0], window[-1]) if window else (right[0], left[-1])
            left_moves = i > 0 and not self.apart(left[i - 1], first)
            right_moves = j < len(right) and not self.apart(last, right[j])
            if not left_moves and not right_moves:
                return left[:i] + window + right[j:]
            i = max(0, i - width) if left_moves or not window else i
            j = min(len(right), j + width) if right_moves or not window else j
            window = self.merged(b"".join(map(of, left[i:])) + b"".join(map(of, right[:j])))
            width *= 2

    def tree(self, data: bytes) -> list[int]:
        n = len(data)
        if n <= LEAF_BYTES:
            return self.merged(data)
        middle = half(n)
        return self.join(self.tree(data[:middle]), self.tree(data[middle:]))

    def encode(self, data: bytes) -> list[int]:
        known = self.ranks.get(data)
        return [known] if known is not None else self.tree(data)


class Element:
    """Ends of matches (in characters of the whole text), ids for each match, and the ids."""

    __slots__ = ("start", "ends", "sizes", "ids")

    def __init__(self, start: int, ends: list[int], sizes: list[int], ids: list[int]):
        self.start, self.ends, self.sizes, self.ids = start, ends, sizes, ids


class Codec:
    """One vocabulary with its pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.words = Words(ranks)
        self.plain = regex.compile(pattern)
        self.differ, self.careful = _careful(pattern)
        # Matches met lately, and those met before that, so that frequent ones are never forgotten.
        self.known: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}

    # ---- encoding

    def match_ids(self, match: str) -> tuple[int, ...]:
        ids = self.known.get(match) or self.before.get(match)
        if ids is None:
            ids = tuple(self.words.encode(match.encode()))
        if len(match) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.known, self.before = {}, self.known
            self.known[match] = ids
        return ids

    def leaf(self, text: str, start: int, end: int, pattern) -> Element:
        matches = pattern.findall(text[start:end])
        known = self.known
        codes = [known.get(m) or self.match_ids(m) for m in matches]
        ends = list(accumulate(map(len, matches), initial=start))
        return Element(start, ends[1:], list(map(len, codes)), list(chain.from_iterable(codes)))

    def join(self, text: str, left: Element, right: Element, pattern) -> Element:
        if not left.ends or not right.ends:
            return left if left.ends else right
        bound, stop = right.start, right.ends[-1]
        # Left matches that the text beyond the boundary cannot change.
        i = len(left.ends)
        while i and left.ends[i - 1] > bound - 2:
            i -= 1
        at = left.ends[i - 1] if i else left.start
        # Ids of the matches on either side of the boundary, to be taken over where the same match is found again.
        found: dict[tuple[int, int], list[int]] = {}
        cut = len(left.ids)
        for k in range(len(left.ends) - 1, i - 1, -1):
            begin = left.ends[k - 1] if k else left.start
            found[begin, left.ends[k]] = left.ids[cut - left.sizes[k] : cut]
            cut -= left.sizes[k]
        j, taken = 0, 0

        ends, sizes, ids = [], [], []
        for m in pattern.finditer(text, at, stop):
            begin, end = m.span()
            while j < len(right.ends) and right.ends[j] <= end:
                found[right.ends[j - 1] if j else bound, right.ends[j]] = right.ids[taken : taken + right.sizes[j]]
                taken += right.sizes[j]
                j += 1
            code = found.get((begin, end))
            if code is None:
                one, two = found.get((begin, bound)), found.get((bound, end))
                whole = text[begin:end]
                if one is not None and two is not None and len(whole) > LEAF_BYTES:
                    rank = self.words.ranks.get(whole.encode()) if len(whole) <= LONGEST_REMEMBERED else None
                    code = [rank] if rank is not None else self.words.join(self.pure(one, text[begin:bound]), self.pure(two, text[bound:end]))
                else:
                    code = self.match_ids(whole)
            ends.append(end)
            sizes.append(len(code))
            ids.extend(code)
            if end >= bound and (end == bound and j == 0 or j and right.ends[j - 1] == end):
                break
        return Element(left.start, left.ends[:i] + ends + right.ends[j:], left.sizes[:i] + sizes + right.sizes[j:], left.ids[:cut] + ids + right.ids[taken:])

    def pure(self, ids: list[int], match: str) -> list[int]:
        """What merges alone give for a match: a match that is one id may owe it to the vocabulary."""
        return ids if len(ids) > 1 else self.words.tree(match.encode())

    def element(self, text: str, start: int, end: int, pattern) -> Element:
        n = end - start
        if n <= LEAF_CHARS:
            return self.leaf(text, start, end, pattern)
        middle = start + half(n)
        return self.join(text, self.element(text, start, middle, pattern), self.element(text, middle, end, pattern), pattern)

    def encode(self, text: str | None) -> array:
        if not text:
            return array("I")
        pattern = self.plain if text.isascii() or self.differ.isdisjoint(text) else self.careful
        return array("I", self.element(text, 0, len(text), pattern).ids)

    # ---- decoding

    def decode(self, ids: array) -> bytes:
        n = len(ids)
        if n <= LEAF_IDS:
            return b"".join(map(self.words.bytes_of.__getitem__, ids))
        middle = half(n)
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _careful(pattern: str) -> tuple[set[str], regex.Pattern]:
    """Letters and numbers of this pattern engine that are none in tiktoken's, which knows an older Unicode; and the pattern
    without them. Both engines agree on what the Python's own tables have."""
    one_byte = {bytes([b]): b for b in range(256)}
    differ, careful = set(), pattern
    for kind in (r"\p{L}", r"\p{N}"):
        ours = regex.compile(kind)
        new = "".join(c for c in map(chr, chain(range(0xD800), range(0xE000, 0x110000))) if unicodedata.category(c) == "Cn")
        new = "".join(ours.findall(new))
        theirs = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=one_byte, special_tokens={})
        missing = sorted(set(new) - set(bytes(theirs.encode_ordinary(new)).decode()))
        if missing:
            careful = careful.replace(kind, f"[{kind}--[{''.join(missing)}]]")
            differ.update(missing)
    return differ, regex.compile(careful, regex.V1)


@lru_cache(maxsize=4)
def codec_at(ranks_path: str, pattern: str) -> Codec:
    """Loaded once for each worker."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Codec(ranks, pattern)


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


@contextmanager
def _no_cycles() -> Iterator[None]:
    """Without the search for cyclic garbage, of which encoding makes none: it would go through all remembered matches again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def _little(ids: array) -> array:
    if ids.itemsize != 4:
        raise RuntimeError("this platform's unsigned int has not 32 bits")
    if array("H", [1]).tobytes() != b"\x01\x00":
        ids = ids[:]
        ids.byteswap()
    return ids


def encode(text: str | Column, ranks_path: str, pattern: str) -> Column:
    """Ids of each text as binary: unsigned 32-bit whole numbers, lowest byte first."""

    def encoded(texts: pa.Array) -> pa.Array:
        codec = codec_at(ranks_path, pattern)
        with _no_cycles():
            return _binary([_little(codec.encode(t.as_py())).tobytes() for t in texts])

    # Not deterministic only by name: else each use of the ids would encode the text again.
    return F.arrow_udf(encoded, T.BinaryType()).asNondeterministic()(text)


def decode(ids: str | Column, ranks_path: str, pattern: str) -> Column:
    """Bytes that ids, as ``encode`` gives them, stand for; null ids stand for none."""

    def decoded(rows: pa.Array) -> pa.Array:
        codec = codec_at(ranks_path, pattern)
        return _binary([codec.decode(_little(array("I", r.as_py() or b""))) for r in rows])

    return F.arrow_udf(decoded, T.BinaryType()).asNondeterministic()(ids)


def round_trip(text: str | Column, ranks_path: str, pattern: str) -> Column:
    """A struct of both: the ids of each text, and the bytes that these ids decode to. One worker holds the vocabulary, not two."""

    def both(texts: pa.Array) -> pa.Array:
        codec = codec_at(ranks_path, pattern)
        ids, decoded = [], []
        with _no_cycles():
            for t in texts:
                coded = codec.encode(t.as_py())
                ids.append(_little(coded).tobytes())
                decoded.append(codec.decode(coded))
        return pa.StructArray.from_arrays([_binary(ids), _binary(decoded)], names=["ids", "decoded"])

    return F.arrow_udf(both, "ids binary, decoded binary").asNondeterministic()(text)
