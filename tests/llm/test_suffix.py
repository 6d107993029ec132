"""Suffix arrays against sorting, and removal against a count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ontime.llm import suffix
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(texts, length=200):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.sampled_from([suffix._induce_by_symbol, suffix._induce_in_turn]))
def test_suffix_array(symbols, way):
    s = np.array(symbols + [0], np.int64)
    old = suffix._induce_by_symbol, suffix._induce_in_turn
    suffix._induce_by_symbol = suffix._induce_in_turn = way
    try:
        got = suffix.suffix_array(s).tolist()
    finally:
        suffix._induce_by_symbol, suffix._induce_in_turn = old
    assert got == sorted(range(len(s)), key=lambda i: s[i:].tolist())


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=80), st.integers(1, 40))
def test_common_prefixes(data, most):
    data = np.frombuffer(data, np.uint8)
    rng = np.random.default_rng(len(data))
    a, b = rng.integers(0, len(data) + 1, (2, 30))

    def common(x, y):
        k = 0
        while k < most and max(x, y) + k < len(data) and data[x + k] == data[y + k]:
            k += 1
        return k

    inside = np.maximum(a, b) + most <= len(data)
    got = suffix.permuted_prefixes(data, a[inside], b[inside], most)
    assert got.tolist() == [common(x, y) for x, y in zip(a[inside], b[inside])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=40), max_size=6))
def test_repeated_starts(texts):
    pieces = [t.encode() for t in texts if t]
    seen = Counter(p[i : i + 9] for p in pieces for i in range(len(p) - 8))
    if pieces:
        got = suffix.repeated_starts(pieces, 9)
        assert [m.tolist() for m in got] == [[seen[p[i : i + 9]] > 1 for i in range(max(len(p) - 8, 0))] for p in pieces]


def test_query_on_the_test_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op6_suffix_induced"](spark, SF).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == plain([r.text for r in rows])


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7)))
    some = [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(12)]
    out = [" ".join(rng.choice(some) if rng.random() < 0.5 else word() for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    return out + [out[0], out[0], "a" * 500, "xy" * 150 + "z" + "xy" * 150, "-" * 3000 + out[1], None, "", "short", out[2][:41]]


@pytest.mark.parametrize("seed,shard", [(1, 1 << 20), (2, 4000), (3, 300)])
def test_shared_passages(spark, seed, shard, monkeypatch):
    """Also with shards so small that grams overflow them, pieces so small that texts are cut, and few windows at a time."""
    monkeypatch.setattr(suffix, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix, "GRAM_BYTES", shard)
    monkeypatch.setattr(suffix, "PIECE", 1 << 16 if seed == 1 else 300)
    monkeypatch.setattr(suffix, "_SPAN", 1 << 20 if seed == 1 else 257)
    values = texts(seed)
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(3)
    got = suffix.remove_repeats(df, length=40, gram=12).orderBy("id").collect()
    want = plain(values, 40)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want
    assert sum(w[1] for w in want) > 1000
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in got)


def test_cases(spark):
    same = "".join(chr(97 + i % 23) + chr(97 + i % 7) for i in range(300))
    rows = [(1, same), (1, same), (None, None), (None, same), (2, ""), (3, "x" * 199), (4, "y" * 200), (5, "z" * 100_001)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS d1", "2 AS lo", "'k' AS key", "3 AS raw")
    got = suffix.remove_repeats(df).collect()
    want = [(i, *w) for (i, _), w in zip(rows, plain([t for _, t in rows]))]
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=key) == sorted(want, key=key)
    assert suffix.remove_repeats(df.limit(0)).count() == 0
