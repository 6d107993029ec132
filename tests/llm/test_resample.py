"""Importance resampling against a plain count, and the CRC matrices against the standard library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from ontime.llm import resample
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest=1):
    words = WORD.findall((text or "").translate(UPPER))
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def plain(docs, target, longest=1, percent=10, least=20, buckets=10_000):
    s = Counter(bucket(f, buckets) for _, t in docs for f in features(t, longest))
    t = Counter(bucket(f, buckets) for x in target for f in features(x, longest))
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for key, text in docs:
        found = features(text, longest)
        weight = sum(gain[bucket(f, buckets)] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(features(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        ranks.setdefault(r[0], []).append(k)
    return sorted(((r[0], r[1], r[2], r[3], r[4]) for r in rows), key=str), {k: sorted(v) for k, v in ranks.items()}


def result(df):
    rows = df.select("id", "n_words", "n_features", "weight", "score", "rank").collect()
    ranks = {}
    for r in rows:
        if r["rank"] is not None:
            ranks.setdefault(r.id, []).append(r["rank"])
    return sorted((tuple(r)[:5] for r in rows), key=str), {k: sorted(v) for k, v in ranks.items()}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=200), max_size=40))
def test_crcs(parts):
    assert resample.crcs(parts).tolist() == [zlib.crc32(p) for p in parts]


def test_crcs_of_every_length():
    rng = random.Random(4)
    parts = [rng.randbytes(n) for n in [*range(400), 10_000, 63, 64, 65, 128, 129, 1_000_003]]
    assert resample.crcs(parts).tolist() == [zlib.crc32(p) for p in parts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB9 é漢-_\n\x7f{", max_size=60)), max_size=8), st.integers(1, 3))
def test_features_of_texts(texts, longest):
    known = resample._Buckets(97)
    got = [[] for _ in texts]
    words = [0] * len(texts)
    for buckets, rows, counts in resample.hashed(pa.array(texts, pa.string()), known, longest):
        for b, r in zip(buckets.tolist(), rows.tolist()):
            got[r].append(b)
        for r, n in counts.T.tolist():
            words[r] += n
    assert [sorted(g) for g in got] == [sorted(bucket(f, 97) for f in features(t, longest)) for t in texts]
    assert words == [len(features(t)) for t in texts]


@pytest.mark.parametrize("longest", [1, 3])
def test_a_text_longer_than_a_block_is_cut_between_words(monkeypatch, longest):
    monkeypatch.setattr(resample.B, "BLOCK_BYTES", 64)
    text = " ".join(["word", "x" * 300, "é漢", "B-2", "last"] * 40)
    parts = list(resample._slices(__import__("numpy").frombuffer(text.encode(), "uint8"), 64))
    assert b"".join(parts) == text.encode() and len(parts) > 20
    monkeypatch.setattr(resample, "_slices", lambda data, cut=resample._slices: cut(data, 64))
    found = [b for buckets, _, _ in resample.hashed(pa.array([text]), resample._Buckets(97), longest) for b in buckets.tolist()]
    assert sorted(found) == sorted(bucket(f, 97) for f in features(text, longest))


def test_query_on_the_test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op12_resample_crc"](spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows, ranks = plain(docs, target)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == sorted(((k, f, w, s) for k, _, f, w, s in rows), key=str)
    assert {r.doc_id: [r["rank"]] for r in got.collect() if r["rank"] is not None} == ranks


@pytest.mark.parametrize("longest", [1, 2])
def test_nulls_empty_long_repeated_and_extra_columns(spark, longest):
    good = " ".join(f"W{i % 70}" for i in range(200))
    rows = [(1, None), (2, ""), (3, good), (3, good), (None, good), (4, "é" * 5000 + " " + good * 400), *((k, f"{good} t{k}") for k in range(10, 30))]
    target = ["w1 w2 é", None, good]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS id", "1 AS weight", "2 AS Rank")
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    assert result(resample.resample(df, aims, longest=longest, percent=50)) == plain(rows, target, longest, 50)
    assert resample.resample(df.limit(0), aims).count() == 0
    assert result(resample.resample(df, aims.limit(0), longest=longest, percent=50)) == plain(rows, [], longest, 50)


def test_ties_go_to_the_smaller_id(spark):
    weights = spark.createDataFrame([(k, 30, 30, 0) for k in (9, 7, 8, 7)], "id long, n_words long, n_features long, weight long")
    tied = resample.draw(weights.withColumn("weight", -resample.noise(weights["id"])), percent=75)
    assert sorted((r.id, r["rank"]) for r in tied.collect() if r["rank"]) == [(7, 1), (7, 2), (8, 3)]
