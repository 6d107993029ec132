"""Pfair mixing: deviation below one block, every document placed, and the cases of the docstring."""

from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ontime.llm import mixing
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=2), st.integers(1, 40), min_size=1, max_size=8))
def test_less_than_one_block_off_at_every_slot(parts):
    total, slots = sum(parts.values()), mixing.period(parts)
    assert sorted(t for s in slots.values() for t in s) == list(range(total))
    order = {t: k for k, s in slots.items() for t in s}
    done = Counter()
    for t in range(total):
        done[order[t]] += 1
        assert all(abs(done[k] * total - parts[k] * (t + 1)) < total for k in parts)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text("abcd", min_size=1, max_size=3), st.floats(1e-6, 1e6), min_size=1, max_size=20))
def test_whole_parts(weights):
    parts = mixing.whole_parts(weights, 1000)
    assert sum(parts.values()) == 1000 and min(parts.values()) >= 1
    spare = 1000 - len(weights)
    assert all(abs(parts[k] - 1 - spare * w / sum(weights.values())) < 1.0001 for k, w in weights.items())


def test_too_many_sources_are_refused():
    with pytest.raises(ValueError):
        mixing.whole_parts({str(i): 1.0 for i in range(11)}, 10)


def plain_slots(rows, parts, block):
    """rows: (source key, size) in the order of the source, with what the schedule gives each."""
    slots, total, begun, out = mixing.period(parts), sum(parts.values()), Counter(), []
    for key, size in rows:
        b = begun[key] // block
        begun[key] += size
        out.append((b, b // len(slots[key]) * total + slots[key][b % len(slots[key])]))
    return out


def test_query_against_a_plain_run(spark):
    docs = {r.doc_id: (r.source, len(r.text or "")) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op4_mix_sources"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    sizes = Counter()
    for s, n in docs.values():
        sizes["=" + s] += n
    parts = mixing.whole_parts({k: n**0.5 for k, n in sizes.items()})
    hashed = {r.doc_id: (r.h, r.doc_id) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    slices = max(mixing.SLICES, len(docs) // mixing.SLICE_ROWS)
    order = sorted(docs, key=lambda d: (hashed[d][0] % slices, hashed[d]))
    want = plain_slots([("=" + docs[d][0], docs[d][1]) for d in order], parts, mixing.BLOCK)
    assert {r.doc_id: (r.block, r.slot) for r in got} == dict(zip(order, want))


def test_shares_hold_until_a_source_runs_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 50)
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"))
    got = mixing.interleave(df, {"=hot": 1, "=cold": 3}, "source", F.lit(10), ["id"], block=100).collect()
    blocks = defaultdict(set)
    for r in got:
        blocks[r.source].add((r.block, r.slot))
    assert {k: len(v) for k, v in blocks.items()} == {"hot": 400, "cold": 200}
    assert all(n == 10 for n in Counter((r.source, r.block) for r in got).values())
    last = max(s for _, s in blocks["cold"])
    hot = sum(s <= last for _, s in blocks["hot"])
    assert abs(hot - (last + 1) / 4) < 1


def test_cases(spark):
    rows = [(1, None, "a" * 500), (2, None, None), (3, "", ""), (3, "", ""), (4, "x", "b" * 5000), (4, "x", "b" * 5000), (None, "x", "c")]
    df = spark.createDataFrame(rows, "id long, source string, text string").selectExpr("*", "7 AS slot", "8 AS BLOCK", "'r' AS row", "1 AS h", "2 AS key")
    size = F.length("text")
    parts = mixing.tempered_weights(df, "source", size, parts=100)
    assert set(parts) == {"", "=", "=x"}
    out = mixing.interleave(df, parts, "source", size, ["id"], block=1000)
    assert out.columns == [*df.columns, "block_", "slot_"]
    got = out.collect()
    assert sorted((r.id or 0) for r in got) == [0, 1, 2, 3, 3, 4, 4]
    assert {r.slot for r in got} == {7}
    assert len({r.slot_ for r in got if r.id == 4}) == 2
    assert mixing.interleave(df.limit(0), {}, "source", size, ["id"]).count() == 0
    assert mixing.tempered_weights(df.limit(0), "source", size) == {}


def test_more_sources_than_parts(spark):
    """The period grows: every source has its part, and weights stay near their targets."""
    df = spark.range(10_300).select("id", F.when(F.col("id") < 300, "large").otherwise(F.concat(F.lit("s"), "id")).alias("source"))
    size = F.when(F.col("id") < 300, F.lit(1_000_000)).otherwise(F.lit(100)).cast("long")
    parts = mixing.tempered_weights(df, "source", size)
    assert len(parts) == 10_001 and min(parts.values()) >= 1
    large = 3e8**0.5
    target = large / (large + 10_000 * 10)
    assert abs(parts["=large"] / sum(parts.values()) - target) < target / 10
    got = mixing.interleave(df, parts, "source", size, ["id"]).collect()
    assert sorted(r.id for r in got) == list(range(10_300))
    assert all(0 <= r.slot for r in got) and len({r.slot for r in got if r.id >= 300}) == 10_000
