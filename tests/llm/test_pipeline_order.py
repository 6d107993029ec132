"""Packing follows the order in which the mixture was written, and nothing else of it."""

from pyspark.sql import functions as F

import corpus_pipeline
from ontime.llm import packing


def test_packing_follows_the_written_order(spark, tmp_path, monkeypatch):
    """Rows in an order that no schedule would give, over several files: pieces of a sequence are neighbours in it."""
    monkeypatch.setattr(packing, "SHARD", 20)
    rows = [(i, f"w{i} " * 400, "en", "ab"[i % 2], 0) for i in range(400)]
    place = {i: (i * 37) % 400 for i in range(400)}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    at = F.pmod(F.col("doc_id") * 37, F.lit(400))
    df.repartitionByRange(7, at).sortWithinPartitions(at).write.parquet(f"{tmp_path}/mixed")
    got = corpus_pipeline.packing(spark, spark.read.parquet(f"{tmp_path}/mixed"), "").collect()
    assert {r.doc_id for r in got} == set(place)
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append(place[r.doc_id])
    assert max(max(s) - min(s) for s in spans.values()) <= 2 * 20
    order = [place[r.doc_id] for r in sorted(got, key=lambda r: (r.sequence_id, r.offset))]
    assert all(abs(i - n * 400 / len(order)) <= 2 * 20 for n, i in enumerate(order))
