"""What the pipeline hands to Python is bounded in bytes, not in texts."""

import pyarrow as pa

import corpus_pipeline
from ontime.session import TEXT_BATCH


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """The plan runs after the stage has returned, as in ``run``."""
    (key,) = TEXT_BATCH
    rows = [(i, f"w{i} " * 20_000, "en", "a", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    seen = spark.range(0)

    def counted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]}, pa.schema([("n", pa.int64())]))

    assert key not in spark.conf.getAll
    try:
        corpus_pipeline.quality_rules(spark, docs, "")
        seen = docs.mapInArrow(counted, "n long").collect()
        assert sum(r.n for r in seen) == 60 and len(seen) > 1
        # What the session says itself stays.
        spark.conf.set(key, "1m")
        corpus_pipeline.personal_data(spark, docs, "")
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)
