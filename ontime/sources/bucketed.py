"""Tables stored by key: equal keys lie in equally numbered buckets, sorted, so that joins on the key move no row."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ontime.session import WIDE_STAGES, fresh_dir, settings


def write_bucketed(df: DataFrame, keys: list[str], buckets: int, table: str | None = None, path: str | None = None) -> str:
    """Store as a table of the session's catalog and give its name. Rows are shuffled once, here: each bucket becomes one sorted
    file, so keys should spread well; a key that repeats often belongs to another kind of table."""
    spark = df.sparkSession
    table = table or f"ontime_{uuid.uuid4().hex}"
    with settings(spark, WIDE_STAGES):
        # The same hash deals out rows to tasks and names buckets, so a task holds exactly its bucket's rows.
        dealt = df.repartition(buckets, *keys)
        dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path or fresh_dir(spark, "bucketed")).mode("overwrite").saveAsTable(table)
    return table


def join_bucketed(spark: SparkSession, left: str, right: str, keys: list[str], how: str = "inner") -> DataFrame:
    """Join two such tables of equally many buckets on their keys. Buckets meet where they lie; a broadcast would move one side."""
    return spark.table(left).hint("merge").join(spark.table(right), keys, how)
