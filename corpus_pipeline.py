"""The corpus pipeline: documents in, packed sequences out, each stage written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ontime.llm import jaccard, mixing, pii, quality
from ontime.llm.queries import pack_documents
from ontime.session import bound_batches, fresh_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    bound_batches(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that links of similar word shingles connect, the document of smallest id."""
    bound_batches(spark)
    return jaccard.keep_first(docs, percent=80, width=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked. The field learns from these documents' own pattern matches."""
    bound_batches(spark)
    return pii.mask(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mixture in which large sources are held back."""
    size = F.length("text")
    parts = mixing.tempered_weights(docs, "source", size)
    mixed = mixing.interleave(docs, parts, "source", size, ["doc_id"])
    slot = mixed.columns[-1]
    return mixing.in_order(mixed, slot, ["doc_id"]).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents, with their place in a sequence. Sequences follow the order in which the mixture was written: its
    files are ranges of slots by name, and rows keep their place inside a file however it is read."""
    # The number of a file's task has five digits or more; the count of them comes first, so that texts are in the order of numbers.
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    place = F.concat(F.lpad(F.length(number).cast("string"), 2, "0"), number, F.lit("/"), F.col("_metadata.file_name"), F.lit("/"), F.lpad(F.col("_metadata.row_index").cast("string"), 19, "0"))
    return pack_documents(docs, place=place)


STAGES = [
    ("quality", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal-data", personal_data),
    ("mixture", mixture),
    ("packing", packing),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
