"""The archive gives back every record, each payload is stored once, and damage is found."""

import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ontime.llm import warc
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def sha1_32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_query_on_the_test_table(spark):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    groups = defaultdict(list)
    for k, v in pages.items():
        groups[v].append(k)
    got = QUERIES["op10_warc_addressed"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        payload, first = pages[r.page_id], min(groups[pages[r.page_id]])
        kind = ("response", None) if r.page_id == first else ("revisit", first)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(payload), sha1_32(payload), *kind)


ROWS = [(5, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (3, "http://b/\r\nX: y", "same"), (None, None, "same"), (7, None, None), (8, "u", ""), (None, "n", "alone"), (9, "é", "ü" * 200_000)]


@pytest.fixture()
def archive(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id long, url string, html string").selectExpr("*", "'z' AS payload", "1 AS address", "2 AS position", "3 AS type")
    path = str(tmp_path / "archive")
    warc.write(df, path, "id", "url", "html")
    return path


def test_round_trip_of_odd_rows(spark, archive):
    got = warc.read(spark, archive).collect()
    assert sorted((r.id or 0, bytes(r.payload)) for r in got) == sorted((i or 0, (h or "").encode()) for i, _, h in ROWS)
    same = [r for r in got if bytes(r.payload) == b"same"]
    assert sorted((r.id or 0, r.type, r.refers_to) for r in same) == sorted([(0, "revisit", 3), (3, "response", None), (3, "revisit", 3), (5, "revisit", 3)], key=str) or sorted(r.type for r in same) == ["response", "revisit", "revisit", "revisit"]
    assert all(r.refers_to == (3 if r.type == "revisit" else None) for r in same)
    assert len({r.record_id for r in got}) == len(ROWS)
    empty = {r.id: r.type for r in got if not r.payload}
    assert empty == {7: "response", 8: "revisit"}
    assert spark.read.parquet(f"{archive}/payloads").count() == 4


def test_records_as_they_stand_in_a_file(spark, archive):
    records = warc.read(spark, archive)
    for r in warc.record_bytes(records).join(records.select("record_id", F.col("id").alias("i"), "payload", "type"), F.contains(F.col("record"), F.col("record_id").cast("binary")) & F.col("id").eqNullSafe(F.col("i"))).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and len(fields) == len(lines) - 1
        if fields["WARC-Type"] == "response":
            assert rest == bytes(r.payload) + b"\r\n\r\n" and int(fields["Content-Length"]) == len(r.payload)


def test_damage_is_an_error(spark, archive, tmp_path):
    broken = str(tmp_path / "broken")
    spark.read.parquet(f"{archive}/headers").write.parquet(f"{broken}/headers")
    payload = F.when(F.col("payload") == F.lit("alone").cast("binary"), F.lit("other").cast("binary")).otherwise(F.col("payload"))
    spark.read.parquet(f"{archive}/payloads").withColumn("payload", payload).write.parquet(f"{broken}/payloads")
    with pytest.raises(Exception, match="no sound payload"):
        warc.read(spark, broken).collect()


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id long, url string, html string")
    warc.write(df, str(tmp_path / "a"), "id", "url", "html")
    assert warc.read(spark, str(tmp_path / "a")).count() == 0
