"""A content-addressed WARC archive: payload bytes once, record headers exactly and apart, records put together again by joins.

The archive is a folder of two Parquet tables. ``payloads`` holds each distinct payload under its SHA-256; ``headers`` holds
the exact header bytes of every record and the address of its payload. The payload's first record, by id, is the response;
later ones are revisits that refer to it. Reading joins the two and checks length and both digests of what comes out; a payload
that does not match its address is an error, never a silent row.

Cases: null html is an empty payload; empty payloads are stored and revisited like others. A null id comes after all ids; rows with equal ids and payloads
are told apart by their position, so exactly one is the response. A null URL leaves its header line out; line breaks in URLs are escaped. Extra columns of the input are
not archived. A payload that a third of all rows share is stored once, and its rows are only counted, not gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontime.session import fresh_dir

#: Fixed values of the format (RFC 4648 base 32, WARC 1.1).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
#: The table holds no time of capture; one is given for all.
DATE = "1970-01-01T00:00:00Z"


def base32(digest_hex: Column) -> Column:
    """Upper-case base 32 of a SHA-1 in hex: 40 bits, eight symbols, at a time."""
    symbols = []
    for part in range(4):
        bits = F.conv(F.substring(digest_hex, 1 + 10 * part, 10), 16, 10).cast("long")
        symbols += [F.substring(F.lit(BASE32), (F.shiftright(bits, 35 - 5 * i).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for i in range(8)]
    return F.concat(*symbols)


def _record_id(position: Column, address: Column) -> Column:
    h = F.md5(F.concat_ws(":", position, address))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header(date: str) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END))

    revisit = F.col("type") == "revisit"
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.1" + END),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.col("first_record_id")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes"))),
        F.lit(END),
    ).cast("binary")


def write(df: DataFrame, path: str, id: str, url: str, html: str, date: str = DATE) -> None:
    """Write the archive folder. Payload bytes move once, to drop copies; everything else moves digests."""
    spark = df.sparkSession
    payload = F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit("").cast("binary"))
    pages = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    pages = pages.withColumns({"address": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})

    # Positions are given once and kept: they tell equal rows apart, and a second run of a task could give others.
    listed = fresh_dir(spark, "warc-listed")
    pages.select("id", "url", "address", "bytes", base32(F.sha1("payload")).alias("digest"), F.monotonically_increasing_id().alias("position")).write.parquet(listed)
    records = spark.read.parquet(listed)

    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "position")
    firsts = records.groupBy("address").agg(F.min(place).alias("first"))
    firsts = firsts.select("address", F.col("first.id").alias("first_id"), F.col("first.position").alias("first_position"))
    typed = records.join(firsts, "address").withColumns({
        "type": F.when(F.col("position") == F.col("first_position"), "response").otherwise("revisit"),
        "record_id": _record_id(F.col("position"), F.col("address")),
        "first_record_id": _record_id(F.col("first_position"), F.col("address")),
    })
    typed.select("id", "address", "bytes", "record_id", "first_id", _header(date).alias("header")).write.parquet(f"{path}/headers")

    # Any payload of an address will do. Copies go map-side, so each payload moves once for each task that holds it.
    pages.select("address", "payload").dropDuplicates(["address"]).write.parquet(f"{path}/payloads")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record again: its header, whole payload, and the fields parsed from the header."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    text = F.col("header").cast("string")
    field = lambda name: F.regexp_extract(text, f"\r\n{name}: ([^\r]*)\r\n", 1)
    sound = F.col("payload").isNotNull() & (F.sha2("payload", 256) == F.col("address")) & (F.octet_length("payload") == F.col("bytes"))
    sound = sound & (F.concat(F.lit("sha1:"), base32(F.sha1("payload"))) == field("WARC-Payload-Digest"))
    damaged = F.raise_error(F.concat(F.lit("archive: no sound payload for address "), F.col("address"))).cast("binary")
    joined = headers.join(payloads, "address", "left").withColumn("payload", F.when(sound, F.col("payload")).otherwise(damaged))
    return joined.select(
        "id", "header", "payload", "bytes", "record_id",
        field("WARC-Type").alias("type"),
        F.substring(field("WARC-Payload-Digest"), 6, 32).alias("digest"),
        F.when(field("WARC-Type") == "revisit", F.col("first_id")).alias("refers_to"),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """The records as they stand in a WARC file: a revisit's block is empty."""
    block = F.when(F.col("type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return records.select("id", F.concat("header", block, F.lit(END + END).cast("binary")).alias("record"))
