"""The flights table, derived from the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime.functions.values import iso_date
from ontime.schema import RAW, RAW_NAMES
from ontime.session import fresh_dir
from ontime.sources.parquet import read_years, write_years

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# The key alone repeats once in the smallest tables; with the date every flight has its own.
EVENT_KEY = [*KEY, "FL_DATE"]
KEY_AND_RAW = T.StructType(
    [T.StructField(k, T.IntegerType() if k == "l_linenumber" else T.LongType()) for k in KEY] + RAW.fields
)

# Helper columns over one line item, then the raw record. Plain SQL that reads the same everywhere.
HELPERS = {
    "h": "(l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 1000",
    "dist": "CAST(100 + l_partkey % 2500 AS DOUBLE)",
    "dep": "l_quantity - 20",
}
HELPERS_2 = {
    "cx": "CASE WHEN h < 16 THEN 1 ELSE 0 END",
    "dv": "CASE WHEN h BETWEEN 16 AND 19 THEN 1 ELSE 0 END",
    "arr": "dep + CAST(h % 21 - 10 AS DOUBLE)",
}


def _flown(expression: str) -> str:
    return f"CASE WHEN cx = 1 THEN NULL ELSE {expression} END"


def _landed(expression: str) -> str:
    return f"CASE WHEN cx + dv > 0 THEN NULL ELSE {expression} END"


def _cause(turn: int) -> str:
    return (
        f"CASE WHEN cx + dv = 0 AND arr >= 15 THEN CASE WHEN h % 5 = {turn} THEN arr ELSE CAST(0 AS DOUBLE) END END"
    )


RECORD = {
    "FL_DATE": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "OP_CARRIER": "'C' || CAST(l_suppkey % 9 AS STRING)",
    "OP_CARRIER_FL_NUM": "CAST(l_partkey AS DOUBLE)",
    "ORIGIN": "origin_n",
    "DEST": "dest_n",
    "CRS_DEP_TIME": "CASE WHEN h = 999 THEN NULL ELSE CAST((l_orderkey % 24) * 100 + l_partkey % 60 AS DOUBLE) END",
    "DEP_TIME": _flown("CAST(h * 2 AS DOUBLE)"),
    "DEP_DELAY": _flown("dep"),
    "TAXI_OUT": _flown("CAST(5 + h % 30 AS DOUBLE)"),
    "WHEELS_OFF": _flown("CAST(h * 2 + 15 AS DOUBLE)"),
    "WHEELS_ON": _flown("CAST(h * 2 + 200 AS DOUBLE)"),
    "TAXI_IN": _flown("CAST(3 + h % 15 AS DOUBLE)"),
    "CRS_ARR_TIME": "CAST(h * 2 + 210 AS DOUBLE)",
    "ARR_TIME": _flown("CAST(h * 2 + 205 AS DOUBLE)"),
    "ARR_DELAY": _landed("arr"),
    "CANCELLED": "CAST(cx AS DOUBLE)",
    "CANCELLATION_CODE": "CASE WHEN cx = 1 THEN substr('ABCD', CAST(h % 4 + 1 AS INT), 1) END",
    "DIVERTED": "CAST(dv AS DOUBLE)",
    "CRS_ELAPSED_TIME": "CAST(floor(dist / 8) + 30 AS DOUBLE)",
    "ACTUAL_ELAPSED_TIME": _landed("CAST(floor(dist / 8) + 20 + h % 20 AS DOUBLE)"),
    "AIR_TIME": _landed("CAST(floor(dist / 8) + h % 20 AS DOUBLE)"),
    "DISTANCE": "dist",
    "CARRIER_DELAY": _cause(0),
    "WEATHER_DELAY": _cause(1),
    "NAS_DELAY": _cause(2),
    "SECURITY_DELAY": _cause(3),
    "LATE_AIRCRAFT_DELAY": _cause(4),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_year(lines: DataFrame) -> DataFrame:
    """The few columns that a record is made of, gathered by year, so that no whole record is shuffled."""
    lines = lines.select(*KEY, "l_quantity", "l_shipdate", "s_nationkey", "c_nationkey")
    return lines.withColumn("year", F.year(iso_date(F.expr(RECORD["FL_DATE"])))).hint("rebalance", "year")


def derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per line item: its key, the raw record and the year by which they are gathered.

    The small sides are joined to each other first, so the line items are shuffled twice at most (by
    order, by supplier) and not once per table. Broadcasts are left to Spark, which checks sizes;
    skewed keys are split by adaptive execution.
    """
    nation = table(spark, sf_dir, "nation")
    origins = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin_n"))
    homes = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dest_n"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    trips = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    trips = trips.select("o_orderkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(trips, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    # Names come last: until then a nation is one number.
    named = _by_year(lines).join(origins, "s_nationkey").join(homes, "c_nationkey")
    helped = named.withColumns({k: F.expr(v) for k, v in HELPERS.items()})
    helped = helped.withColumns({k: F.expr(v) for k, v in HELPERS_2.items()})
    return helped.select(*KEY, "year", *[F.expr(RECORD[c]).alias(c) for c in RAW_NAMES])


_stored: dict[tuple[str, str, str], str] = {}


def _stored_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    """The folder of a year-partitioned Parquet table that is written on first use.

    It lies in the shared work folder and is written again for each application, so it matches the
    source tables; an incomplete write leaves no entry here.
    """
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place in _stored:
        try:
            spark.read.schema("year int").parquet(_stored[place])
        except AnalysisException:  # the folder was cleared meanwhile
            del _stored[place]
    if place not in _stored:
        path = fresh_dir(spark, name)
        # The rows come gathered by year, so each task writes what it has.
        write_years(build(), path, gather=False)
        _stored[place] = path
    return _stored[place]


def stored_path(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the flights table: ingested once, as any warehouse would, and read by every query."""
    return _stored_once(spark, sf_dir, "flights", lambda: derive(spark, sf_dir))


def flights(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """The flights in the raw layout, with ``keep`` (out of ``KEY`` and ``year``) in front."""
    return read_years(spark, stored_path(spark, sf_dir), KEY_AND_RAW).select(*(keep or []), *RAW_NAMES)


def flights_sql(keep: list[str] | None = None) -> str:
    """The same table as SQL: the body of a common table expression."""
    first = ", ".join(f"{v} AS {k}" for k, v in HELPERS.items())
    second = ", ".join(f"{v} AS {k}" for k, v in HELPERS_2.items())
    record = ", ".join((keep or []) + [f"{RECORD[c]} AS {c}" for c in RAW_NAMES])
    return f"""
      SELECT {record} FROM (
        SELECT *, {second} FROM (
          SELECT l.*, ns.n_name AS origin_n, nc.n_name AS dest_n, {first}
          FROM lineitem l
          JOIN orders o ON o.o_orderkey = l.l_orderkey
          JOIN supplier s ON s.s_suppkey = l.l_suppkey
          JOIN nation ns ON ns.n_nationkey = s.s_nationkey
          JOIN customer c ON c.c_custkey = o.o_custkey
          JOIN nation nc ON nc.n_nationkey = c.c_nationkey
        ) base
      ) f"""


# Untidy text in place of some numbers, by line: three tokens for "no value" and one bad number.
UNTIDY = {
    "DEP_DELAY": {1: "NA", 2: "null", 3: "", 4: "x"},
    "TAXI_OUT": {5: "n/a", 6: "--"},
    "DISTANCE": {7: "far"},
}
MOD = "(l_orderkey + l_linenumber + l_partkey) % 50"


def untidy(column: str) -> str:
    """The column as text, with the untidy values written in."""
    plain = f"CAST({column} AS STRING)"
    if column not in UNTIDY:
        return plain
    cases = " ".join(f"WHEN {MOD} = {at} THEN '{text}'" for at, text in UNTIDY[column].items())
    return f"CASE {cases} ELSE {plain} END"


def flights_text(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Flights with every column as text, as a CSV file would hold them, some of it untidy."""

    df = flights(spark, sf_dir, [*KEY, "year"])
    return df.select(*(keep or []), *[F.expr(untidy(c)).alias(c) for c in RAW_NAMES])


def flights_text_sql(keep: list[str] | None = None) -> str:
    columns = ", ".join((keep or []) + [f"{untidy(c)} AS {c}" for c in RAW_NAMES])
    return f"SELECT {columns} FROM flights"
