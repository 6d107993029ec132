"""Every operator as a named query over the test tables, each with its SQL equivalent where there is one."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from ontime.functions.stats import rounded
from ontime.functions.values import known_text
from ontime.operators import clean as C, evaluate as E, features as V, messages as M, models as L, profile as P
from ontime.operators import relate as R, sample as S
from ontime.plans import oracle as O
from ontime.plans.flights import EVENT_KEY, KEY, KEY_AND_RAW, MOD, UNTIDY, flights, flights_text, stored_path
from ontime.schema import (
    CANCEL_REASONS, CAUSES, CLEAN_NAMES, CORRELATED, MESSAGE, NA_TOKENS, RAW, RAW_NAMES, RAW_NUMERIC, RAW_TEXT,
    REPORT_CATEGORIES, REPORT_FLAGS, REPORT_MEASURES, prediction_layout,
)
from ontime.session import fresh_dir
from ontime.sources import csv, parquet
from ontime.streaming import pipeline as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(flights(spark, sf, KEY), keep=KEY)


def round_all(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


def names(columns: list[str]) -> str:
    return ", ".join(columns)


# ---- sources and sinks -------------------------------------------------------------------------


def _typed_sql(c: str) -> str:
    return f"CASE WHEN {MOD} IN ({names([str(k) for k in UNTIDY[c]])}) THEN NULL ELSE {c} END AS {c}" if c in UNTIDY else c


def write_yearly_csv(spark: SparkSession, sf: str, path: str, years: list[int] | None = None) -> None:
    """Untidy flights as one CSV folder per year. Even years have a junk last column, odd ones their columns in another order."""
    text = flights_text(spark, sf, ["year"])
    text = text if years is None else text.where(F.col("year").isin(years))
    csv.write(text.filter("year % 2 = 0").withColumn("Unnamed: 27", F.lit(None).cast("string")), path, ["year"], mode="append")
    odd = text.filter("year % 2 <> 0")
    csv.write(odd.select(*reversed(odd.columns)), path, ["year"], mode="append")


_yearly: dict[tuple[str, str], str] = {}


def _yearly_csv(spark: SparkSession, sf: str) -> str:
    """All years, written once for each application and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _yearly:
        path = fresh_dir(spark, "csv")
        write_yearly_csv(spark, sf, path)
        _yearly[key] = path
    return _yearly[key]


@query(O.on_flights(f"SELECT {names([_typed_sql(c) for c in RAW_NAMES])} FROM flights"))
def csv_ingest(spark, sf):
    return csv.ingest(spark, [_yearly_csv(spark, sf)])


@query(O.on_flights(f"SELECT year, {names([_typed_sql(c) for c in RAW_NAMES])} FROM flights"))
def csv_to_parquet(spark, sf):
    out = fresh_dir(spark, "parquet")
    parquet.csv_to_years(spark, [_yearly_csv(spark, sf)], out)
    return parquet.read_years(spark, out, RAW)


@query(O.on_flights("SELECT 'year=' || year AS dataset, count(*) AS n FROM flights GROUP BY year"))
def rows_per_file(spark, sf):
    path = _yearly_csv(spark, sf)
    counts = csv.file_report(spark, path)
    return counts.groupBy(csv.dataset_of("path").alias("dataset")).agg(F.sum("n").alias("n"))


@query(
    O.on_flights(
        f"SELECT 'year=' || year AS dataset, count(*) AS n, count(CASE WHEN {MOD} IN (10, 11) THEN 1 END) AS n_malformed, "
        "count(CASE WHEN FL_DATE IS NULL THEN 1 END) AS n_no_first_cell "
        "FROM flights GROUP BY year"
    )
)
def bad_rows_by_file(spark, sf):
    cells = flights_text(spark, sf, ["year", *KEY])
    whole = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_NAMES])
    short = F.concat_ws(",", *RAW_NAMES[:5])
    at = F.expr(MOD)
    line = F.when(at == 10, short).when(at == 11, F.concat(whole, F.lit(",more"))).otherwise(whole)
    path = fresh_dir(spark, "lines")
    cells.select("year", line.alias("line")).write.partitionBy("year").text(path)
    return csv.row_report(csv.read_text(spark, path, RAW_NAMES, "*.txt"))


@query(
    O.on_text(
        "SELECT "
        + names(KEY)
        + "".join(
            f", CASE WHEN trim({c}) IN ({names([repr(t) for t in NA_TOKENS])}) THEN NULL ELSE {c} END AS {c}"
            for c in ["DEP_DELAY", "TAXI_OUT", "DISTANCE", "CANCELLATION_CODE"]
        )
        + " FROM text"
    )
)
def na_tokens(spark, sf):
    text = flights_text(spark, sf, KEY)
    return text.select(*KEY, *[known_text(c).alias(c) for c in ["DEP_DELAY", "TAXI_OUT", "DISTANCE", "CANCELLATION_CODE"]])


def _state_sql(by: str) -> str:
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    known = f"CASE WHEN trim({{c}}) IN ({names([repr(t) for t in NA_TOKENS])}) THEN NULL ELSE {{c}} END"

    def part(c: str) -> str:
        k = known.replace("{c}", c)
        bad = f"TRY_CAST({k} AS DOUBLE) IS NULL" if c in RAW_NUMERIC else "FALSE"
        return (
            f"SELECT {group}'{c}' AS \"column\", count({k}) AS n_present, "
            f"count(CASE WHEN ({k}) IS NULL THEN 1 END) AS n_missing, "
            f"count(CASE WHEN ({k}) IS NOT NULL AND {bad} THEN 1 END) AS n_rejected FROM text{tail}"
        )

    return " UNION ALL ".join(part(c) for c in RAW_NAMES)


@query(O.on_text(_state_sql("")))
def coercion_report(spark, sf):
    return P.coercion_report(flights_text(spark, sf), RAW)


@query(O.on_text(_state_sql("year")))
def schema_drift(spark, sf):
    return P.schema_drift(flights_text(spark, sf, ["year"]), ["year"], RAW)


@query(O.on_flights(f"SELECT year, {names(RAW_NAMES)} FROM flights"))
def union_years(spark, sf):
    df = flights(spark, sf, ["year"])
    years = [r.year for r in df.select("year").distinct().orderBy("year").collect()]
    parts = [df.filter(F.col("year") == y) for y in years]
    # Every other year has its columns in another order.
    return C.union_by_name([p.select(*reversed(p.columns)) if i % 2 else p for i, p in enumerate(parts)])


@query(O.on_flights(f"SELECT year, {names(RAW_NAMES)} FROM flights"))
def parquet_roundtrip(spark, sf):
    path = fresh_dir(spark, "parquet")
    # The stored table is in years already.
    parquet.write_years(flights(spark, sf), path, gather=False)
    return parquet.read_years(spark, path, RAW)


@query(O.on_flights(f"SELECT {names(RAW_NAMES)} FROM flights"))
def csv_roundtrip(spark, sf):
    path = fresh_dir(spark, "csv")
    csv.write(flights(spark, sf), path)
    return csv.ingest(spark, [path])


# Commas, quotes and both inside a cell, which writers put in quotes and double.
_QUOTED = "OP_CARRIER || ', \"' || DEST || '\" ' || coalesce(CANCELLATION_CODE, '\\')"


@query(O.on_flights(f"SELECT {names(KEY)}, {_QUOTED} AS cell, DISTANCE FROM flights"))
def csv_quoting(spark, sf):
    path = fresh_dir(spark, "csv")
    # The lines are put together by hand, so that the reader is not only held against this library's own writer.
    cell = F.concat(F.lit('"'), F.replace(F.col("cell"), F.lit('"'), F.lit('""')), F.lit('"'))
    rows = flights(spark, sf, KEY).select(*KEY, F.expr(_QUOTED.replace("'\\'", "'\\\\'")).alias("cell"), "DISTANCE")
    line = F.concat_ws(",", *KEY, cell, F.coalesce(F.col("DISTANCE").cast("string"), F.lit(""))).alias("value")
    rows.select(line).write.text(path)
    layout = T.StructType([T.StructField(k, T.LongType()) for k in KEY] + [T.StructField("cell", T.StringType()), T.StructField("DISTANCE", T.DoubleType())])
    return csv.typed(csv.read_text(spark, path, layout.names, "*.txt"), layout)


@query(O.on_flights("SELECT FL_DATE, OP_CARRIER, DEP_DELAY, DISTANCE, CANCELLATION_CODE FROM flights"))
def csv_infer(spark, sf):
    path = fresh_dir(spark, "csv")
    csv.write(flights(spark, sf).select("FL_DATE", "OP_CARRIER", "DEP_DELAY", "DISTANCE", "CANCELLATION_CODE"), path)
    return csv.infer(spark, path).withColumn("FL_DATE", F.col("FL_DATE").cast("string"))


@query(O.on_flights(f"SELECT {names(RAW_NAMES)} FROM flights"))
def conform_schema(spark, sf):
    df = flights(spark, sf, ["year"])
    whole = ["OP_CARRIER_FL_NUM", "CRS_DEP_TIME", "CRS_ARR_TIME"]
    even, odd = fresh_dir(spark, "even"), fresh_dir(spark, "odd")
    df.filter("year % 2 = 0").drop("year").withColumns({c: F.col(c).cast("bigint") for c in whole}).write.parquet(even)
    df.filter("year % 2 <> 0").drop("year").write.parquet(odd)
    return parquet.read_conformed(spark, [even, odd], RAW)


@query(O.on_flights("SELECT OP_CARRIER, ORIGIN, DEST, DISTANCE FROM flights WHERE year = 1997"))
def scan_projection(spark, sf):
    df = parquet.read_years(spark, stored_path(spark, sf), KEY_AND_RAW, [1997])
    return df.select("OP_CARRIER", "ORIGIN", "DEST", "DISTANCE")


# ---- cleaning ----------------------------------------------------------------------------------


@query(O.on_clean(f"SELECT {names(CLEAN_NAMES)} FROM clean"))
def clean_v3(spark, sf):
    return C.clean(flights(spark, sf))


@query(O.on_flights(f"SELECT {names(CLEAN_NAMES)} FROM clean", clean=O.clean_sql("v1")))
def clean_v1(spark, sf):
    return C.clean(flights(spark, sf), "v1")


@query(O.on_flights(f"SELECT {names(KEY)}, {names([f'coalesce({c}, 0) AS {c}' for c in CAUSES])} FROM flights"))
def fill_nulls(spark, sf):
    return C.fill_nulls(flights(spark, sf, KEY).select(*KEY, *CAUSES), 0.0, CAUSES)


@query(O.on_flights(f"SELECT {names(KEY)}, ARR_DELAY FROM flights WHERE ARR_DELAY IS NOT NULL"))
def filter_not_null(spark, sf):
    return C.filter_known(flights(spark, sf, KEY).select(*KEY, "ARR_DELAY"), "ARR_DELAY")


@query(
    O.on_flights(
        f"SELECT {names(KEY)}, year, CAST(month({O.DATE}) AS INTEGER) AS month, CAST(day({O.DATE}) AS INTEGER) AS day, "
        f"dayname({O.DATE}) AS day_of_week FROM flights"
    )
)
def date_parts(spark, sf):
    return C.date_parts(flights(spark, sf, KEY).select(*KEY, "FL_DATE")).drop("FL_DATE")


@query(
    O.on_flights(
        f"SELECT {names(KEY)}, CANCELLATION_CODE, CASE CANCELLATION_CODE "
        + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CANCEL_REASONS)
        + " END AS reason FROM flights WHERE CANCELLATION_CODE IS NOT NULL"
    )
)
def code_labels(spark, sf):
    lookup = C.constant_table(spark, CANCEL_REASONS, ["code", "reason"])
    cancelled = C.filter_known(flights(spark, sf, KEY).select(*KEY, "CANCELLATION_CODE"), "CANCELLATION_CODE")
    return C.lookup_codes(cancelled, "CANCELLATION_CODE", lookup, "code")


ROUTE = ["FL_DATE", "OP_CARRIER", "ORIGIN", "DEST"]


@query(O.on_flights(f"SELECT DISTINCT {names(ROUTE)} FROM flights"))
def dedup(spark, sf):
    return C.drop_duplicates(flights(spark, sf), ROUTE)


@query(
    O.on_flights(
        f"SELECT {names(ROUTE)}, {names(KEY)} FROM (SELECT *, row_number() OVER (PARTITION BY {names(ROUTE)} ORDER BY {names(KEY)}) AS r FROM flights) WHERE r = 1"
    )
)
def dedup_rows(spark, sf):
    return C.first_per_key(flights(spark, sf, KEY).select(*ROUTE, *KEY), ROUTE)


# ---- samples -----------------------------------------------------------------------------------

_HASH = "CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def _md5_sql(seed: int, columns: list[str]) -> str:
    key = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in columns)
    return _HASH.replace("{text}", f"'{seed}:' || {key}")


def _below(fraction: float) -> str:
    return f"< CAST({fraction * S.BUCKETS!r} AS DOUBLE)"


WEIGHTS = {"l_orderkey": 7, "l_linenumber": 13, "l_partkey": 31, "l_suppkey": 101}
WEIGHTED = " + ".join(f"{c} * {w}" for c, w in WEIGHTS.items())


# One column of this key is null for most flights.
_NULLABLE = [*KEY, "CANCELLATION_CODE"]


@query(O.on_flights(f"SELECT {names(_NULLABLE)}, DEP_DELAY FROM flights WHERE {_md5_sql(42, _NULLABLE)} {_below(0.08)}"))
def hash_sample(spark, sf):
    return S.sample(flights(spark, sf, KEY).select(*_NULLABLE, "DEP_DELAY"), 0.08, S.bucket_of(_NULLABLE, 42))


@query(O.on_flights("SELECT count(*) AS n, count(*) AS n_both_sides, TRUE AS near_share FROM flights"))
def fast_hash_sample(spark, sf):
    """Only Spark can reproduce this hash, so what is shown is that the sample and the rest are whole and of the right size."""
    part, rest = S.split(flights(spark, sf, KEY).select(*KEY), 0.08, S.fast_bucket_of(KEY, 42))
    sides = part.select(F.lit(1).alias("picked")).union(rest.select(F.lit(0).alias("picked")))
    total = flights(spark, sf).agg(F.count("*")).scalar()
    # Five deviations of the share that a fair draw gives.
    near = F.abs(F.avg("picked") - 0.08) < 5 * F.sqrt(F.lit(0.08 * 0.92) / F.count("*"))
    return sides.agg(F.count("*").alias("n_both_sides"), near.alias("near_share")).select(total.alias("n"), "n_both_sides", "near_share")


@query(O.on_flights(f"SELECT {names(KEY)}, DEP_DELAY FROM flights WHERE {_HASH.replace('{text}', f'CAST({WEIGHTED} AS VARCHAR)')} {_below(0.08)}"))
def modulo_sample(spark, sf):
    return S.sample(flights(spark, sf, KEY).select(*KEY, "DEP_DELAY"), 0.08, S.integer_bucket_of(WEIGHTS))


@query(
    O.on_clean(
        f"SELECT CASE WHEN {_md5_sql(42, KEY)} {_below(0.8)} THEN 'train' ELSE 'test' END AS part, count(*) AS n, "
        "CAST(sum(cancelled) AS BIGINT) AS n_positive FROM clean GROUP BY 1"
    )
)
def split_counts(spark, sf):
    return S.split_counts(cleaned(spark, sf), 0.8, S.bucket_of(KEY, 42), "cancelled")


# ---- profiles ----------------------------------------------------------------------------------


@query(O.on_flights(f"SELECT year, count(*) AS n, CAST({len(RAW_NAMES)} AS BIGINT) AS n_columns FROM flights GROUP BY year"))
def row_counts_by_year(spark, sf):
    return P.row_counts(flights(spark, sf, ["year"]), ["year"])


def _null_sql(columns: list[str], view: str) -> str:
    parts = O.per_column(columns, f"SELECT '{{c}}' AS \"column\", count(*) - count({{c}}) AS n_missing FROM {view}")
    return f"SELECT * FROM ({parts}) WHERE n_missing > 0"


@query(O.on_flights(_null_sql(RAW_NAMES, "flights")))
def null_profile(spark, sf):
    return P.null_profile(flights(spark, sf))


@query(O.on_flights(O.per_column(CLEAN_NAMES, "SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM clean"), clean=O.clean_sql()))
def null_profile_clean(spark, sf):
    return P.null_profile(C.clean(flights(spark, sf)), keep_zero=True)


@query(
    O.on_flights(
        O.per_column(REPORT_FLAGS, "SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM flights GROUP BY {c}")
    )
)
def flag_frequency(spark, sf):
    return P.frequencies(flights(spark, sf), REPORT_FLAGS)


_TOP = [c for c in RAW_TEXT if c != "FL_DATE"]


@query(
    O.on_flights(
        'SELECT "column", value, n, rank, round(sum(n) OVER (PARTITION BY "column") * 100.0 / (SELECT count(*) FROM flights), 6) '
        'AS covered_pct FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS FIRST) AS INTEGER) AS rank '
        "FROM (" + O.per_column(_TOP, "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM flights GROUP BY {c}") + ")) WHERE rank <= 15"
    )
)
def topn_share(spark, sf):
    return round_all(P.top_values(flights(spark, sf), _TOP, 15), ["covered_pct"])


def _share_sql(flag: str) -> str:
    return O.on_flights(
        f"SELECT year, {flag}, n, round(n / sum(n) OVER (PARTITION BY year), 6) AS share "
        f"FROM (SELECT year, {flag}, count(*) AS n FROM flights GROUP BY ALL)"
    )


@query(_share_sql("CANCELLED"))
def cancelled_share_by_year(spark, sf):
    return round_all(P.share(flights(spark, sf, ["year"]), "year", "CANCELLED"), ["share"])


@query(_share_sql("DIVERTED"))
def diverted_share_by_year(spark, sf):
    return round_all(P.share(flights(spark, sf, ["year"]), "year", "DIVERTED"), ["share"])


@query(
    O.on_flights(
        "SELECT year, CANCELLATION_CODE, count(*) AS n FROM flights WHERE CANCELLATION_CODE IS NOT NULL GROUP BY year, CANCELLATION_CODE"
    )
)
def cancel_reason_by_year(spark, sf):
    return P.known_counts(flights(spark, sf, ["year"]), "year", "CANCELLATION_CODE")


_DISTINCT_SQL = "SELECT year, '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM flights GROUP BY year"


@query(O.on_flights(O.per_column(REPORT_CATEGORIES, _DISTINCT_SQL)))
def distinct_counts(spark, sf):
    return P.distinct_counts(flights(spark, sf, ["year"]), ["year"], REPORT_CATEGORIES)


_STATS_SQL = (
    "SELECT year, '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
    "round(stddev_samp({c}), 6) AS stddev FROM flights GROUP BY year"
)


@query(O.on_flights(O.per_column(REPORT_MEASURES, _STATS_SQL)))
def numeric_stats(spark, sf):
    return round_all(P.numeric_stats(flights(spark, sf, ["year"]), ["year"], REPORT_MEASURES), ["mean", "min", "max", "stddev"])


def _report_sql() -> str:
    parts = ["SELECT year, 'rows' AS section, '*' AS \"column\", 'count' AS item, CAST(count(*) AS DOUBLE) AS value FROM flights GROUP BY year"]
    for item, call in (("mean", "avg"), ("min", "min"), ("max", "max"), ("stddev", "stddev_samp")):
        template = f"SELECT year, 'statistic', '{{c}}', '{item}', round({call}({{c}}), 6) FROM flights GROUP BY year"
        parts.append(O.per_column(REPORT_MEASURES, template))
    parts.append(O.per_column(REPORT_CATEGORIES, "SELECT year, 'distinct', '{c}', 'count', CAST(count(DISTINCT {c}) AS DOUBLE) FROM flights GROUP BY year"))
    parts.append(O.per_column(REPORT_FLAGS, "SELECT year, 'flag', '{c}', CAST({c} AS VARCHAR), CAST(count(*) AS DOUBLE) FROM flights GROUP BY year, {c}"))
    return " UNION ALL ".join(parts)


@query(O.on_flights(_report_sql()))
def year_report(spark, sf):
    return round_all(P.year_report(flights(spark, sf, ["year"])), ["value"])


_NUMBER_SQL = (
    "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    "round(min({c}), 6) AS min, round(max({c}), 6) AS max, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM flights"
)
_TEXT_SQL = "SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, min({c}), max({c}) FROM flights"


# Whole numbers and decimals beside the doubles; the last are beyond what a double holds exactly.
_EXACT = {
    "a_short": "CAST(l_linenumber AS SMALLINT)",
    "a_decimal": "CAST(DISTANCE AS DECIMAL(12,2))",
    "a_bigint": "CASE WHEN l_orderkey <= 2 AND l_linenumber = 1 THEN 9007199254740992 + l_orderkey END",
}
_EXACT_SQL = (
    "SELECT '{c}', count({c}), round(avg(CAST({c} AS DOUBLE)), 6), round(stddev_samp(CAST({c} AS DOUBLE)), 6), round(CAST(min({c}) AS DOUBLE), 6), "
    "round(CAST(max({c}) AS DOUBLE), 6), CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR) FROM exact"
)


@query(
    O.on_flights(
        " UNION ALL ".join([O.per_column(RAW_NUMERIC, _NUMBER_SQL), O.per_column(RAW_TEXT, _TEXT_SQL), O.per_column(list(_EXACT), _EXACT_SQL)]),
        exact=f"SELECT {names([f'{v} AS {k}' for k, v in _EXACT.items()])} FROM flights",
    )
)
def describe_table(spark, sf):
    table = flights(spark, sf, KEY).withColumns({k: F.expr(v) for k, v in _EXACT.items()}).drop(*KEY)
    return round_all(P.describe_table(table), ["mean", "stddev", "min", "max"])


@query(
    O.on_flights(
        "SELECT OP_CARRIER, round(avg(DEP_DELAY), 6) AS avg_delay, round(quantile_cont(DEP_DELAY, 0.5), 6) AS median_delay, "
        "count(*) AS flight_count FROM flights GROUP BY OP_CARRIER"
    )
)
def carrier_delay(spark, sf):
    return round_all(P.delay_by(flights(spark, sf), "OP_CARRIER", "DEP_DELAY", exact=True), ["avg_delay", "median_delay"])


# With this few distinct delays the sketch has no room to be off by a value.
@query(
    O.on_flights(
        "SELECT OP_CARRIER, round(avg(DEP_DELAY), 6) AS avg_delay, quantile_disc(DEP_DELAY, 0.5) AS median_delay, "
        "count(*) AS flight_count FROM flights GROUP BY OP_CARRIER"
    )
)
def carrier_delay_approx(spark, sf):
    return round_all(P.delay_by(flights(spark, sf), "OP_CARRIER", "DEP_DELAY"), ["avg_delay"])


@query(
    O.on_flights(
        f"SELECT CAST(month({O.DATE}) AS INTEGER) AS month, round(avg(ARR_DELAY), 6) AS avg_delay FROM flights GROUP BY 1"
    )
)
def monthly_delay(spark, sf):
    return round_all(P.mean_by(C.date_parts(flights(spark, sf)), "month", "ARR_DELAY"), ["avg_delay"])


_BINS_SQL = (
    "SELECT '{c}' AS \"column\", CAST(least(floor(({c} - lo) * 30 / (hi - lo)), 29) AS BIGINT) AS bin, "
    "round(lo + CAST(least(floor(({c} - lo) * 30 / (hi - lo)), 29) AS BIGINT) * ((hi - lo) / 30), 6) AS bin_start, count(*) AS n "
    "FROM flights, (SELECT min({c}) AS lo, max({c}) AS hi FROM flights) WHERE {c} IS NOT NULL GROUP BY lo, hi, 2, 3"
)


@query(O.on_flights(O.per_column(RAW_NUMERIC, _BINS_SQL)))
def histogram(spark, sf):
    return round_all(P.histograms(flights(spark, sf), RAW_NUMERIC, 30), ["bin_start"])


@query(
    O.on_flights(
        "SELECT f.OP_CARRIER, q1, median, q3, n_known, "
        "min(CASE WHEN DEP_DELAY BETWEEN lo AND hi THEN DEP_DELAY END) AS whisker_low, "
        "max(CASE WHEN DEP_DELAY BETWEEN lo AND hi THEN DEP_DELAY END) AS whisker_high, "
        "count(CASE WHEN DEP_DELAY NOT BETWEEN lo AND hi THEN 1 END) AS n_outliers "
        "FROM flights f JOIN fences q ON f.OP_CARRIER = q.OP_CARRIER GROUP BY f.OP_CARRIER, q1, median, q3, n_known",
        quartiles="SELECT OP_CARRIER, quantile_cont(DEP_DELAY, 0.25) AS q1, quantile_cont(DEP_DELAY, 0.5) AS median, "
        "quantile_cont(DEP_DELAY, 0.75) AS q3, count(DEP_DELAY) AS n_known FROM flights GROUP BY OP_CARRIER",
        fences="SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM quartiles",
    )
)
def box_stats(spark, sf):
    return P.box_stats(flights(spark, sf), "OP_CARRIER", "DEP_DELAY")


@query(
    O.on_flights(
        "SELECT CAST(least(floor((DISTANCE - xlo) * 30 / (xhi - xlo)), 29) AS BIGINT) AS x_bin, "
        "CAST(least(floor((AIR_TIME - ylo) * 30 / (yhi - ylo)), 29) AS BIGINT) AS y_bin, count(*) AS n FROM pairs, "
        "(SELECT min(DISTANCE) AS xlo, max(DISTANCE) AS xhi, min(AIR_TIME) AS ylo, max(AIR_TIME) AS yhi FROM pairs) GROUP BY 1, 2",
        pairs="SELECT DISTANCE, AIR_TIME FROM flights WHERE DISTANCE IS NOT NULL AND AIR_TIME IS NOT NULL",
    )
)
def pair_density(spark, sf):
    return R.pair_density(flights(spark, sf), "DISTANCE", "AIR_TIME", 30)


_PAIRS = [("DISTANCE", "AIR_TIME"), ("LATE_AIRCRAFT_DELAY", "ARR_DELAY")]


@query(
    O.on_flights(
        " UNION ALL ".join(
            f"SELECT '{x}' AS x, '{y}' AS y, count(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN 1 END) AS n, "
            f"round(regr_slope({y}, {x}), 6) AS slope, round(regr_intercept({y}, {x}), 6) AS intercept, "
            f"round(corr({x}, {y}), 6) AS corr FROM flights"
            for x, y in _PAIRS
        )
    )
)
def pair_fit(spark, sf):
    return round_all(R.pair_fits(flights(spark, sf), _PAIRS), ["slope", "intercept", "corr"])


def _matrix_sql(columns: list[str], value: str) -> str:
    """All pairs in one row, then one row per pair."""
    cells = names([
        f"corr({value.replace('{c}', x)}, {value.replace('{c}', y)}) AS \"{x}|{y}\"" for x in columns for y in columns
    ])
    return (
        "SELECT split_part(pair, '|', 1) AS col_x, split_part(pair, '|', 2) AS col_y, round(corr, 6) AS corr FROM "
        f"(UNPIVOT (SELECT {cells} FROM flights) ON COLUMNS(*) INTO NAME pair VALUE corr)"
    )


@query(O.on_flights(_matrix_sql(RAW_NUMERIC, "coalesce({c}, 0)")))
def corr_matrix(spark, sf):
    return round_all(R.correlations(flights(spark, sf), RAW_NUMERIC, "zero"), ["corr"])


@query(O.on_flights(_matrix_sql(CORRELATED, "{c}")))
def corr_matrix_pairwise(spark, sf):
    return round_all(R.correlations(flights(spark, sf), CORRELATED, "pairwise"), ["corr"])


@query(
    O.on_flights(
        "SELECT col_x, col_y, abs(corr) AS abs_corr FROM (" + _matrix_sql(RAW_NUMERIC, "coalesce({c}, 0)").replace("round(corr, 6)", "round(corr, 9)")
        + ") WHERE col_x < col_y ORDER BY 3 DESC, 1, 2 LIMIT 10"
    ).replace("abs(corr) AS abs_corr", "round(abs(corr), 6) AS abs_corr").replace("ORDER BY 3 DESC", "ORDER BY abs(corr) DESC")
)
def top_correlations(spark, sf):
    return round_all(R.strongest(R.correlations(flights(spark, sf), RAW_NUMERIC, "zero"), 10), ["abs_corr"])


# ---- features, models, evaluation --------------------------------------------------------------


@query(
    O.on_clean(
        'SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) - 1 AS "index" FROM ('
        + O.per_column(V.CATEGORIES, "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM clean WHERE {c} IS NOT NULL GROUP BY {c}")
        + ")"
    )
)
def index_mapping(spark, sf):
    return V.index_mapping(cleaned(spark, sf))


@query(
    O.on_clean(
        O.per_column(V.NUMBERS, "SELECT '{c}' AS input, CAST(1 AS BIGINT) AS width")
        + " UNION ALL "
        + O.per_column(V.CATEGORIES, "SELECT '{c}', count(DISTINCT {c}) FROM clean")
    )
)
def feature_width(spark, sf):
    df = cleaned(spark, sf)
    return V.feature_widths(V.fit_features(df).transform(df))


_LATE = "CASE WHEN departure_delay >= 15 THEN 1 ELSE 0 END"


@query(
    O.on_clean(
        "SELECT CAST(sum(actual) AS BIGINT) AS n, round(sum(hits) / sum(actual), 6) AS accuracy, "
        "round(sum(actual * f1) / sum(actual), 6) AS f1, round(sum(actual * p) / sum(actual), 6) AS weighted_precision, "
        "round(sum(actual * r) / sum(actual), 6) AS weighted_recall FROM (SELECT actual, hits, "
        "CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p, CASE WHEN actual = 0 THEN 0 ELSE hits / actual END AS r, "
        "2 * hits / (actual + predicted) AS f1 FROM (SELECT c, count(CASE WHEN delayed = c THEN 1 END) AS actual, "
        "count(CASE WHEN late = c THEN 1 END) AS predicted, count(CASE WHEN delayed = c AND late = c THEN 1 END) AS hits "
        "FROM guesses, (SELECT unnest([0, 1]) AS c) GROUP BY c))",
        guesses=f"SELECT delayed, {_LATE} AS late FROM clean",
    )
)
def classification_report(spark, sf):
    guesses = cleaned(spark, sf).withColumn("late", F.expr(_LATE))
    report = E.classification_report(guesses, "delayed", "late")
    return round_all(report, ["accuracy", "f1", "weighted_precision", "weighted_recall"])


def _auc_sql(label: str, score: str) -> str:
    """Rank-sum form: average rank of the positives."""
    return (
        "SELECT n_positive, n_negative, round((ranks - n_positive * (n_positive + 1) / 2) / (n_positive * n_negative), 6) AS auc "
        "FROM (SELECT count(CASE WHEN y = 1 THEN 1 END) AS n_positive, count(CASE WHEN y = 0 THEN 1 END) AS n_negative, "
        "sum(CASE WHEN y = 1 THEN (first_rank + last_rank) / 2 END) AS ranks FROM (SELECT y, "
        "rank() OVER (ORDER BY s) AS first_rank, rank() OVER (ORDER BY s) + count(*) OVER (PARTITION BY s) - 1 AS last_rank "
        f"FROM (SELECT {label} AS y, {score} AS s FROM clean)))"
    )


@query(O.on_clean(_auc_sql("delayed", "departure_delay")))
def auc_from_scores(spark, sf):
    return round_all(E.auc(cleaned(spark, sf), "delayed", "departure_delay"), ["auc"])


@query(
    O.on_clean(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", auc, round(greatest(auc, 1 - auc), 6) AS separation, "
            f"CASE WHEN greatest(auc, 1 - auc) >= 0.95 THEN 1 ELSE 0 END AS suspicious FROM ({_auc_sql('cancelled', c)})"
            for c in V.NUMBERS
        )
    )
)
def leakage_report(spark, sf):
    return round_all(E.leakage_report(cleaned(spark, sf), "cancelled", V.NUMBERS), ["auc", "separation"])


@query(
    O.on_clean(
        O.per_column(
            L.FOREST_TARGETS,
            "SELECT '{c}' AS target, n, CAST(majority_class AS INTEGER) AS majority_class, round(a, 6) AS accuracy, round(2 * a * a / (1 + a), 6) AS f1, "
            "round(a * a, 6) AS weighted_precision, round(a, 6) AS weighted_recall FROM (SELECT count(*) AS n, "
            "CASE WHEN avg({c}) > 0.5 THEN 1 ELSE 0 END AS majority_class, greatest(avg({c}), 1 - avg({c})) AS a FROM clean)",
        )
    )
)
def majority_baseline(spark, sf):
    baseline = E.majority_baseline(cleaned(spark, sf), L.FOREST_TARGETS)
    return round_all(baseline, ["accuracy", "f1", "weighted_precision", "weighted_recall"])


#: Families that must find the target which the features determine: a cancelled flight has no taxi time.
_LEARNERS, _DETERMINED = ("gbt", "rf"), "cancelled"


def _report(spark, sf, family: str, **options) -> DataFrame:
    """What is certain of any fitted model: rows tested, the floor, and how its metrics must relate; and that trees learn what
    the features determine, which a constant model does not."""
    report = L.train_and_evaluate(cleaned(spark, sf), family, S.bucket_of(KEY, 42), **options)
    shares = ["accuracy", "f1", "weighted_precision", "weighted_recall"]
    within = F.forall(F.array(*shares, F.coalesce("auc", F.lit(0.5))), lambda x: x.between(0, 1))
    learnt = (F.coalesce("auc", F.lit(0.0)) >= 0.99) & (F.col("accuracy") > F.col("majority_accuracy"))
    found = [F.when(F.col("target") == _DETERMINED, learnt).otherwise(True).alias("finds_determined")] if family in _LEARNERS else []
    return report.select(
        "model", "target", "n", F.round("majority_accuracy", 6).alias("majority_accuracy"),
        (F.abs(F.col("accuracy") - F.col("weighted_recall")) < 1e-9).alias("accuracy_is_recall"),
        within.alias("metrics_within_range"), *found,
    )


def _report_oracle(family: str, targets: list[str], skip_unseen: bool = True) -> str:
    """Rows on the test side, less those of a category that training lacks where the model leaves them out."""
    train = f"{_md5_sql(42, KEY)} {_below(0.8)}"
    known = " AND ".join(f"{c} IN (SELECT {c} FROM clean WHERE {train})" for c in V.CATEGORIES) if skip_unseen else "TRUE"
    one = (
        f"SELECT '{family}' AS model, '{{c}}' AS target, count(*) AS n, round(greatest(avg({{c}}), 1 - avg({{c}})), 6) AS majority_accuracy, "
        "TRUE AS accuracy_is_recall, TRUE AS metrics_within_range" + (", TRUE AS finds_determined" if family in _LEARNERS else "") + " FROM tested"
    )
    return O.on_clean(O.per_column(targets, one), tested=f"SELECT * FROM clean WHERE NOT ({train}) AND {known}")


@query(_report_oracle("gbt", L.TARGETS))
def train_gbt(spark, sf):
    return _report(spark, sf, "gbt", settings=L.GBT_SETTINGS)


@query(_report_oracle("logreg", L.TARGETS))
def train_logreg(spark, sf):
    return _report(spark, sf, "logreg")


@query(_report_oracle("mlp", L.TARGETS))
def train_mlp(spark, sf):
    return _report(spark, sf, "mlp")


@query(_report_oracle("rf", L.FOREST_TARGETS, skip_unseen=False))
def train_rf(spark, sf):
    return _report(spark, sf, "rf", targets=L.FOREST_TARGETS, unseen="error", encode_unseen="error")


@query(
    O.on_clean(
        " UNION ALL ".join(f"SELECT '{t}' AS target, count(*) AS n, count(*) AS n_same, TRUE AS varied FROM clean" for t in L.TARGETS)
    )
)
def model_roundtrip(spark, sf):
    df = cleaned(spark, sf)
    model = L.fit(df, "rf")
    path = fresh_dir(spark, "model")
    L.save(model, path)
    # Both models in one pass: the loaded one takes its input from the untouched columns.
    again = {f"{t}_probability": f"{t}_first" for t in L.TARGETS}
    first = L.score(df, model).withColumnsRenamed(again).select(*df.columns, *again.values())
    both = L.score(first, L.load(path))
    same = [
        F.struct(F.lit(t).alias("target"), (F.col(f"{t}_first") == F.col(f"{t}_probability")).alias("same"), F.get(f"{t}_probability", F.lit(1)).alias("p"))
        for t in L.TARGETS
    ]
    # A model that gives every row the same would come back equal whatever was stored.
    varied = (F.min("p") != F.max("p")).alias("varied")
    return both.select(F.inline(F.array(*same))).groupBy("target").agg(F.count("*").alias("n"), F.count_if("same").alias("n_same"), varied)


# ---- messages and streams ----------------------------------------------------------------------


def messages(df: DataFrame) -> DataFrame:
    """Raw flights (with key) as message rows."""
    cleaned = C.with_event_id(C.clean(df, keep=EVENT_KEY), EVENT_KEY)
    time = F.to_timestamp(F.concat("FL_DATE", F.lit("T00:00:00Z")))
    rows = cleaned.withColumn("event_time", time)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGE.fields])


_ID_SQL = " || '-' || ".join(f"CAST({c} AS VARCHAR)" for c in KEY) + " || '-' || replace(FL_DATE, '-', '\\-')"
_LONGS = ["delayed", "cancelled", "diverted"]
_JSON_SQL = names([f"'{c}': {c}" for c in CLEAN_NAMES])
_EVENTS = f"SELECT {_ID_SQL} AS event_id, FL_DATE || 'T00:00:00.000000Z' AS event_time, * FROM clean"


@query(
    O.on_clean(
        "SELECT event_id AS key, CAST(to_json({'event_id': event_id, 'event_time': event_time, " + _JSON_SQL + "}) AS VARCHAR) AS value FROM events_",
        events_=_EVENTS,
    )
)
def message_envelope(spark, sf):
    return M.encode(messages(flights(spark, sf, KEY)), ["event_id"], MESSAGE.names)


_MESSAGE_SQL = names(["event_id"] + [f"CAST({c} AS BIGINT) AS {c}" if c in _LONGS else c for c in CLEAN_NAMES])


@query(O.on_clean(f"SELECT substr(event_time, 1, 10) AS event_date, {_MESSAGE_SQL} FROM events_", events_=_EVENTS))
def message_decode(spark, sf):
    path = fresh_dir(spark, "messages")
    M.publish(M.encode(messages(flights(spark, sf, KEY)), ["event_id"], MESSAGE.names), "parquet", {"path": path})
    # The reader knows the layout only from the schema that was stored beside the messages.
    stored = fresh_dir(spark, "schema")
    M.write_schema(spark.range(0), json.dumps(M.avro_schema(MESSAGE)), stored)
    decoded = M.decode_stored(spark.read.parquet(path), stored)
    day = F.date_format(F.to_utc_timestamp("event_time", F.current_timezone()), "yyyy-MM-dd").alias("event_date")
    return decoded.select(day, "event_id", *CLEAN_NAMES)


RULES = [
    M.Rule("FL_DATE", T.DateType(), required=True),
    M.Rule("OP_CARRIER", T.StringType(), required=True),
    M.Rule("CRS_DEP_TIME", T.DoubleType(), required=True, low=0, high=2400),
    M.Rule("DEP_TIME", T.DoubleType(), low=1, high=1900),
    M.Rule("DEP_DELAY", T.DoubleType(), required=True, low=-15),
    M.Rule("TAXI_OUT", T.DoubleType(), high=30),
    M.Rule("DISTANCE", T.DoubleType(), required=True, low=0),
    M.Rule("CANCELLED", T.IntegerType(), required=True, low=0, high=1),
]


def _rule_sql(r: M.Rule) -> str:
    text = f"CASE WHEN trim({r.column}) IN ({names([repr(t) for t in NA_TOKENS])}) THEN NULL ELSE {r.column} END"
    kind = {"string": "VARCHAR", "date": "DATE"}.get(r.kind.simpleString(), "DOUBLE")
    value = f"TRY_CAST({text} AS {kind})"
    limits = [f"{value} < {r.low}"] * (r.low is not None) + [f"{value} > {r.high}"] * (r.high is not None)
    return (
        f"SELECT '{r.column}' AS \"column\", count(*) AS n, "
        f"count(CASE WHEN {str(r.required).upper()} AND ({text}) IS NULL THEN 1 END) AS n_missing, "
        f"count(CASE WHEN ({text}) IS NOT NULL AND {value} IS NULL THEN 1 END) AS n_wrong_type, "
        f"count(CASE WHEN {' OR '.join(limits) or 'FALSE'} THEN 1 END) AS n_out_of_range FROM text"
    )


@query(O.on_text(" UNION ALL ".join(_rule_sql(r) for r in RULES)))
def contract_check(spark, sf):
    return M.contract_check(flights_text(spark, sf), RULES)


def _rule_scores(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two prediction tables made by simple rules, so that SQL can make them too."""
    rows = messages(df)
    routes = ["event_id", "event_time", "origin_airport", "destination_airport"]
    grounded = F.when(F.col("taxi_out_time") == 0, 1.0).otherwise(0.0).alias("cancelled_prediction")
    astray = F.when(F.col("taxi_out_time") > 25, 1.0).otherwise(0.0).alias("diverted_prediction")
    return rows.select(*routes, grounded), rows.select("event_id", "event_time", astray)


_SCORES = dict(
    events_=_EVENTS,
    scores="SELECT event_id, origin_airport, destination_airport, CAST(CASE WHEN taxi_out_time = 0 THEN 1 ELSE 0 END AS DOUBLE) AS cancelled_prediction, "
    "CAST(CASE WHEN taxi_out_time > 25 THEN 1 ELSE 0 END AS DOUBLE) AS diverted_prediction FROM events_",
)
_JOINED = ["event_id", "origin_airport", "destination_airport", "cancelled_prediction", "diverted_prediction"]


@query(O.on_clean(f"SELECT {names(_JOINED)} FROM scores", **_SCORES))
def prediction_join(spark, sf):
    left, right = _rule_scores(flights(spark, sf, KEY))
    return X.join_predictions(left, right, ["event_id"]).select(*_JOINED)


@query(
    O.on_clean(
        "SELECT a.origin_airport, a.destination_airport, cancelled_prediction, diverted_prediction, a.n * b.n AS n FROM "
        "(SELECT origin_airport, destination_airport, cancelled_prediction, count(*) AS n FROM scores GROUP BY ALL) a JOIN "
        "(SELECT origin_airport, destination_airport, diverted_prediction, count(*) AS n FROM scores GROUP BY ALL) b "
        "ON a.origin_airport = b.origin_airport AND a.destination_airport = b.destination_airport",
        **_SCORES,
    )
)
def route_join_counts(spark, sf):
    rows = messages(flights(spark, sf, KEY))
    route = ["origin_airport", "destination_airport"]
    left = rows.select(*route, F.when(F.col("taxi_out_time") == 0, 1.0).otherwise(0.0).alias("cancelled_prediction"))
    right = rows.select(*route, F.when(F.col("taxi_out_time") > 25, 1.0).otherwise(0.0).alias("diverted_prediction"))
    return X.route_join_counts(left, right, route, ("cancelled_prediction", "diverted_prediction"))


def _flight_stream(spark: SparkSession, sf: str) -> DataFrame:
    layout = T.StructType(KEY_AND_RAW.fields + [T.StructField("year", T.IntegerType())])
    return X.source(spark, "parquet", {"path": stored_path(spark, sf)}, layout).drop("year")


def _run(df: DataFrame, label: str) -> DataFrame:
    """Everything that is there now, through a Parquet sink, read back."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    X.drain(X.start(df, "parquet", fresh_dir(spark, f"{label}-checkpoint"), {"path": path}, {"availableNow": True}))
    return spark.read.schema(df.schema).parquet(path)


@query(O.on_clean(f"SELECT {names(CLEAN_NAMES)} FROM clean"))
def stream_clean(spark, sf):
    return _run(C.clean(_flight_stream(spark, sf)), "stream-clean")


#: Flights of one run of a stream join, about: the state of two runs is what it holds.
RUN_ROWS = 4_000_000


def _day_runs(spark: SparkSession, sf: str, rows: int) -> list[list[Row]]:
    """The days of the flights and their numbers of rows, in runs of ``rows`` each or a day more. The driver gets a number for each day."""
    days = flights(spark, sf, ["year"]).groupBy("year", "FL_DATE").agg(F.count("*").alias("n")).collect()
    spans, held = [], 0
    for day in sorted(days, key=lambda r: (r.FL_DATE is not None, r.FL_DATE)):
        if not spans or held >= rows:
            spans.append([])
            held = 0
        spans[-1].append(day)
        held += day.n
    return spans


def _spans(runs: list[list[Row]]) -> list[Column]:
    out = []
    for some in runs:
        known = [r for r in some if r.FL_DATE is not None]
        # The years let Spark skip the folders of all others.
        inside = F.lit(False)
        if known:
            inside = F.col("year").isin(sorted({r.year for r in known})) & F.col("FL_DATE").between(known[0].FL_DATE, known[-1].FL_DATE)
        out.append(inside | F.col("FL_DATE").isNull() if len(known) < len(some) else inside)
    return out


def date_spans(spark: SparkSession, sf: str, rows: int | None = None) -> list[Column]:
    """Conditions that part the flights into runs in the order of their dates, of ``rows`` each or a day more."""
    return _spans(_day_runs(spark, sf, rows or RUN_ROWS))


def _short_runs(spark: SparkSession, sf: str) -> tuple[list[Column], dict[str, str]]:
    """As ``date_spans``, with options for streams over such runs."""
    runs = _day_runs(spark, sf, RUN_ROWS)
    most = max((sum(day.n for day in some) for some in runs), default=0)
    return _spans(runs), X.SHORT | X.state_parts(spark, most)


@query(O.on_clean(f"SELECT {names(_JOINED)} FROM scores", **_SCORES))
def stream_join_rules(spark, sf):
    """Flights come in the order of time, in several runs, so a short delay is enough and each run drops the state of the one before."""
    inbox, out, checkpoint = (fresh_dir(spark, f"stream-join{n}") for n in ("-inbox", "", "-checkpoint"))
    joined = None
    spans, state = _short_runs(spark, sf)
    for some in spans:
        rows = flights(spark, sf, [*KEY, "year"]).where(some).drop("year")
        rows.write.mode("append").parquet(inbox)
        left, _ = _rule_scores(X.source(spark, "parquet", {"path": inbox}, rows.schema))
        _, right = _rule_scores(X.source(spark, "parquet", {"path": inbox}, rows.schema))
        joined = X.join_predictions(left, right, ["event_id"], "event_time", "10 minutes").select(*_JOINED)
        X.drain(X.start(joined, "parquet", checkpoint, {"path": out}, {"availableNow": True}, state=state))
    if joined is None:
        left, right = _rule_scores(flights(spark, sf, KEY))
        return X.join_predictions(left, right, ["event_id"]).select(*_JOINED)
    return spark.read.schema(joined.schema).parquet(out)


_INBOX = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def _inbox(spark: SparkSession, sf: str) -> str:
    """The messages of all flights as a folder that a stream can read."""
    path = fresh_dir(spark, "inbox")
    M.publish(M.encode(messages(flights(spark, sf, KEY)), ["event_id"], MESSAGE.names), "parquet", {"path": path})
    return path


def year_spans(spark: SparkSession, sf: str, n: int) -> list[list[int]]:
    """The years of the flights in n runs of about equal length, in their order."""
    years = [r.year for r in flights(spark, sf, ["year"]).select("year").distinct().orderBy("year").collect()]
    bounds = [len(years) * i // n for i in range(n + 1)]
    return [part for a, b in zip(bounds, bounds[1:]) if (part := years[a:b])]


@query(O.on_clean("SELECT event_id, TRUE AS both_sum_to_one FROM events_", events_=_EVENTS))
def stream_join(spark, sf):
    """Two models, fitted and saved one by one, score two streams of the same messages. Messages come in the order of time, in several
    runs, so a short delay is enough and each run drops the state of the one before."""
    df, inbox, loaded = cleaned(spark, sf), fresh_dir(spark, "inbox"), []
    for target in L.TARGETS:
        path = fresh_dir(spark, f"model-{target}")
        L.save(L.fit(df, "logreg", [target]), path)
        loaded.append(L.load(path))
    out, checkpoint = fresh_dir(spark, "stream-join"), fresh_dir(spark, "stream-join-checkpoint")
    spans, state = _short_runs(spark, sf)
    for span in spans:
        some = flights(spark, sf, [*KEY, "year"]).where(span).drop("year")
        M.publish(M.encode(messages(some), ["event_id"], MESSAGE.names), "parquet", {"path": inbox})
        sides = [X.score_messages(X.source(spark, "parquet", {"path": inbox}, _INBOX), m, [t]) for m, t in zip(loaded, L.TARGETS)]
        joined = X.join_predictions(sides[0], sides[1].drop("origin_airport", "destination_airport"), ["event_id"], "event_time", "10 minutes")
        X.drain(X.start(joined, "parquet", checkpoint, {"path": out}, {"availableNow": True}, state=state))
    sure = [F.abs(F.aggregate(f"{t}_probability", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9 for t in L.TARGETS]
    return spark.read.schema(joined.schema).parquet(out).select("event_id", (sure[0] & sure[1]).alias("both_sum_to_one"))


@query(O.on_clean("SELECT event_id, TRUE AS keyed, TRUE AS sums_to_one, TRUE AS known_classes FROM events_", events_=_EVENTS))
def stream_score(spark, sf):
    """Two models, one pass, two sinks; what is shown of each message is certain whatever the models learnt."""
    model = L.fit(cleaned(spark, sf), {"cancelled": "mlp", "diverted": "gbt"}, settings=L.GBT_SETTINGS)
    scored = X.score_messages(X.source(spark, "parquet", {"path": _inbox(spark, sf)}, _INBOX), model)
    table, outbox = fresh_dir(spark, "predictions"), fresh_dir(spark, "prediction-messages")
    first, follow = X.two_sinks(scored, table, fresh_dir(spark, "two-sinks"), ("parquet", {"path": outbox}), X.prediction_messages, {"availableNow": True})
    X.drain(first)
    X.drain(follow())
    sent = spark.read.schema(_INBOX).parquet(outbox)
    read = M.decode(sent, prediction_layout(L.TARGETS), keep=["key"])
    sure = [F.abs(F.aggregate(f"{t}_probability", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9 for t in L.TARGETS]
    classes = [F.col(f"{t}_prediction").isin(0.0, 1.0) for t in L.TARGETS]
    return read.select("event_id", (F.col("key") == F.col("event_id")).alias("keyed"), (sure[0] & sure[1]).alias("sums_to_one"), (classes[0] & classes[1]).alias("known_classes"))
