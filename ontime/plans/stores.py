"""Queries on stored states and tables: sketches by year, bucketed joins, Parquet footers, exact splits, wide features and matrices."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ontime.functions.values import real
from ontime.operators import features as V, relate as R, sample as S, sketches as K
from ontime.plans import oracle as O
from ontime.plans.flights import EVENT_KEY, KEY, KEY_AND_RAW, flights, stored_path
from ontime.plans.registry import _JOINED, _SCORES, _matrix_sql, _md5_sql, _rule_scores, cleaned, names, query, round_all
from ontime.schema import RAW_NAMES, RAW_NUMERIC
from ontime.session import fresh_dir
from ontime.sources.bucketed import join_bucketed, write_bucketed
from ontime.sources.footers import footer_report
from ontime.sources.parquet import read_years

_stored: dict[tuple[str, str], K.Store] = {}
_MEASURES, _VALUES = ["DEP_DELAY", "ARR_DELAY"], ["ORIGIN", "DEST", "OP_CARRIER_FL_NUM"]


def _flight_sketches(spark, sf):
    """States of the flights by year and carrier, added one year after the other, once for each application and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        store = K.Store(fresh_dir(spark, "sketches"), ["OP_CARRIER"], _MEASURES, _VALUES)
        path = stored_path(spark, sf)
        years = [r.year for r in read_years(spark, path, KEY_AND_RAW).select("year").distinct().orderBy("year").collect()]
        for some in (years[:-1], years):
            store.add(spark, some, lambda wanted: read_years(spark, path, KEY_AND_RAW, wanted))
        _stored[key] = store
    return _stored[key].read(spark, KEY_AND_RAW)


#: Twice the published bound, which holds in 99 of 100 cases: hundreds of checks then never miss it by chance.
_RANK_ERROR = 2 * K.rank_error()
_WANTED = {"median": 0.5, "upper": 0.9}


@query(
    O.on_flights(
        O.per_column(
            _MEASURES,
            "SELECT '{c}' AS measure, OP_CARRIER, count({c}) AS n_known, TRUE AS median_within, TRUE AS upper_within FROM flights GROUP BY OP_CARRIER",
        )
    )
)
def median_by_sketch_store(spark, sf):
    """Quantiles by carrier out of merged yearly states, held against the exact ranks that the returned values have."""
    stored, rows, out = _flight_sketches(spark, sf), flights(spark, sf), None
    for m in _MEASURES:
        found = K.quantiles(stored, ["OP_CARRIER"], m, _WANTED)
        value = real(m)
        # The share of values below, and up to, the returned one must lie on either side of the wanted share.
        sides = [F.count_if(value < F.col(q)).alias(f"below_{q}") for q in _WANTED] + [F.count_if(value <= F.col(q)).alias(f"upto_{q}") for q in _WANTED]
        held = rows.select("OP_CARRIER", m).join(found, "OP_CARRIER").groupBy("OP_CARRIER", "n_known").agg(*sides)
        within = [
            ((F.col(f"below_{q}") <= (p + _RANK_ERROR) * F.col("n_known")) & (F.col(f"upto_{q}") >= (p - _RANK_ERROR) * F.col("n_known"))).alias(f"{q}_within")
            for q, p in _WANTED.items()
        ]
        one = held.select(F.lit(m).alias("measure"), "OP_CARRIER", "n_known", *within)
        out = one if out is None else out.union(one)
    return out


@query(
    O.on_flights(
        O.per_column(_VALUES, "SELECT year, '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, TRUE AS near FROM flights GROUP BY year")
    )
)
def distinct_by_sketch_store(spark, sf):
    """Distinct values by year out of states by year and carrier, next to the exact counts."""
    found = K.distinct(_flight_sketches(spark, sf), ["year"], _VALUES).withColumnRenamed("n_distinct", "estimate")
    exact = flights(spark, sf, ["year"]).groupBy("year").agg(*[F.count_distinct(c).alias(c) for c in _VALUES])
    exact = exact.select("year", F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in _VALUES])))
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= 5 * K.distinct_error() * F.col("n_distinct") + 1
    return exact.join(found, ["year", "column"]).select("year", "column", "n_distinct", near.alias("near"))


@query(O.on_flights("SELECT year, count(*) AS n, count(DISTINCT OP_CARRIER) AS n_states FROM flights GROUP BY year"))
def sketch_store_years(spark, sf):
    return _flight_sketches(spark, sf).groupBy("year").agg(F.sum("n").alias("n"), F.count("*").alias("n_states"))


#: Rows of a bucket, about: one task sorts them, in memory.
BUCKET_ROWS = 1_000_000


@query(O.on_clean(f"SELECT {names(_JOINED)} FROM scores", **_SCORES))
def prediction_join_bucketed(spark, sf):
    """The join of two prediction tables that are stored by event: no row moves."""
    left, right = _rule_scores(flights(spark, sf, KEY))
    # The count is read from the stored table's footers.
    buckets = max(8, -(-flights(spark, sf).count() // BUCKET_ROWS))
    tables = [write_bucketed(t, ["event_id"], buckets) for t in (left, right.drop("event_time"))]
    return join_bucketed(spark, *tables, ["event_id"]).select(*_JOINED)


@query(
    O.on_flights(
        " UNION ALL ".join(
            f"SELECT year, '{c}' AS \"column\", count(*) AS n, count({c}) AS n_known, "
            + (f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max" if c in [*RAW_NUMERIC, *KEY] else "NULL::DOUBLE AS min, NULL::DOUBLE AS max")
            + " FROM flights GROUP BY year"
            for c in [*KEY, *RAW_NAMES]
        )
    )
)
def footer_ranges(spark, sf):
    layout = read_years(spark, stored_path(spark, sf), KEY_AND_RAW).schema
    return footer_report(spark, stored_path(spark, sf), layout, ["year"])


_PLACE = f"row_number() OVER (PARTITION BY DIVERTED ORDER BY {_md5_sql(42, KEY)}, {names(EVENT_KEY)})"


@query(
    O.on_flights(
        f"SELECT {names(EVENT_KEY)}, DIVERTED, CASE WHEN {_PLACE} <= count(*) OVER (PARTITION BY DIVERTED) * 8 // 10 THEN 'train' ELSE 'test' END AS part FROM flights"
    )
)
def exact_split(spark, sf):
    """The rare class of diverted flights is split exactly."""
    rows = flights(spark, sf, KEY).select(*EVENT_KEY, "DIVERTED")
    return S.exact_split(rows, 0.8, S.bucket_of(KEY, 42), "DIVERTED", EVENT_KEY)


@query(O.on_flights(_matrix_sql(RAW_NUMERIC, "coalesce({c}, 0)")))
def corr_matrix_tiled(spark, sf):
    return round_all(R.correlations_tiled(flights(spark, sf), RAW_NUMERIC, "zero", tile=5), ["corr"])


_INDEXED = O.per_column(
    V.CATEGORIES, "SELECT '{c}' AS name, {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS place FROM clean WHERE {c} IS NOT NULL GROUP BY {c}"
)
_OFFSETS = [" + ".join([str(len(V.NUMBERS)), *(f"(SELECT count(DISTINCT {d}) FROM clean)" for d in V.CATEGORIES[:i])]) for i in range(len(V.CATEGORIES) + 1)]


@query(
    O.on_clean(
        f"SELECT {names(KEY)}, CAST({_OFFSETS[-1]} AS BIGINT) AS width, concat_ws(',', "
        + names([f"CAST(i{i}.place + {_OFFSETS[i]} AS BIGINT)" for i in range(len(V.CATEGORIES))])
        + ") AS places, CAST(year + month + distance AS DOUBLE) AS some_numbers FROM clean "
        + " ".join(f"JOIN indexed i{i} ON i{i}.name = '{c}' AND i{i}.value = {c}" for i, c in enumerate(V.CATEGORIES)),
        indexed=_INDEXED,
    )
)
def sparse_features(spark, sf):
    """Feature vectors without a label on the driver: width, places of the categories, and numbers at their places."""
    cells = V.sparse_features(cleaned(spark, sf)).select(*KEY, vector_to_array("features").alias("v"))
    n = len(V.NUMBERS)
    hot = F.filter(F.sequence(F.lit(n), F.size("v") - 1), lambda i: F.get("v", i) == 1.0)
    some = F.get("v", F.lit(V.NUMBERS.index("year"))) + F.get("v", F.lit(V.NUMBERS.index("month"))) + F.get("v", F.lit(V.NUMBERS.index("distance")))
    return cells.select(*KEY, F.size("v").cast("bigint").alias("width"), F.concat_ws(",", hot).alias("places"), some.alias("some_numbers"))
