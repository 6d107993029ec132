"""Table layouts and the value lists the operators share."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw record layout, in file order.
RAW_COLUMNS = [
    ("FL_DATE", "string"),
    ("OP_CARRIER", "string"),
    ("OP_CARRIER_FL_NUM", "double"),
    ("ORIGIN", "string"),
    ("DEST", "string"),
    ("CRS_DEP_TIME", "double"),
    ("DEP_TIME", "double"),
    ("DEP_DELAY", "double"),
    ("TAXI_OUT", "double"),
    ("WHEELS_OFF", "double"),
    ("WHEELS_ON", "double"),
    ("TAXI_IN", "double"),
    ("CRS_ARR_TIME", "double"),
    ("ARR_TIME", "double"),
    ("ARR_DELAY", "double"),
    ("CANCELLED", "double"),
    ("CANCELLATION_CODE", "string"),
    ("DIVERTED", "double"),
    ("CRS_ELAPSED_TIME", "double"),
    ("ACTUAL_ELAPSED_TIME", "double"),
    ("AIR_TIME", "double"),
    ("DISTANCE", "double"),
    ("CARRIER_DELAY", "double"),
    ("WEATHER_DELAY", "double"),
    ("NAS_DELAY", "double"),
    ("SECURITY_DELAY", "double"),
    ("LATE_AIRCRAFT_DELAY", "double"),
]

# The cleaned record layout, in output order.
CLEAN_COLUMNS = [
    ("year", "int"),
    ("month", "int"),
    ("day_of_week", "string"),
    ("airline_identifier", "string"),
    ("origin_airport", "string"),
    ("destination_airport", "string"),
    ("scheduled_departure_time", "double"),
    ("departure_delay", "double"),
    ("taxi_out_time", "double"),
    ("taxi_in_time", "double"),
    ("distance", "double"),
    ("delayed", "int"),
    ("delayed_time", "double"),
    ("cancelled", "int"),
    ("diverted", "int"),
    ("arrival_delay", "double"),
]

# Raw name to cleaned name.
RENAMES = {
    "OP_CARRIER": "airline_identifier",
    "ORIGIN": "origin_airport",
    "DEST": "destination_airport",
    "CRS_DEP_TIME": "scheduled_departure_time",
    "DEP_DELAY": "departure_delay",
    "TAXI_OUT": "taxi_out_time",
    "TAXI_IN": "taxi_in_time",
    "DISTANCE": "distance",
    "CANCELLED": "cancelled",
    "DIVERTED": "diverted",
    "ARR_DELAY": "arrival_delay",
}

# The five delay causes.
CAUSES = [
    "CARRIER_DELAY",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "SECURITY_DELAY",
    "LATE_AIRCRAFT_DELAY",
]

# Measures the second cleaning variant fills with zero.
ZERO_FILLED = ["arrival_delay", "taxi_in_time", "taxi_out_time", "departure_delay"]

# Cancellation reason codes.
CANCEL_REASONS = [
    ("A", "Airline/Carrier"),
    ("B", "Weather"),
    ("C", "National Air System"),
    ("D", "Security"),
]

# Text that means "no value" in a CSV cell (the pandas defaults and NA, null, empty).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Columns of the yearly reports.
REPORT_CATEGORIES = ["FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CANCELLATION_CODE"]
REPORT_MEASURES = [
    "DEP_DELAY", "WEATHER_DELAY", "CARRIER_DELAY", "ARR_DELAY", "NAS_DELAY", "SECURITY_DELAY",
    "TAXI_OUT", "TAXI_IN", "LATE_AIRCRAFT_DELAY", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME",
    "AIR_TIME", "DISTANCE",
]
REPORT_FLAGS = ["CANCELLED", "DIVERTED"]

# Columns of the pairwise correlation matrix.
CORRELATED = [
    "DEP_DELAY", "TAXI_OUT", "ARR_DELAY", "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY",
    "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY", "DISTANCE", "AIR_TIME", "CRS_ELAPSED_TIME",
    "ACTUAL_ELAPSED_TIME",
]


KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<double>": T.ArrayType(T.DoubleType()),
}


def _struct(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in columns])


RAW = _struct(RAW_COLUMNS)
RAW_NAMES = RAW.names
RAW_TEXT = [name for name, kind in RAW_COLUMNS if kind == "string"]
RAW_NUMERIC = [name for name, kind in RAW_COLUMNS if kind == "double"]

CLEAN = _struct(CLEAN_COLUMNS)
CLEAN_NAMES = CLEAN.names

# The message carries the cleaned record plus an id and a time to join and bound state by.
MESSAGE = _struct(
    [("event_id", "string"), ("event_time", "timestamp")]
    + [(n, "bigint" if n in ("delayed", "cancelled", "diverted") else k) for n, k in CLEAN_COLUMNS]
)

ROUTE = [("event_id", "string"), ("event_time", "timestamp"), ("origin_airport", "string"), ("destination_airport", "string")]


def prediction_layout(targets: list[str]) -> T.StructType:
    """What scoring returns for these targets: the event, its time and route, and two columns per target."""
    return _struct(ROUTE + [c for t in targets for c in ((f"{t}_prediction", "double"), (f"{t}_probability", "array<double>"))])


PREDICTION = prediction_layout(["cancelled", "diverted"])


def numeric_columns(schema: T.StructType) -> list[str]:
    """Names of the whole-number, decimal, float and double columns."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]


def exact_columns(schema: T.StructType) -> list[str]:
    """Names of the numeric columns whose values a double may not hold."""
    kinds = (T.FloatType, T.DoubleType)
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, kinds)]


def categorical_columns(schema: T.StructType) -> list[str]:
    """Names of the string and boolean columns."""
    return [f.name for f in schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
