"""Messages of one schema read by another: Avro's resolution rules as column expressions.

A message is decoded by the schema it was written with; ``resolve`` compares that with the reader's schema once, on the driver, and gives
an expression that turns the one into the other: numbers are promoted, fields are matched by name or alias, fields the reader lacks are
dropped, fields the writer lacked get their default. Rows of many schema versions are then one projection over one scan, with no join.

What the rules forbid for a pair of schemas is listed by path and rule before any row is read. What depends on the value (a null where
the reader has none, an unknown symbol) is found row by row and named in a column beside the row, which is kept.

Cases: an unknown version, a refused pair and an unreadable value give nulls and a reason. Null versions are unknown. Columns to
be kept may have any names but those of the reader's fields.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ontime.operators import messages
from ontime.operators.messages import JSON_OPTIONS, write_schema

# Promotions of the Avro specification, and the names of the rules as used in reports.
PROMOTIONS = {"int": ["long", "float", "double"], "long": ["float", "double"], "float": ["double"], "string": ["bytes"], "bytes": ["string"]}
RULES = {
    "type": "types do not match and no promotion applies",
    "name": "names of records, enums or fixed types do not match",
    "default": "the reader's field is not in the writer's record and has no default",
    "size": "sizes of fixed types differ",
    "decimal": "precision or scale of decimals differ",
    "union": "no branch of the reader's union takes the writer's type",
    "null": "the value is null and the reader's type is not",
    "symbol": "the value is not among the reader's symbols and there is no default symbol",
    "unreadable": "the value cannot be read by its own schema",
    "version": "no schema is known for the message's version",
}


@dataclass(frozen=True)
class Refusal:
    """A place of the reader's schema, and the rule that the pair breaks there."""

    path: str
    rule: str


@dataclass
class Resolution:
    """How to turn the writer's value into the reader's, or why not; ``breaks`` are rules that single values may break."""

    value: Callable[[Column], Column]
    refused: list[Refusal] = field(default_factory=list)
    breaks: list[tuple[Refusal, Callable[[Column], Column]]] = field(default_factory=list)


def read_type(kind) -> T.DataType:
    """The Spark type for values of an Avro type. Anything in it may be null: a message that breaks a rule still is a row."""
    return _nullable(messages.read_type(kind))


def _nullable(kind: T.DataType) -> T.DataType:
    match kind:
        case T.StructType():
            return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
        case T.ArrayType():
            return T.ArrayType(_nullable(kind.elementType))
        case T.MapType():
            return T.MapType(kind.keyType, _nullable(kind.valueType))
    return kind


def _refuse(path: str, rule: str) -> Resolution:
    return Resolution(lambda c: F.lit(None), [Refusal(path or ".", rule)])


def _name(kind) -> str:
    """The type's plain name, "union" for a list of branches."""
    if isinstance(kind, list):
        return "union"
    return _name(kind["type"]) if isinstance(kind, dict) and not isinstance(kind["type"], str) else kind["type"] if isinstance(kind, dict) else kind


def _plain(kind):
    """A type without needless wrapping: {"type": {...}} and {"type": "int"}."""
    while isinstance(kind, dict) and isinstance(kind["type"], (dict, list)):
        kind = kind["type"]
    return kind


def _short(name: str) -> str:
    return name.rsplit(".", 1)[-1]


def _named_alike(writer: dict, reader: dict) -> bool:
    """Names are compared without their namespaces; the reader may know the writer's as an alias."""
    return _short(writer["name"]) in {_short(n) for n in [reader["name"], *reader.get("aliases", [])]}


def _logical(kind) -> str | None:
    return kind.get("logicalType") if isinstance(kind, dict) else None


def _breaks(path: str, rule: str, when: Callable[[Column], Column]) -> list[tuple[Refusal, Callable[[Column], Column]]]:
    return [(Refusal(path or ".", rule), when)]


def resolve(writer, reader, path: str = "") -> Resolution:
    """The rules for one pair of types. Values are columns of the Spark types that ``read_type`` gives for each."""
    writer, reader = _plain(writer), _plain(reader)
    w, r = _name(writer), _name(reader)
    if w == "union":
        return _from_union(writer, reader, path)
    if r == "union":
        tries = [resolve(writer, branch, path) for branch in reader if _name(branch) != "null"]
        # The specification takes the first branch that matches; the same type matches before any promotion does.
        same = [t for t, b in zip(tries, [b for b in reader if _name(b) != "null"]) if not t.refused and _name(_plain(b)) == w]
        able = same or [t for t in tries if not t.refused]
        if w == "null":
            return Resolution(lambda c: F.lit(None).cast(read_type(reader))) if any(_name(b) == "null" for b in reader) else _refuse(path, "union")
        if able:
            return Resolution(lambda c, one=able[0]: one.value(c).cast(read_type(reader)), [], able[0].breaks)
        return tries[0] if len(tries) == 1 else _refuse(path, "union")
    if w != r:
        if r not in PROMOTIONS.get(w, []):
            return _refuse(path, "type")
        number = _unlogical(writer)
        return Resolution(lambda c: _as_logical(number(c).cast(read_type(r)), reader))
    match w:
        case "record":
            return _record(writer, reader, path)
        case "array":
            return _inside(resolve(writer["items"], reader["items"], f"{path}[]"), lambda c, f: F.transform(c, f), lambda c, f: F.exists(c, f))
        case "map":
            some = lambda c, f: F.exists(F.map_values(c), f)
            return _inside(resolve(writer["values"], reader["values"], f"{path}{{}}"), lambda c, f: F.transform_values(c, lambda _, v: f(v)), some)
        case "enum":
            return _enum(writer, reader, path)
        case "fixed":
            if not _named_alike(writer, reader):
                return _refuse(path, "name")
            return Resolution(lambda c: c) if writer["size"] == reader["size"] else _refuse(path, "size")
    if "decimal" in (_logical(writer), _logical(reader)):
        digits = [(k.get("precision"), k.get("scale", 0)) if _logical(k) == "decimal" else None for k in (writer, reader)]
        return Resolution(lambda c: c) if digits[0] == digits[1] else _refuse(path, "decimal")
    number = _unlogical(writer)
    return Resolution((lambda c: c) if _logical(writer) == _logical(reader) else lambda c: _as_logical(number(c), reader))


def _unlogical(kind) -> Callable[[Column], Column]:
    """A date or time as the number it is stored as."""
    match _logical(kind):
        case "date":
            return lambda c: F.unix_date(c)
        case "timestamp-micros":
            return lambda c: F.unix_micros(c)
        case "local-timestamp-micros":
            return lambda c: F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), "UTC"))
    return lambda c: c


def _as_logical(c: Column, kind) -> Column:
    match _logical(kind):
        case "date":
            return F.date_from_unix_date(c.cast("int"))
        case "timestamp-micros":
            return F.timestamp_micros(c.cast("bigint"))
        case "local-timestamp-micros":
            return F.timestamp_micros(c.cast("bigint")).cast("timestamp_ntz")
    return c


def _from_union(writer: list, reader, path: str) -> Resolution:
    """Spark reads ["null", X] as X that may be null; other unions have no Spark type here."""
    branches = [b for b in writer if _name(b) != "null"]
    if len(branches) != 1:
        return _refuse(path, "union")
    one = resolve(branches[0], reader, path)
    if one.refused or len(branches) == len(writer):
        return one
    if _name(_plain(reader)) == "union" and any(_name(b) == "null" for b in _plain(reader)):
        return one
    return Resolution(one.value, [], one.breaks + _breaks(path, "null", lambda c: c.isNull()))


def _inside(item: Resolution, apply, some) -> Resolution:
    """A resolution for every element of a collection; a rule is broken if any element breaks it."""
    breaks = [(rule, lambda c, broken=broken: some(c, broken)) for rule, broken in item.breaks]
    return Resolution(lambda c: apply(c, item.value), item.refused, breaks)


def _enum(writer: dict, reader: dict, path: str) -> Resolution:
    if not _named_alike(writer, reader):
        return _refuse(path, "name")
    known = reader["symbols"]
    if set(writer["symbols"]) <= set(known):
        return Resolution(lambda c: c)
    if "default" in reader:
        return Resolution(lambda c: F.when(c.isin(known) | c.isNull(), c).otherwise(F.lit(reader["default"])))
    return Resolution(lambda c: F.when(c.isin(known), c), [], _breaks(path, "symbol", lambda c: ~c.isin(known)))


def _record(writer: dict, reader: dict, path: str) -> Resolution:
    if not _named_alike(writer, reader):
        return _refuse(path, "name")
    there = {f["name"]: f for f in writer["fields"]}
    cells, refused, breaks = [], [], []
    for f in reader["fields"]:
        at = f"{path}.{f['name']}" if path else f["name"]
        source = next((there[n] for n in [f["name"], *f.get("aliases", [])] if n in there), None)
        if source is None:
            if "default" in f:
                cells.append((f["name"], lambda c, f=f: default_value(f["default"], f["type"])))
            else:
                refused.append(Refusal(at, "default"))
            continue
        one = resolve(source["type"], f["type"], at)
        refused += one.refused
        cells.append((f["name"], lambda c, one=one, n=source["name"]: one.value(c.getField(n))))
        breaks += [(rule, lambda c, broken=broken, n=source["name"]: c.isNotNull() & broken(c.getField(n))) for rule, broken in one.breaks]
    # A missing record stays missing; it isn't a record of defaults.
    kind = read_type(reader)
    return Resolution(lambda c: F.when(c.isNotNull(), F.struct(*[v(c).alias(n) for n, v in cells]).cast(kind)), refused, breaks)


def default_value(default, kind) -> Column:
    """A field's default. For a union it is of the first branch; bytes are written as text of their code points."""
    kind = _plain(kind)
    if isinstance(kind, list):
        wanted, kind = read_type(kind), _plain(kind[0])
    else:
        wanted = read_type(kind)
    if default is None or _name(kind) == "null":
        return F.lit(None).cast(wanted)
    if _name(kind) in ("bytes", "fixed"):
        return F.lit(default.encode("latin-1")).cast(wanted)
    if _name(kind) in ("record", "array", "map"):
        return F.from_json(F.lit(json.dumps(default)), wanted)
    return _as_logical(F.lit(default), kind).cast(wanted)


def refusals(spark: SparkSession, writers: dict[str, dict], reader: dict) -> DataFrame:
    """(version, path, rule, meaning) of every rule that a version breaks against the reader; empty when all can be read."""
    rows = [(v, r.path, r.rule, RULES[r.rule]) for v, w in sorted(writers.items()) for r in resolve(w, reader).refused]
    return spark.createDataFrame(rows, "version string, path string, rule string, meaning string")


def write_versions(spark: SparkSession, writers: dict[str, dict], path: str) -> None:
    """Each version's schema as a text of its own, beside the messages."""
    for version, schema in writers.items():
        write_schema(spark.range(0), json.dumps(schema), f"{path}/version={version}")


def read_versions(spark: SparkSession, path: str) -> dict[str, dict]:
    """As many rows as there are versions."""
    rows = spark.read.schema("value string, version string").text(path, wholetext=True).collect()
    return {r.version: json.loads(r.value) for r in rows}


def decode_versions(df: DataFrame, writers: dict[str, dict], reader: dict, version: str = "version", keep: list[str] | None = None, refused: str = "refused") -> DataFrame:
    """Message values of several schema versions as the reader's columns, and a list of what was refused of each message."""
    keep, used = keep or [], {c.lower() for c in keep or []}

    def spare(name: str) -> str:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        return name

    text, known, is_whole, row = (spare(n) for n in ("_text", "_version", "_whole", "_row"))
    whole, bodies, values, reasons = F.col(is_whole), {}, [], []
    for i, (name, writer) in enumerate(sorted(writers.items())):
        here = F.col(known) == F.lit(name)
        found = resolve(writer, reader)
        if found.refused:
            reasons.append(F.when(here, F.array(*[F.lit(f"{r.path}: {r.rule}") for r in found.refused])))
            continue
        body = spare(f"_body{i}")
        bodies[body] = F.when(here & whole, F.from_json(text, read_type(writer), JSON_OPTIONS | {"columnNameOfCorruptRecord": "_unreadable"}))
        data = F.col(body)
        broken = F.array(*[F.when(when(data), F.lit(f"{r.path}: {r.rule}")) for r, when in found.breaks]) if found.breaks else F.array().cast("array<string>")
        reason = F.when(whole, F.array_compact(broken)).otherwise(F.array(F.lit(".: unreadable")))
        values.append(F.when(here & whole, found.value(data)))
        reasons.append(F.when(here, reason))
    value = F.coalesce(*values) if values else F.lit(None).cast(read_type(reader))
    why = F.coalesce(*reasons, F.array(F.lit(".: version"))).alias(refused)
    # A column for each step: what the next one uses for every field is worked out once a message.
    texts = df.select(*keep, F.col("value").cast("string").alias(text), F.col(version).cast("string").alias(known))
    # Text that isn't a record at all would come back as a record of nulls; its first character tells.
    marked = texts.withColumn(is_whole, F.col(text).rlike(r"^\s*\{.*\}\s*$") & F.try_parse_json(text).isNotNull())
    return marked.withColumns(bodies).select(*keep, value.alias(row), why).select(*keep, f"{row}.*", refused)
