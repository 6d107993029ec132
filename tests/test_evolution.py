"""Avro's resolution rules on pairs of schemas, and messages of several versions read by one."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ontime.operators import evolution as V, messages as M


def record(*fields, name="R", **more):
    return {"type": "record", "name": name, "fields": [dict(zip(("name", "type"), f[:2])) | (f[2] if len(f) > 2 else {}) for f in fields], **more}


def rules(writer, reader):
    return sorted((r.path, r.rule) for r in V.resolve(writer, reader).refused)


def through(spark, writer, reader, *values):
    """Values written by one schema and read by the other, with what was refused."""
    sent = spark.createDataFrame([(json.dumps(v),) for v in values], "value string").select(F.lit("1").alias("version"), "value")
    return [r.asDict(True) for r in V.decode_versions(sent, {"1": writer}, reader).collect()]


PLAIN = ["boolean", "int", "long", "float", "double", "string", "bytes"]
# Which reader types each writer type may be read as, from the specification.
READABLE = {"int": {"long", "float", "double"}, "long": {"float", "double"}, "float": {"double"}, "string": {"bytes"}, "bytes": {"string"}}


@pytest.mark.parametrize("w", PLAIN)
@pytest.mark.parametrize("r", PLAIN)
def test_promotions(w, r):
    assert rules(w, r) == ([] if w == r or r in READABLE.get(w, ()) else [(".", "type")])


def test_refusals_name_path_and_rule():
    inner = record(("x", "string"), name="Inner")
    writer = record(("a", "string"), ("b", {"type": "array", "items": "double"}), ("c", inner), ("d", {"type": "fixed", "name": "F", "size": 4}), ("e", ["null", "string"]),
                    ("m", {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}))
    reader = record(("a", "int"), ("b", {"type": "array", "items": "int"}), ("c", record(("x", "int"), ("y", "int"), name="Inner")), ("d", {"type": "fixed", "name": "F", "size": 8}),
                    ("e", ["null", "int", "boolean"]), ("new", "int"), ("m", {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 3}))
    assert rules(writer, reader) == sorted([("a", "type"), ("b[]", "type"), ("c.x", "type"), ("c.y", "default"), ("d", "size"), ("e", "union"), ("new", "default"), ("m", "decimal")])
    assert rules(record(("a", "int"), name="A"), record(("a", "int"), name="B")) == [(".", "name")]
    assert rules(record(("a", "int"), name="ns.A"), record(("a", "int"), name="B", aliases=["A"])) == []
    assert set(V.RULES) >= {rule for _, rule in rules(writer, reader)}


def test_fields_by_name_alias_and_default(spark):
    writer = record(("old", "int"), ("gone", "string"), ("kept", "long"))
    reader = record(("new", "double", {"aliases": ["old"]}), ("kept", "long"), ("list", {"type": "array", "items": "int"}, {"default": [1, 2]}),
                    ("part", record(("x", "int"), name="P"), {"default": {"x": 5}}), ("maybe", ["null", "string"], {"default": None}), ("text", "string", {"default": "t"}),
                    ("raw", "bytes", {"default": "ÿA"}), ("day", {"type": "int", "logicalType": "date"}, {"default": 1}))
    (got,) = through(spark, writer, reader, {"old": 3, "gone": "x", "kept": 9_007_199_254_740_993})
    assert got == {"new": 3.0, "kept": 9_007_199_254_740_993, "list": [1, 2], "part": {"x": 5}, "maybe": None, "text": "t", "raw": bytearray(b"\xffA"), "day": dt.date(1970, 1, 2), "refused": []}


def test_nested_values_and_logical_types(spark):
    writer = record(("a", {"type": "array", "items": record(("x", "int"), name="E")}), ("m", {"type": "map", "values": "float"}), ("s", "string"),
                    ("t", {"type": "long", "logicalType": "timestamp-micros"}), ("n", "long"))
    reader = record(("a", {"type": "array", "items": record(("y", "double", {"aliases": ["x"]}), ("z", "string", {"default": "q"}), name="E")}), ("m", {"type": "map", "values": "double"}),
                    ("s", "bytes"), ("t", "long"), ("n", {"type": "long", "logicalType": "timestamp-micros"}))
    (got,) = through(spark, writer, reader, {"a": [{"x": 1}, {"x": 2}], "m": {"k": 0.5}, "s": "é", "t": "1970-01-01T00:00:01.000002Z", "n": 3_000_000})
    assert got["a"] == [{"y": 1.0, "z": "q"}, {"y": 2.0, "z": "q"}] and got["m"] == {"k": 0.5} and got["s"] == bytearray("é".encode())
    assert got["t"] == 1_000_002 and got["n"].timestamp() == 3


def test_values_that_break_a_rule_keep_their_row(spark):
    colours = {"type": "enum", "name": "C", "symbols": ["red", "green", "blue"]}
    few = {"type": "enum", "name": "C", "symbols": ["red", "green"]}
    writer = record(("n", ["null", "int"]), ("c", colours), ("d", colours), ("l", {"type": "array", "items": ["null", "int"]}), ("u", ["null", "int"]))
    reader = record(("n", "long"), ("c", few), ("d", few | {"default": "green"}), ("l", {"type": "array", "items": "long"}), ("u", ["null", "long"]))
    got = through(spark, writer, reader, {"n": 1, "c": "red", "d": "blue", "l": [1, 2], "u": None}, {"n": None, "c": "blue", "d": "red", "l": [1, None], "u": 4})
    assert got[0] == {"n": 1, "c": "red", "d": "green", "l": [1, 2], "u": None, "refused": []}
    assert got[1] == {"n": None, "c": None, "d": "red", "l": [1, None], "u": 4, "refused": ["n: null", "c: symbol", "l[]: null"]}


def test_unknown_versions_refused_pairs_and_unreadable_values(spark):
    writers = {"1": record(("a", "int")), "2": record(("a", "string"))}
    reader = record(("a", "long"))
    sent = spark.createDataFrame([("1", '{"a": 1}'), ("2", '{"a": "x"}'), ("9", "{}"), (None, "{}"), ("1", "not json"), ("1", None), ("1", "")], "version string, value string")
    got = [(r.version, r.a, r.refused) for r in V.decode_versions(sent, writers, reader, keep=["version"]).collect()]
    unreadable = ("1", None, [".: unreadable"])
    assert got == [("1", 1, []), ("2", None, ["a: type"]), ("9", None, [".: version"]), (None, None, [".: version"]), unreadable, unreadable, unreadable]
    assert [tuple(r)[:3] for r in V.refusals(spark, writers, reader).collect()] == [("2", "a", "type")]
    assert V.refusals(spark, {"1": writers["1"]}, reader).isEmpty()


def test_stored_versions_come_back(spark, tmp_path):
    writers = {"1": record(("a", "int")), "02": record(("a", "string"), ("b", ["null", "long"], {"default": None}))}
    V.write_versions(spark, writers, str(tmp_path))
    assert V.read_versions(spark, str(tmp_path)) == writers


def test_one_scan_for_all_versions(spark, tmp_path):
    writers = {str(v): record(("a", "int")) for v in range(5)}
    spark.createDataFrame([("1", '{"a": 1}')], "version string, value string").write.parquet(f"{tmp_path}/m")
    read = V.decode_versions(spark.read.parquet(f"{tmp_path}/m"), writers, record(("a", "long")))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def test_read_type_of_what_is_written():
    for kind in M.AVRO_NAMES.values():
        assert M.read_type(kind) is not None


def test_a_message_is_read_once(spark):
    """Not once for each field of the reader, and rule, that looks into it."""
    fields = [{"name": n, "type": "string"} for n in "abcdef"]
    writer = {"type": "record", "name": "R", "fields": fields}
    rows = spark.createDataFrame([("1", '{"a":"x","b":null}'), ("1", "none"), (None, "{}")], "version string, value string")
    read = V.decode_versions(rows, {"1": writer}, writer, keep=["version"])
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("parse_json(") <= 1
    got = [(r.a, r.b, r.refused) for r in read.collect()]
    assert got[0][:2] == ("x", None) and got[1] == (None, None, [".: unreadable"]) and got[2] == (None, None, [".: version"])


def test_kept_columns_may_have_the_names_of_steps(spark):
    writer = {"type": "record", "name": "R", "fields": [{"name": "a", "type": "string"}]}
    rows = spark.createDataFrame([("1", '{"a":"x"}', 1, 2, 3, 4, 5)], "version string, value string, _row int, _text int, _whole int, _body0 int, _version int")
    keep = ["_row", "_text", "_whole", "_body0", "_version"]
    assert V.decode_versions(rows, {"1": writer}, writer, keep=keep).first()[:] == (1, 2, 3, 4, 5, "x", [])
