"""Avro values against the specification's examples and the library that Spark brings along in the JVM."""

from __future__ import annotations

import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import avro, messages, schemas


def put(schema, value) -> bytes:
    out = bytearray()
    avro.writer(avro.Schema(schema))(out, value)
    return bytes(out)


def get(data, wrote, wanted=None):
    return avro.resolver(avro.Schema(wrote), avro.Schema(wanted if wanted is not None else wrote))(data, 0)[0]


def test_examples_of_the_specification():
    for value, data in ((0, "00"), (-1, "01"), (1, "02"), (-2, "03"), (2, "04"), (-64, "7f"), (64, "8001"), (-(1 << 63), "ffffffffffffffffff01")):
        assert put("long", value).hex() == data and get(bytes.fromhex(data), "long") == value
    assert put("string", "foo").hex() == "06666f6f"
    record = {"type": "record", "name": "test", "fields": [{"name": "a", "type": "long"}, {"name": "b", "type": "string"}]}
    assert put(record, {"a": 27, "b": "foo"}).hex() == "3606666f6f"
    assert put({"type": "array", "items": "long"}, [3, 27]).hex() == "04063600"
    assert put(["null", "string"], None).hex() == "00" and put(["null", "string"], "a").hex() == "020261"
    assert get(bytes.fromhex("0304063600"), {"type": "array", "items": "long"}) == [3, 27]  # a block with its bytes


SCHEMA = {
    "type": "record", "name": "Order", "namespace": "shop",
    "fields": [
        {"name": "id", "type": "long"},
        {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": ["NEW", "OLD"]}},
        {"name": "key", "type": {"type": "fixed", "name": "Key", "size": 4}},
        {"name": "home", "type": {"type": "record", "name": "Place", "fields": [{"name": "town", "type": ["null", "string"], "default": None}, {"name": "x", "type": "double"}]}},
        {"name": "away", "type": ["null", "Place"], "default": None},
        {"name": "kinds", "type": {"type": "array", "items": "shop.Kind"}},
        {"name": "more", "type": {"type": "map", "values": ["null", "float"]}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        {"name": "flag", "type": "boolean"},
    ],
}


def _orders(n):
    rng = random.Random(4)
    place = lambda: {"town": rng.choice([None, "Brno", "Řím"]), "x": rng.random()}
    return [
        {"id": rng.randrange(-(1 << 63), 1 << 63), "kind": rng.choice(["NEW", "OLD"]), "key": rng.randbytes(4), "home": place(), "away": rng.choice([None, place()]), "kinds": [rng.choice(["NEW", "OLD"]) for _ in range(rng.randrange(4))],
         "more": {c: rng.choice([None, 0.5, -2.0]) for c in "abc"[: rng.randrange(4)]}, "day": dt.date(1960, 1, 1) + dt.timedelta(rng.randrange(40_000)), "at": dt.datetime(1950, 1, 1) + dt.timedelta(milliseconds=rng.randrange(1 << 42)),
         "price": Decimal(rng.randrange(-(10**9) + 1, 10**9)).scaleb(-2), "flag": rng.random() < 0.5}
        for _ in range(n)
    ]


def test_columns_round_trip_and_match_the_jvm(spark):
    kind = schemas.from_avro(SCHEMA)
    assert kind["away"].dataType == kind["home"].dataType and kind["away"].nullable and kind["kinds"].dataType == T.ArrayType(T.StringType(), False)
    df = spark.createDataFrame([(o,) for o in _orders(60)] + [(None,)], T.StructType([T.StructField("o", kind)]))
    coded = df.select("o", avro.encode(F.col("o"), SCHEMA).alias("data"), avro.encode(F.col("o"), SCHEMA, 513).alias("framed")).cache()
    back = coded.select("o", avro.decode(F.col("data"), SCHEMA).alias("a"), avro.decode(F.col("framed"), json.dumps(SCHEMA), framed=True).alias("b"))
    assert all(r.o == r.a == r.b for r in back.collect())
    jvm = spark._jvm.org.apache.avro
    schema = getattr(jvm.Schema, "Parser")().parse(json.dumps(SCHEMA))
    reader = jvm.generic.GenericDatumReader(schema)
    for r in coded.where("o IS NOT NULL").collect():
        assert r.framed == b"\0\0\0\2\1" + r.data
        theirs = reader.read(None, jvm.io.DecoderFactory.get().binaryDecoder(bytes(r.data), None))
        assert (theirs.get("id"), str(theirs.get("kind")), theirs.get("flag")) == (r.o.id, r.o.kind, r.o.flag)
        assert theirs.get("day") == (r.o.day - dt.date(1970, 1, 1)).days and theirs.get("home").get("x") == r.o.home.x
        assert (theirs.get("away") is None) == (r.o.away is None) and theirs.get("kinds").size() == len(r.o.kinds)


def test_schemas_that_meet():
    wrote = {"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}, {"name": "gone", "type": {"type": "map", "values": "string"}}, {"name": "old", "type": "string"}, {"name": "u", "type": ["null", "int"]}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Y"]}}]}
    wanted = {"type": "record", "name": "S", "aliases": ["R"], "fields": [
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Z"], "default": "Z"}}, {"name": "new", "type": "bytes", "aliases": ["old"]}, {"name": "a", "type": ["null", "double"]},
        {"name": "u", "type": ["null", "long"]}, {"name": "l", "type": {"type": "array", "items": "int"}, "default": [1, 2]}, {"name": "n", "type": ["string", "null"], "default": "x"},
    ]}
    data = put(wrote, {"a": 5, "gone": {"k": "v"}, "old": "ř", "u": None, "e": "Y"})
    assert get(data, wrote, wanted) == {"e": "Z", "new": "ř".encode(), "a": 5.0, "u": None, "l": [1, 2], "n": "x"}
    assert avro.problems(wrote, wanted) == [] and avro.problems("int", ["null", "long"]) == []
    for one, other, said in (
        ("long", "int", "long can't be read as int"),
        (["null", "int"], "int", "null can't be read"),
        ({"type": "record", "name": "A", "fields": []}, {"type": "record", "name": "B", "fields": []}, "A can't be read as B"),
        ({"type": "record", "name": "A", "fields": []}, {"type": "record", "name": "A", "fields": [{"name": "x", "type": "int"}]}, "x wasn't written"),
        ({"type": "enum", "name": "E", "symbols": ["A"]}, {"type": "enum", "name": "E", "symbols": ["B"]}, "A is no symbol"),
        ({"type": "fixed", "name": "F", "size": 2}, {"type": "fixed", "name": "F", "size": 3}, "2 bytes"),
        ("int", ["string", "boolean"], "no branch"),
    ):
        assert said in avro.problems(one, other)[0]


def test_schemas_that_are_refused(spark):
    with pytest.raises(avro.AvroError, match="unknown"):
        avro.Schema({"type": "record", "name": "R", "fields": [{"name": "a", "type": "Nowhere"}]})
    with pytest.raises(avro.AvroError, match="holds itself"):
        schemas.from_avro({"type": "record", "name": "R", "fields": [{"name": "a", "type": ["null", "R"]}]})
    with pytest.raises(avro.AvroError, match="twice"):
        avro.Schema([{"type": "fixed", "name": "F", "size": 1}, {"type": "fixed", "name": "F", "size": 2}])
    with pytest.raises(avro.AvroError, match="value.a is null"):
        put({"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}, {"a": None})
    with pytest.raises(avro.AvroError, match="can't be read"):
        avro.decode(F.lit(b""), "string", "int")


def test_control_information(spark):
    schema = {"type": "record", "name": "info", "fields": [{"name": "metadata", "type": {"type": "record", "name": "metadata", "fields": [{"name": "country", "type": "string"}]}}, {"name": "checkpoints", "type": {"type": "array", "items": {"type": "record", "name": "point", "fields": [{"name": "name", "type": "string"}, {"name": "order", "type": "int"}]}}}]}
    told = {"metadata": {"country": "CZ", "other": 1}, "checkpoints": [{"name": "Raw", "order": 1, "controls": []}]}
    sent = messages.in_avro(messages.control_values(spark, "k", told, schema), schema).collect()
    assert get(bytes(sent[0].value), schema) == {"metadata": {"country": "CZ"}, "checkpoints": [{"name": "Raw", "order": 1}]}
