from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from millrace.sources import messages, schemas

FIELD = T.StructField


def test_forms():
    kind = T.StructType([FIELD("a", T.DecimalType(10, 2), False, {"pattern": "x"}), FIELD("l", T.ArrayType(T.ArrayType(T.StructType([FIELD("d", T.DateType())]))))])
    assert schemas.parse(kind.json()) == kind and schemas.from_documents(json.loads(json.dumps(schemas.to_documents(kind)))) == kind
    avro = {
        "type": "record", "name": "r",
        "fields": [
            {"name": "i", "type": ["null", "int"], "default": None}, {"name": "s", "type": "string", "default": "x"}, {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}},
            {"name": "l", "type": {"type": "array", "items": ["null", {"type": "record", "name": "q", "fields": [{"name": "p", "type": {"type": "bytes", "logicalType": "decimal", "precision": 5, "scale": 1}}]}]}},
        ],
    }
    found = schemas.parse(json.dumps(avro), "Avro")
    assert [(f.dataType.simpleString(), f.nullable) for f in found.fields] == [("int", True), ("string", False), ("timestamp", False), ("array<struct<p:decimal(5,1)>>", False)]
    assert schemas.parse("01 R. 05 A-1 PIC X(3). 05 N PIC 9(12).", "copybook").simpleString() == "struct<A_1:string,N:bigint>"
    for text, form in (("{}", "xsd"), ('{"type": "int"}', "avro"), ('{"type": "record", "name": "r", "fields": [{"name": "u", "type": ["int", "string"]}]}', "avro")):
        with pytest.raises(ValueError):
            schemas.parse(text, form)


def test_renames():
    kind = T.StructType([FIELD("a", T.StringType()), FIELD("b", T.ArrayType(T.StructType([FIELD("c", T.StringType()), FIELD("d", T.StringType(), True, {"sourcecolumn": "D"})])), True, {"sourcecolumn": "B"})])
    assert schemas.renames(kind) == {"b": "B", "b.c": "B.c", "b.d": "B.D"}


def test_error_messages(spark):
    from pyspark.sql import functions as F

    from millrace.operators import rules as R
    from millrace.plans.conform import conform
    from millrace.plans.standardize import with_record_id

    df = with_record_id(conform(spark.createDataFrame([("x",), ("1",)], "s string"), [R.Casting(order=1, input="s", to="integer", output="n")]), "stable")
    out = messages.error_records(df, "src", "set", F.lit("2024-01-02").cast("date"), F.lit("1")).collect()
    value = json.loads(out[0].value)
    assert len(out) == 1 and (value["errorCode"], value["dataset"], value["informationDate"]) == ("E00003", "set", 19724) and value["recordId"] == out[0].key
    assert (value["errorSourceId"], value["additionalInfo"]["errCol"], value["additionalInfo"]["rawValues"]) == ("conformance", "n", "x")
    assert json.loads(messages.control_record(spark, "k", {"a": 1}).first().value) == {"a": 1}
