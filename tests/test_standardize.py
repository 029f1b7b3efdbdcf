from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from millrace.plans.standardize import Options, standardize
from millrace.sources import copybook, layout, readers

from .conftest import rows

FIELD = T.StructField


def codes(row: dict) -> list[tuple]:
    return [(e["errCode"], e["errCol"], e["rawValues"]) for e in row["errCol"]]


def test_values_nulls_and_defaults(spark):
    schema = T.StructType([
        FIELD("name", T.StringType(), False, {"default": "ERROR"}),
        FIELD("n", T.IntegerType(), False),
        FIELD("day", T.DateType(), True, {"pattern": "dd/MM/yyyy", "sourcecolumn": "d"}),
        FIELD("gone", T.StringType()),
        FIELD("needed", T.DoubleType(), False, {"default": "3.14"}),
    ])
    df = spark.createDataFrame([("a", "12", "15/7/2019"), (None, "1.0", "nope"), ("c", None, None)], "name string, n string, d string")
    out = rows(standardize(df, schema))
    assert [(r["name"], r["n"], r["day"], r["gone"], r["needed"]) for r in out] == [("a", 12, dt.date(2019, 7, 15), None, 3.14), ("ERROR", 0, None, None, 3.14), ("c", 0, None, None, 3.14)]
    assert codes(out[0]) == [("E00002", "needed", ["null"])]
    assert codes(out[1]) == [("E00002", "name", ["null"]), ("E00000", "n", ["1.0"]), ("E00000", "d", ["nope"]), ("E00002", "needed", ["null"])]
    assert codes(out[2])[0] == ("E00002", "n", ["null"])


def test_structs_and_arrays(spark):
    kind = T.StructType([FIELD("x", T.IntegerType()), FIELD("ys", T.ArrayType(T.StructType([FIELD("z", T.LongType(), False)])))])
    df = spark.createDataFrame([(("7", [("1",), ("q",), (None,)]),), ((None, None),), (None,)], "s struct<x:string,ys:array<struct<z:string>>>")
    out = rows(standardize(df, T.StructType([FIELD("s", kind)])))
    assert out[0]["s"] == {"x": 7, "ys": [{"z": 1}, {"z": 0}, {"z": 0}]}
    assert codes(out[0]) == [("E00000", "s.ys.z", ["q"]), ("E00002", "s.ys.z", ["null"])]
    assert out[1]["errCol"] == [] and out[2]["errCol"] == [] and out[2]["s"] == {"x": None, "ys": None}


def test_shapes(spark):
    df = spark.createDataFrame([(1, ["a"])], "id int, l array<string>")
    schema = T.StructType([FIELD("id", T.ArrayType(T.StringType())), FIELD("l", T.StringType(), False)])
    out = rows(standardize(df, schema))[0]
    assert (out["id"], out["l"]) == (None, "")
    assert [e["errMsg"] for e in out["errCol"]] == ["Standardization Error - Type 'integer' cannot be cast to 'array'", "Standardization Error - Type 'array' cannot be cast to 'string'"]
    with pytest.raises(TypeError, match="Cannot standardize field 'id' from type integer into array"):
        standardize(df, schema, Options(fail_fast=True))


def test_record_ids_and_existing_errors(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    once = standardize(df, df.schema, Options(record_id="stable"))
    assert once.columns == ["id", "v", "errCol", "record_id"] and once.first().record_id == standardize(df, df.schema, Options(record_id="stable")).first().record_id
    assert len(standardize(df, df.schema, Options(record_id="uuid")).first().record_id) == 36
    wrong = spark.createDataFrame([(1, "a")], "id int, errCol string")
    with pytest.raises(TypeError):
        standardize(wrong, T.StructType([FIELD("id", T.IntegerType())]))
    bad = standardize(spark.createDataFrame([("x",)], "id string"), T.StructType([FIELD("id", T.IntegerType())]))
    again = standardize(bad, T.StructType([FIELD("id", T.StringType(), False)]))
    assert [c[0] for c in codes(rows(again)[0])] == ["E00000", "E00002"]


def test_time_zone(spark):
    df = spark.createDataFrame([("2020-01-15 00:00:00",)], "t string")
    schema = T.StructType([FIELD("t", T.TimestampType(), True, {"timezone": "CET"})])
    assert standardize(df, schema).selectExpr("cast(t as string) t").first().t == "2020-01-14 23:00:00"


def test_integral_bounds(spark):
    df = spark.createDataFrame([("127",), ("128",), ("+127",), ("007",), ("3.14",)], "b string")
    out = standardize(df, T.StructType([FIELD("b", T.ByteType())]))
    assert [r["b"] for r in rows(out)] == [127, None, 127, 7, None]


def test_csv_with_malformed_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1¡x\n2¡y¡z\n", encoding="latin-1")
    schema = T.StructType([FIELD("id", T.IntegerType()), FIELD("v", T.StringType())])
    raw, corrupt = readers.read(spark, "csv", str(tmp_path), schema, delimiter="U+00A1", charset="ISO-8859-1")
    out = {r["id"]: r for r in rows(standardize(raw.cache(), schema, Options(corrupt_column=corrupt)))}
    assert codes(out[1]) == [] and codes(out[2]) == [("E00007", None, ["2¡y¡z"])]
    with pytest.raises(Exception, match="Malformed|MALFORMED|FAILED_READ_FILE"):
        readers.read(spark, "csv", str(tmp_path), schema, delimiter="00A1", charset="ISO-8859-1", strict=True)[0].collect()


def test_json_and_xml(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1", "l": [true, false]}\n{bad\n')
    schema = T.StructType([FIELD("id", T.IntegerType()), FIELD("l", T.ArrayType(T.BooleanType()))])
    raw, corrupt = readers.read(spark, "json", str(tmp_path / "a.json"), schema)
    out = rows(standardize(raw.cache(), schema, Options(corrupt_column=corrupt)))
    assert out[0]["l"] == [True, False] and codes(out[1])[0][0] == "E00007"
    (tmp_path / "b.xml").write_text("<r><rowId>1</rowId><leg><price>7</price></leg></r>\n<r><rowId>2</rowId></r>\n")
    kind = T.StructType([FIELD("rowId", T.LongType()), FIELD("leg", T.StructType([FIELD("price", T.IntegerType())]))])
    raw, corrupt = readers.read(spark, "xml", str(tmp_path / "b.xml"), kind, row_tag="r")
    assert [(r["rowId"], r["leg"]) for r in rows(standardize(raw.cache(), kind, Options(corrupt_column=corrupt)))] == [(1, {"price": 7}), (2, {"price": None})]
    with pytest.raises(ValueError, match="row_tag"):
        readers.read(spark, "xml", str(tmp_path), kind)


def test_fixed_width(spark, tmp_path):
    (tmp_path / "a.txt").write_text("001Arya  Stark\n002      N/A  \n")
    schema = T.StructType([FIELD("id", T.LongType(), False, {"width": "3"}), FIELD("first", T.StringType(), True, {"width": "6"}), FIELD("last", T.StringType(), False, {"width": 5})])
    raw, corrupt = readers.read(spark, "fixed-width", str(tmp_path), schema, trim=True, empty_as_null=True, null_value="N/A")
    out = rows(standardize(raw, schema))
    assert corrupt is None and [(r["id"], r["first"], r["last"]) for r in out] == [(1, "Arya", "Stark"), (2, None, "")]
    assert codes(out[1]) == [("E00002", "last", ["null"])]


BOOK = """
       01  RECORD.
           05  A1   PIC X(1).
           05  A2   PIC X(5).
           05  N    PIC S9(3)V99 COMP-3.
"""


def test_copybook(spark, tmp_path):
    records = [("1", "AB", bytes([0x12, 0x34, 0x5C])), ("2", "  C", bytes([0x00, 0x12, 0x3D]))]
    (tmp_path / "r.bin").write_bytes(b"".join(a.encode("cp037") + f"{b:5}".encode("cp037") + n for a, b, n in records))
    out = rows(copybook.read(spark, str(tmp_path / "r.bin"), BOOK, trimming="left"))
    assert [(r["A1"], r["A2"], str(r["N"])) for r in out] == [("1", "AB   ", "123.45"), ("2", "C  ", "-1.23")]
    (tmp_path / "t.txt").write_text("1Abcde\n2\n")
    out = rows(copybook.read(spark, str(tmp_path / "t.txt"), "01 R. 05 A1 PIC X(1). 05 A2 PIC X(5).", encoding="ascii", is_text=True))
    assert [(r["A1"], r["A2"]) for r in out] == [("1", "Abcde"), ("2", None)]
    for wrong in ({"trimming": "some"}, {"charset": "nope"}):
        with pytest.raises(ValueError):
            copybook.read(spark, str(tmp_path / "r.bin"), BOOK, **wrong)


def test_copybook_clauses(spark, tmp_path):
    book = """
       01 R.
          05 KEY PIC 9(2).
          05 G.
             10 A PIC X(2).
             10 B PIC X(2).
          05 H REDEFINES G PIC X(4).
          05 L PIC S9(2) SIGN LEADING SEPARATE CHARACTER.
          05 T PIC S9(2) SIGN IS TRAILING SEPARATE.
          05 C PIC 9(1) OCCURS 3 TIMES.
    """
    (tmp_path / "r.txt").write_text("07abcd-12+3345x6\n08\n")
    out = rows(copybook.read(spark, str(tmp_path / "r.txt"), book, encoding="ascii", is_text=True))
    assert out[0] == {"KEY": 7, "A": "ab", "B": "cd", "H": "abcd", "L": -12, "T": None, "C": [4, 5, None], "errCol": out[0]["errCol"]}
    assert [(e["errCode"], e["errCol"], e["rawValues"]) for e in out[0]["errCol"]] == [("E00000", "T", ["+33"]), ("E00000", "C", ["x"])]
    assert out[1]["KEY"] == 8 and out[1]["C"] == [None] * 3
    (tmp_path / "s.txt").write_text("07abcd+1233-4567\n")
    assert rows(copybook.read(spark, str(tmp_path / "s.txt"), book, encoding="ascii", is_text=True))[0] == {"KEY": 7, "A": "ab", "B": "cd", "H": "abcd", "L": 12, "T": -33, "C": [4, 5, 6], "errCol": []}
    for wrong in ("05 A PIC X(1). 05 B REDEFINES Z PIC X.", "05 A VALUE 3.", "A PIC X."):
        with pytest.raises(ValueError):
            copybook.parse(wrong)


def test_paths_and_versions(spark, tmp_path):
    day = dt.date(2024, 3, 5)
    assert layout.raw_path("/d/x/", day, 2, "p") == "/d/x/p/2024/03/05/v2"
    at = layout.publish_path(str(tmp_path), day, 4)
    assert at.endswith("info_date=2024-03-05/info_version=4") and layout.next_version(spark, str(tmp_path), day) == 1
    layout.write_new(spark.range(1), at)
    assert layout.next_version(spark, str(tmp_path), day) == 5
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        layout.write_new(spark.range(1), at)
    with pytest.raises(FileNotFoundError):
        layout.mapping_table(spark, str(tmp_path), day)
    assert [readers.character(x) for x in ("U+00A1", "u00a1", "00A1", "none", ";")] == ["¡", "¡", "¡", "", ";"]
    assert readers.corrupt_name(T.StructType([FIELD("_corrupt_record", T.StringType())])) == "_corrupt_record_1"
