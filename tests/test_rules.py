from __future__ import annotations

import datetime as dt
import json
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import errors
from millrace.operators import filters as P
from millrace.operators import mapping as lookups
from millrace.operators import rules as R
from millrace.operators.mapping import Table
from millrace.plans.conform import Options, conform, produced, with_info

from .conftest import rows

LEGS = [
    '{"id":1,"legs":[{"legid":100,"conditions":[{"country":"CZE","currency":"Kc"}]}]}',
    '{"id":2,"legs":[{"legid":300,"conditions":[{"country":"SWE","currency":"SWK"}]},{"legid":301,"conditions":[{"country":"SA","currency":"Dummy"}]}]}',
    '{"id":3,"legs":[{"legid":500,"conditions":[]}]}',
    '{"id":4,"legs":[]}',
    '{"id":5}',
]


@pytest.fixture(scope="module")
def trades(spark):
    schema = "id long, legs array<struct<legid:long,conditions:array<struct<country:string,currency:string>>>>"
    return spark.createDataFrame([(line,) for line in LEGS], "value string").select(F.from_json("value", schema).alias("v")).select("v.*")


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "country": Table(spark.createDataFrame([("CZE", "Czech Republic"), ("SA", "South Africa")], "code string, name string")),
        "currency": Table(spark.createDataFrame([("Kc", "CZK"), ("SWK", "SEK")], "code string, name string"), {"*": "'Unknown'"}),
    }


def country(**more):
    return R.Mapping(**{"order": 1, "table": "country", "keys": (("code", "legs.conditions.country"),), "target": "name", "output": "legs.conditions.conformed"} | more)


@pytest.mark.parametrize("options", [Options(), Options(map_rows=0), Options(map_rows=0, broadcast_bytes=0)])
def test_mapping_in_nested_arrays(trades, tables, options):
    currency = R.Mapping(order=2, table="currency", keys=(("code", "legs.conditions.currency"),), target="name", output="legs.conditions.money")
    found = {r["id"]: r for r in rows(conform(trades, [currency, country()], tables, options))}
    values = [c for leg in found[2]["legs"] for c in leg["conditions"]]
    assert [(c["conformed"], c["money"]) for c in values] == [(None, "SEK"), ("South Africa", "Unknown")]
    assert [(e["errCode"], e["errCol"], e["rawValues"]) for e in found[2]["errCol"]] == [("E00001", "legs.conditions.conformed", ["SWE"]), ("E00001", "legs.conditions.money", ["Dummy"])]
    assert found[2]["errCol"][0]["mappings"] == [{"mappingTableColumn": "code", "mappedDatasetColumn": "legs.conditions.country"}]
    assert [found[k]["errCol"] for k in (1, 3, 4, 5)] == [[], [], [], []]
    assert (found[3]["legs"][0]["conditions"], found[4]["legs"], found[5]["legs"]) == ([], [], None)


def test_array_mapping_plan_has_no_explode_shuffle_or_python(trades, tables):
    plan = conform(trades, [country()], tables)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Generate", "Python", "SortMergeJoin"))


def test_key_of_another_array_is_never_found(spark, tables):
    df = spark.createDataFrame([(1, [("CZE",)], [(1,)])], "id int, a array<struct<k:string>>, b array<struct<n:int>>")
    out = rows(conform(df, [R.Mapping(order=1, table="country", keys=(("code", "a.k"),), target="name", output="b.name")], tables))[0]
    assert out["b"] == [{"n": 1, "name": None}] and len(out["errCol"]) == 1


def test_places_of_keys():
    rnd = random.Random(4)
    kind = pa.struct([("a", pa.string()), ("b", pa.int64()), ("c", pa.date32())])

    def keys(n: int) -> list[tuple]:
        return [(rnd.choice(["x", "y", "", None]), rnd.choice([1, 2, -5, None]), rnd.choice([dt.date(2024, 1, 1), None])) for _ in range(n)]

    known = list(dict.fromkeys(keys(25)))
    wanted = keys(200)
    find = lookups._finder(pa.array([dict(zip("abc", k, strict=True)) for k in known], kind))
    assert find(pa.array([dict(zip("abc", k, strict=True)) for k in wanted], kind)).tolist() == [known.index(k) if k in known else -1 for k in wanted]
    assert find(pa.array([], kind)).tolist() == [] and lookups._finder(pa.array([], kind))(pa.array([{"a": "x", "b": 1, "c": None}], kind)).tolist() == [-1]


@pytest.mark.parametrize("options", [Options(), Options(map_rows=0), Options(map_rows=0, broadcast_bytes=0)])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookups_in_arrays_agree(spark, options, null_safe):
    """Two keys, one of them outside the array, null keys, null and empty arrays, a target that is null."""
    rnd = random.Random(3)
    data = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, [], [(rnd.choice([1, 2, 3, None]),) for _ in range(rnd.randint(1, 4))]])) for i in range(60)]
    df = spark.createDataFrame(data, "id long, g string, l array<struct<k:int>>")
    known = {("a", 1): "x", ("a", 2): None, ("b", 1): "y", (None, 3): "z", ("b", None): "w"}
    table = Table(spark.createDataFrame([(*k, v) for k, v in known.items()], "tg string, tk int, v string"))
    rule = R.Mapping(order=1, table="t", keys=(("tg", "g"), ("tk", "l.k")), target="v", output="l.v", null_safe=null_safe)
    out = {r["id"]: r for r in rows(conform(df, [rule], {"t": table}, options))}
    for i, g, l in data:
        found = [(g, k) in known and (null_safe or None not in (g, k)) for (k,) in l or []]
        assert out[i]["l"] == (None if l is None else [{"k": k, "v": known[g, k] if f else None} for (k,), f in zip(l, found, strict=True)])
        assert sorted({(e["rawValues"][0], e["rawValues"][1]) for e in out[i]["errCol"]}, key=str) == sorted({(g, None if k is None else str(k)) for (k,), f in zip(l or [], found, strict=True) if not f}, key=str)
    again = conform(df, [rule], {"t": table}, options)
    assert len(table.chosen) == 1 and again.count() == 60


def test_repeated_mapping_keys_are_refused(spark, trades):
    twice = spark.createDataFrame([("CZE", "a"), ("CZE", "b")], "code string, name string")
    with pytest.raises(R.RuleError, match="several rows"):
        conform(trades, [country()], {"country": Table(twice)})
    out = {r["id"]: r for r in rows(conform(trades, [country()], {"country": Table(twice, duplicates="largest")}))}
    assert out[1]["legs"][0]["conditions"][0]["conformed"] == "b"


def test_default_of_wrong_type_is_refused(spark, tables):
    df = spark.createDataFrame([("CZE",)], "c string")
    wrong = Table(tables["country"].rows, {"name": "array(1)"})
    with pytest.raises(R.RuleError, match="default"):
        conform(df, [R.Mapping(order=1, table="country", keys=(("code", "c"),), target="name", output="n")], {"country": wrong})


def test_null_key_matches_only_null_safe(spark):
    df = spark.createDataFrame([(None,), ("a",)], "k string")
    table = {"t": Table(spark.createDataFrame([(None, "none"), ("a", "A")], "k string, v string"))}
    for safe, expected in ((False, {None: None, "a": "A"}), (True, {None: "none", "a": "A"})):
        out = conform(df, [R.Mapping(order=1, table="t", keys=(("k", "k"),), target="v", output="v", null_safe=safe)], table)
        assert {r["k"]: r["v"] for r in rows(out)} == expected


def test_negation(spark):
    schema = T.StructType([T.StructField("b", T.ByteType(), True), T.StructField("l", T.LongType(), False), T.StructField("d", T.DoubleType()), T.StructField("x", T.DecimalType(32, 2)), T.StructField("t", T.BooleanType())])
    from decimal import Decimal

    df = spark.createDataFrame([(-128, -(1 << 63), 0.0, Decimal("1.00"), True), (5, 7, -2.5, None, None)], schema)
    out = rows(conform(df, [R.Negation(order=i, input=c, output=f"n{c}") for i, c in enumerate("bldxt")]))
    assert [out[0][f"n{c}"] for c in "bldxt"] == [None, 0, 0.0, Decimal("-1.00"), False]
    assert str(out[0]["nd"]) == "0.0"
    assert [e["errCode"] for e in out[0]["errCol"]] == ["E00004", "E00004"]
    assert [out[1][f"n{c}"] for c in "bldxt"] == [-5, -7, 2.5, None, None] and out[1]["errCol"] == []


def test_casting_reports_null_results(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,)], "s string")
    out = {r["s"]: r for r in rows(conform(df, [R.Casting(order=1, input="s", to="integer", output="n")]))}
    assert (out["7"]["n"], out["x"]["n"], out[None]["n"]) == (7, None, None)
    assert [(e["errCode"], e["rawValues"]) for e in out["x"]["errCol"]] == [("E00003", ["x"])] and out[None]["errCol"] == []
    with pytest.raises(R.RuleError, match="can't be cast"):
        conform(spark.range(1), [R.Casting(order=1, input="id", to="date", output="d")])


def test_literal_types(spark):
    out = conform(spark.range(1), [R.Literal(order=i, output=f"c{i}", text=t) for i, t in enumerate(["12", "012", "3000000000", "1.5", "TRUE", "x", "1.0E10", "NaN", "-Infinity", "1.234E-5", "1E10", "1.50E10", "10000000.0", "0.001"])])
    assert [f.dataType.simpleString() for f in out.schema.fields[2:]] == ["int", "string", "bigint", "double", "boolean", "string", "double", "double", "double", "double", "string", "string", "string", "double"]


def test_doubles_as_the_jvm_prints_them(spark):
    rnd = random.Random(1)
    values = [rnd.random() * 10 ** rnd.randint(-12, 12) for _ in range(200)] + [1e7, 9999999.0, 1e-3, 0.00099, 123456789012.0, 5e-324, 1.7976931348623157e308]
    for r in spark.createDataFrame([(v,) for v in values], "v double").selectExpr("cast(v as string) t").collect():
        assert R.double_text(r.t), r.t


def test_fill_nulls_needs_a_value_of_the_type(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, d date, s string").selectExpr("nullif(a, 1) a", "d", "s")
    out = conform(df, [R.FillNulls(order=1, input="a", text=" 7", output="x"), R.FillNulls(order=2, input="d", text="2024-01-02", output="y"), R.FillNulls(order=3, input="s", text=" q", output="z")]).first()
    assert (out.x, str(out.y), out.z) == (7, "2024-01-02", " q")
    for column, value in (("a", "abc"), ("a", "1.5x"), ("d", "soon")):
        with pytest.raises(R.RuleError, match="is not of the type"):
            conform(df, [R.FillNulls(order=1, input=column, text=value, output="x")])


def test_order_and_columns(spark):
    steps = [R.Uppercase(order=2, input="a", output="b"), R.Literal(order=1, output="a", text="x"), R.Concatenation(order=3, columns=("a", "b", "id"), output="c")]
    out = conform(spark.range(1), steps)
    assert out.columns == ["id", "errCol", "a", "b", "c"] and out.first()["c"] == "xX0"


def test_originals_are_kept_unless_allowed(spark):
    drop = [R.Drop(order=1, output="id")]
    with pytest.raises(R.RuleError, match="original column"):
        conform(spark.range(1), drop)
    with pytest.warns(UserWarning):
        assert conform(spark.range(1), drop, options=Options(allow_original_changes=True)).columns == ["errCol"]


def test_refused_rules(spark):
    df = spark.createDataFrame([(1, (2,))], "a int, s struct<x:int>")
    for rule in (R.Uppercase(order=1, input="no", output="b"), R.Uppercase(order=1, input="s", output="b"), R.Literal(order=1, output="a.b", text="x")):
        with pytest.raises(R.RuleError):
            conform(df, [rule])


def test_many_fused_rules_plan_quickly(spark):
    df = spark.createDataFrame([(1, ((2,),))], "a int, s struct<t:struct<x:int>>")
    times = []
    for n in (10, 50):
        began = time.time()
        conform(df, [R.Literal(order=i, output=f"s.t.c{i}", text="v") for i in range(n)])._jdf.queryExecution().executedPlan()
        times.append(time.time() - began)
    assert times[1] < 10 * times[0] + 5


def test_chains_in_structs(spark):
    """Rules on each other's outputs below structs: values, errors, null structs, order of fields, and plans that grow with the number of rules."""
    df = spark.createDataFrame([(1, (("7",), 1)), (2, (("x",), 2)), (3, (None, 3)), (4, None)], "id int, s struct<t:struct<a:string>,n:int>")
    steps = [
        R.Casting(order=1, input="s.t.a", to="integer", output="s.t.b"), R.Casting(order=2, input="S.t.B", to="string", output="s.t.c"), R.Concatenation(order=3, columns=("s.t.a", "s.t.c"), output="s.t.d"),
        R.Uppercase(order=4, input="s.t.d", output="top"), R.Literal(order=5, output="s.u.v", text="w"), R.Literal(order=6, output="s.t.e", text="1", checkpoint=True), R.Drop(order=7, output="s.t.c"), R.Uppercase(order=8, input="s.u.v", output="s.t.f"),
    ]
    out = conform(df, steps)
    assert out.columns == ["id", "s", "errCol", "top"] and out.schema["s"].dataType.simpleString() == "struct<t:struct<a:string,b:int,d:string,e:int,f:string>,n:int,u:struct<v:string>>"
    found = {r["id"]: r for r in rows(out)}
    assert found[1]["s"] == {"t": {"a": "7", "b": 7, "d": "77", "e": 1, "f": "W"}, "n": 1, "u": {"v": "w"}} and found[1]["top"] == "77" and found[1]["errCol"] == []
    assert found[2]["s"]["t"] == {"a": "x", "b": None, "d": None, "e": 1, "f": "W"} and [(e["errCode"], e["errCol"], e["rawValues"]) for e in found[2]["errCol"]] == [("E00003", "s.t.b", ["x"])]
    assert found[3]["s"] == {"t": None, "n": 3, "u": {"v": "w"}} and found[3]["errCol"] == [] and found[4]["s"] is None and found[4]["errCol"] == []
    seen = []
    again = rows(conform(df, steps, options=Options(on_checkpoint=lambda name, df: seen.append(df.schema["s"].dataType["t"].dataType.names))))
    assert {r["id"]: r for r in again} == found and seen == [["a", "b", "c", "d"], ["a", "b", "c", "d", "e"]]
    with pytest.raises(R.RuleError, match="already exists"):
        conform(df, [*steps[:1], R.Literal(order=9, output="s.t.B", text="1")])
    with pytest.warns(UserWarning):
        changed = conform(df, [R.Casting(order=1, input="s.t.a", to="integer", output="s.t.a"), R.Negation(order=2, input="s.t.a", output="s.m")], options=Options(allow_original_changes=True))
    assert [(r["s"] or {}).get("m") for r in rows(changed)] == [-7, None, None, None] and changed.schema["s"].dataType["t"].dataType["a"].dataType.simpleString() == "int"


def test_long_chains_in_structs_plan_quickly(spark):
    df = spark.createDataFrame([(("x0",),)], "s struct<c0:string>").selectExpr("struct(struct(s.c0 AS c0) AS t) AS s")
    began = time.time()
    out = conform(df, [R.Uppercase(order=i, input=f"s.t.c{i - 1}", output=f"s.t.c{i}") for i in range(1, 41)])
    assert out.first().s.t.c40 == "X0" and time.time() - began < 30


def test_smallest_number_in_a_struct_that_is_always_there(spark):
    kind = T.StructType([T.StructField("s", T.StructType([T.StructField("n", T.IntegerType(), False)]), False)])
    df = spark.createDataFrame([((-(1 << 31),),), ((5,),)], kind)
    out = conform(df, [R.Negation(order=1, input="s.n", output="s.m"), R.Negation(order=2, input="s.m", output="s.k")])
    assert [(r["s"]["m"], r["s"]["k"], len(r["errCol"])) for r in rows(out)] == [(0, 0, 1), (-5, 5, 0)]


def test_json_round_trip():
    chosen = (P.Equals("a", "1", "integer") | ~P.IsNull("b")) & P.Differs("c", "x")
    steps = [
        country(filter=chosen, additional=(("o2", "t2"),), null_safe=True), R.Literal(order=2, output="l", text="x"), R.Casting(order=3, input="l", to="integer", output="i"), R.Drop(order=4, output="l"),
        R.Concatenation(order=5, columns=("a", "b"), output="c"), R.SingleColumn(order=6, input="a", alias="x", output="y"), R.SessionConf(order=7, key="k", output="z"), R.FillNulls(order=8, input="a", text="0", output="f"),
    ]
    assert [R.from_json(json.loads(json.dumps(R.to_json(s)))) for s in steps] == steps


def test_filters(spark):
    a, b = P.Equals("x", "1", "int"), P.IsNull("y")
    assert ~~a == a and (a & b & a) == P.All((a, b)) and P.All(()).condition() is not None
    df = spark.createDataFrame([(1, None), (2, "q"), (None, None)], "x int, y string")
    assert df.where((a | b).condition()).count() == 2 and df.where(P.Differs("x", "1", "int").condition()).count() == 1
    assert P.type_name("decimal(10, 2)") == "decimal(10, 2)"
    with pytest.raises(ValueError):
        P.type_name("colour")


def test_info_columns(spark):
    df = errors.with_errors(spark.createDataFrame([(1, "2"), (2, None)], "id int, INFO_VERSION string"))
    out = {r["id"]: r for r in rows(with_info(df, F.lit("2024-01-02").cast("date"), F.lit("3")))}
    assert out[1]["INFO_VERSION"] == "3" and [e["errCode"] for e in out[1]["errCol"]] == ["E00005"] and out[2]["errCol"] == []
    assert out[1]["info_date_string"] == "2024-01-02"


def test_produced():
    schema = T.StructType([T.StructField("a", T.StringType())])
    steps = [R.Literal(order=1, output="b", text="x"), R.Drop(order=2, output="b"), R.Uppercase(order=3, input="a", output="c")]
    assert [produced(schema, steps, p) for p in ("a", "b", "C", "d")] == [True, False, True, False]


def test_checkpoints_around_rules(spark):
    seen = []
    steps = [R.Literal(order=1, output="a", text="x", checkpoint=True), R.Literal(order=2, output="b", text="y")]
    conform(spark.range(3), steps, options=Options(on_checkpoint=lambda name, df: seen.append((name, df.count(), "a" in df.columns))))
    assert [s[1:] for s in seen] == [(3, False), (3, True)]
