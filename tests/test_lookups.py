"""Plans and task sizes of mapping lookups in arrays and of skewed joins."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import mapping as lookups
from millrace.operators import rules as R
from millrace.operators.mapping import Table
from millrace.plans.conform import Options, conform
from millrace.registry import _orders_with_lines
from millrace.registry_lookups import five_rules, five_tables

from .conftest import rows

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_on_one_array_share_a_pass(spark):
    orders, tables = _orders_with_lines(spark, SMALL), five_tables(spark, SMALL)
    shared = plan(conform(orders, five_rules(), tables, Options(map_rows=0)))
    assert shared.count("ArrowEvalPython") == 1 and "Generate" not in shared
    assert "Python" not in plan(conform(orders, five_rules(), tables, Options(map_rows=10_000)))
    far = plan(conform(orders, five_rules(), tables, Options(map_rows=0, broadcast_bytes=0)))
    assert "lineitem" not in far and "__keys" not in far.split("hashpartitioning(")[1].split(")")[0]


@pytest.mark.parametrize("options", [Options(), Options(map_rows=0), Options(map_rows=0, broadcast_bytes=0)])
def test_shared_passes_give_what_single_ones_give(spark, options):
    orders, tables = _orders_with_lines(spark, SMALL).where("l_orderkey % 5 = 0"), five_tables(spark, SMALL)
    again = R.Mapping(order=6, table="names", keys=(("name", "lines.supplier"),), target="loud", output="lines.loud")
    tables["names"] = Table(tables["some suppliers"].rows.select(F.col("s_name").alias("name"), F.upper("s_name").alias("loud")))
    every = [*five_rules(), again]
    found = sorted(map(repr, rows(conform(orders, every, tables, options))))
    one = orders
    for rule in every:
        one = conform(one, [rule], tables, Options(map_rows=10_000))
    assert found == sorted(map(repr, rows(one)))
    assert lookups.together(conform(orders, five_rules()[:3], tables).schema, [], again)
    assert not lookups.together(orders.schema, [lookups.Lookup(r, tables[r.table]) for r in five_rules()], again)


def test_void_columns_and_errors_pass_through_written_rows(spark):
    df = spark.createDataFrame([(1, [(1,), (9,)]), (2, None), (3, [])], "id long, a array<struct<k: long>>").withColumn("nothing", F.lit(None))
    rule = R.Mapping(order=1, table="t", keys=(("k", "a.k"),), target="v", output="a.v")
    table = {"t": Table(spark.createDataFrame([(1, "one")], "k long, v string"))}
    far, near = (conform(df, [rule], table, o) for o in (Options(map_rows=0, broadcast_bytes=0), Options()))
    assert far.columns == near.columns and far.schema["errCol"].nullable == near.schema["errCol"].nullable
    assert sorted(map(repr, rows(far))) == sorted(map(repr, rows(near)))


def test_skewed_joins_give_what_plain_ones_give(spark):
    rng = random.Random(6)
    data = [(i, None if rng.random() < 0.3 else 5 if rng.random() < 0.6 else rng.randrange(900), rng.choice(["x", None, "y"])) for i in range(6000)]
    left = spark.createDataFrame(data, "id long, a int, b string").repartition(4)
    right = spark.createDataFrame([(k, s, f"{k}{s}") for k in range(0, 900, 2) for s in ("x", "y")] + [(5, "x", "hot"), (5, None, "null"), (None, None, "both")], "ka int, kb string, v string")
    for null_safe in (False, True):
        keys, names = [F.col("a"), F.col("b")], ["ka", "kb"]
        found = lookups.spread_join(left, right, keys, names, "v", null_safe)
        plain = left.join(right, lookups._matching(keys, names, null_safe), "left")
        assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect())) and found.columns == plain.columns
        assert "Union" in plan(found)
    even = spark.range(5000).withColumn("a", F.col("id").cast("int"))
    assert "Union" not in plan(lookups.spread_join(even, right.select("ka", "v").where("kb = 'x'"), [F.col("a")], ["ka"], "v"))


def test_no_task_has_many_more_rows_than_others(spark):
    """Half of the rows have one key, a third has none."""
    left = spark.range(0, 60_000, 1, 8).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 4 < 3, 7).otherwise(F.col("id")).alias("k"))
    right = spark.range(30_000).select(F.col("id").alias("rk"), F.col("id").cast("string").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = lookups.spread_join(left, right, [F.col("k")], ["rk"], "v")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 60_000 and len(sizes) >= 12 and max(sizes) <= 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_skewed_joins_of_no_rows_and_of_nulls_alone(spark):
    right = spark.createDataFrame([(1, "x")], "rk int, v string")
    for rows in ([], [(None,)] * 5, [(1,)] * 5, [(2,)]):
        left = spark.createDataFrame(rows, "k int")
        found = lookups.spread_join(left, right, [F.col("k")], ["rk"], "v")
        assert sorted(map(repr, found.collect())) == sorted(map(repr, left.join(right, F.col("k") == F.col("rk"), "left").collect()))
    rule = R.Mapping(order=1, table="t", keys=(("rk", "k"),), target="v", output="v")
    none = conform(spark.createDataFrame([], "k int"), [rule], {"t": Table(right)}, Options(broadcast_bytes=0))
    assert none.count() == 0 and none.columns == ["k", "errCol", "v"]


def test_outputs_below_a_struct_that_isnt_there(spark):
    df = spark.createDataFrame([(1, [(1,), (2,), None]), (2, None)], "id long, a array<struct<k: long>>")
    table = {"t": Table(spark.createDataFrame([(1, "one", 10)], "k long, v string, n int"))}
    rules = [R.Mapping(order=i, table="t", keys=(("k", "a.k"),), target=t, output=f"a.new.{t}") for i, t in enumerate(("v", "n"))]
    for options in (Options(), Options(map_rows=0), Options(map_rows=0, broadcast_bytes=0)):
        found = {r["id"]: r for r in rows(conform(df, rules, table, options))}
        assert [x["new"] for x in found[1]["a"][:2]] == [{"v": "one", "n": 10}, {"v": None, "n": None}] and found[2]["a"] is None and found[2]["errCol"] == []
        assert [e["errCol"] for e in found[1]["errCol"]] == ["a.new.v", "a.new.n"] or len(found[1]["errCol"]) == 4
