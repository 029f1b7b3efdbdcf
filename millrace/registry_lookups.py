"""Queries of mapping lookups that share a pass or meet skewed keys, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import filters as P
from millrace.operators import rules as R
from millrace.operators.mapping import Table
from millrace.plans.conform import Options, conform
from millrace.registry import _orders_with_lines, query, read

_FIVE = """
SELECT l_orderkey, l_linenumber, p.p_name AS part, p.p_brand AS brand, s.s_name AS supplier, coalesce(q.p_type, 'none') AS type, t.s_nationkey AS nation,
  CAST(count(*) FILTER (WHERE p.p_partkey IS NULL) OVER o > 0 AS INT) + CAST(count(*) FILTER (WHERE s.s_suppkey IS NULL) OVER o > 0 AS INT)
  + CAST(count(*) FILTER (WHERE q.p_partkey IS NULL) OVER o > 0 AS INT) + CAST(count(*) FILTER (WHERE t.s_suppkey IS NULL) OVER o > 0 AS INT) AS kinds
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 7 <> 3) p ON l_partkey = p.p_partkey
  LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 5 <> 1) s ON l_suppkey = s.s_suppkey
  LEFT JOIN part q ON l_partkey = q.p_partkey AND q.p_size < 40
  LEFT JOIN supplier t ON l_suppkey = t.s_suppkey AND t.s_nationkey <> 3
WINDOW o AS (PARTITION BY l_orderkey)
"""


def five_rules() -> list[R.Mapping]:
    """On one array, none of which reads what another one writes."""
    part, supplier = ("p_partkey", "lines.l_partkey"), ("s_suppkey", "lines.l_suppkey")
    return [
        R.Mapping(order=1, table="some parts", keys=(part,), target="p_name", output="lines.part"),
        R.Mapping(order=2, table="some parts", keys=(part,), target="p_brand", output="lines.brand"),
        R.Mapping(order=3, table="some suppliers", keys=(supplier,), target="s_name", output="lines.supplier"),
        R.Mapping(order=4, table="parts", keys=(part,), target="p_type", output="lines.type"),
        R.Mapping(order=5, table="suppliers", keys=(supplier,), target="s_nationkey", output="lines.nation", filter=P.Differs("s_nationkey", "3", "integer")),
    ]


def five_tables(spark: SparkSession, sf_dir: str) -> dict[str, Table]:
    part, supplier = read(spark, sf_dir, "part"), read(spark, sf_dir, "supplier")
    return {"some parts": Table(part.where("p_partkey % 7 <> 3")), "some suppliers": Table(supplier.where("s_suppkey % 5 <> 1")), "parts": Table(part.where("p_size < 40"), {"*": "'none'"}), "suppliers": Table(supplier)}


def _five(spark: SparkSession, sf_dir: str, options: Options) -> DataFrame:
    out = conform(_orders_with_lines(spark, sf_dir), five_rules(), five_tables(spark, sf_dir), options)
    kinds = F.size(F.array_distinct(F.transform(F.filter("errCol", lambda e: e["errCol"] != "lines.brand"), lambda e: e["errCol"]))).alias("kinds")
    lines = out.select("l_orderkey", kinds, F.explode("lines").alias("line"))
    return lines.select("l_orderkey", *(f"line.{c}" for c in ("l_linenumber", "part", "brand", "supplier", "type", "nation")), "kinds")


@query(_FIVE)
def map_array_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rules on one array in one pass: one gathering of keys in Arrow batches, one rewriting of the array."""
    return _five(spark, sf_dir, Options(map_rows=0))


@query(_FIVE)
def map_array_shared_beyond_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with tables too large to broadcast: rows are computed and written once, and only numbers and keys are shuffled to the tables."""
    return _five(spark, sf_dir, Options(map_rows=0, broadcast_bytes=0))


@query("""
SELECT l_orderkey, l_linenumber, c.c_name AS customer, CAST(c.c_custkey IS NULL AS INT) AS n_errors
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_partkey % 4 <> 0 THEN 7 ELSE l_partkey END AS key FROM lineitem) LEFT JOIN customer c ON key = c.c_custkey
""")
def map_skewed_beyond_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table too large to broadcast and a key that half of all rows have, while a third has none: these rows aren't shuffled."""
    key = F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).when(F.col("l_partkey") % 4 != 0, 7).otherwise(F.col("l_partkey")).cast("long")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key.alias("key"))
    rule = R.Mapping(order=1, table="customer", keys=(("c_custkey", "key"),), target="c_name", output="customer")
    out = conform(lines, [rule], {"customer": Table(read(spark, sf_dir, "customer"))}, Options(broadcast_bytes=0))
    return out.select("l_orderkey", "l_linenumber", "customer", F.size("errCol").alias("n_errors"))
