"""Queries that show each operator on the benchmark tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import arrays, errors
from millrace.operators import filters as P
from millrace.operators import rules as R
from millrace.operators.mapping import Table
from millrace.plans import measures, runs
from millrace.plans.conform import Options, conform, overwrite, with_info
from millrace.plans.standardize import Options as StdOptions
from millrace.plans.standardize import standardize
from millrace.session import prepare, shared_path
from millrace.streaming.conformed import Settings, conformed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_error() -> list:
    """Number of errors and the code, column and first raw value of the first one."""
    e = F.try_element_at(errors.ERRORS, F.lit(1))
    return [F.size(errors.ERRORS).alias("n_errors"), e["errCode"].alias("err_code"), e["errCol"].alias("err_col"), F.try_element_at(e["rawValues"], F.lit(1)).alias("raw")]


@query("""
SELECT o_orderkey, o_custkey, c.c_mktsegment AS segment, CASE WHEN c.c_custkey IS NULL THEN 1 ELSE 0 END AS n_errors,
  CASE WHEN c.c_custkey IS NULL THEN 'E00001' END AS err_code, CASE WHEN c.c_custkey IS NULL THEN 'segment' END AS err_col,
  CASE WHEN c.c_custkey IS NULL THEN CAST(o_custkey AS VARCHAR) END AS raw
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 12) c ON o_custkey = c.c_custkey
""")
def map_customer_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equi mapping join; unmatched rows get null and an error."""
    table = Table(read(spark, sf_dir, "customer").where("c_nationkey < 12"))
    rule = R.Mapping(order=1, table="customer", keys=(("c_custkey", "o_custkey"),), target="c_mktsegment", output="segment")
    return conform(read(spark, sf_dir, "orders"), [rule], {"customer": table}).select("o_orderkey", "o_custkey", "segment", *first_error())


@query("""
SELECT s_suppkey, coalesce(n.n_name, 'Unknown') AS nation, CASE WHEN n.n_nationkey IS NULL THEN 1 ELSE 0 END AS n_errors
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON s_nationkey = n.n_nationkey
""")
def map_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A default for unmatched rows, which are reported all the same."""
    table = Table(read(spark, sf_dir, "nation"), {"n_name": "'Unknown'"})
    rule = R.Mapping(order=1, table="nation", keys=(("n_nationkey", "s_nationkey"),), target="n_name", output="nation", filter=P.Differs("n_regionkey", "2", "integer"))
    return conform(read(spark, sf_dir, "supplier"), [rule], {"nation": table}).select("s_suppkey", "nation", F.size("errCol").alias("n_errors"))


@query("""
SELECT c_custkey, n.label AS label, CASE WHEN n.label IS NULL THEN 1 ELSE 0 END AS n_errors
FROM (SELECT c_custkey, nullif(c_nationkey, 7) AS k FROM customer) LEFT JOIN (SELECT nullif(n_nationkey, 7) AS nk, n_name AS label FROM nation WHERE n_nationkey <> 3) n ON k IS NOT DISTINCT FROM nk
""")
def map_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key meets a null key."""
    table = Table(read(spark, sf_dir, "nation").where("n_nationkey <> 3").select(F.expr("nullif(n_nationkey, 7)").alias("nk"), F.col("n_name").alias("label")))
    df = read(spark, sf_dir, "customer").select("c_custkey", F.expr("nullif(c_nationkey, 7)").alias("k"))
    rule = R.Mapping(order=1, table="nation", keys=(("nk", "k"),), target="label", output="label", null_safe=True)
    return conform(df, [rule], {"nation": table}).select("c_custkey", "label", F.size("errCol").alias("n_errors"))


@query("""
SELECT n_nationkey, r.r_name AS region, CAST(r.r_regionkey AS VARCHAR) AS region_key, CASE WHEN r.r_regionkey IS NULL THEN 'region_key,region' END AS err_col
FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 4) r ON n_regionkey = r.r_regionkey
""")
def map_multi_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several outputs of one lookup share one error."""
    rule = R.Mapping(order=1, table="region", keys=(("r_regionkey", "n_regionkey"),), target="r_name", output="region", additional=(("region_key", "r_regionkey"),))
    out = conform(read(spark, sf_dir, "nation"), [rule], {"region": Table(read(spark, sf_dir, "region").where("r_regionkey < 4"))})
    return out.select("n_nationkey", "region", F.col("region_key").cast("string").alias("region_key"), F.try_element_at("errCol", F.lit(1))["errCol"].alias("err_col"))


@query("""
SELECT o_orderkey, r_name AS everywhere FROM orders CROSS JOIN (SELECT r_name FROM region WHERE r_regionkey = 1)
""")
def map_without_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup without keys gives the table's one row to all."""
    rule = R.Mapping(order=1, table="region", target="r_name", output="everywhere")
    out = conform(read(spark, sf_dir, "orders"), [rule], {"region": Table(read(spark, sf_dir, "region").where("r_regionkey = 1"))})
    return out.select("o_orderkey", "everywhere")


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))


_MAPPED_LINES = """
SELECT l_orderkey, l_linenumber, s.s_name AS supplier,
  CAST(count(*) FILTER (WHERE s.s_suppkey IS NULL) OVER (PARTITION BY l_orderkey) > 0 AS BOOLEAN) AS failed
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 5 <> 1) s ON l_suppkey = s.s_suppkey
"""


def _mapped_lines(spark: SparkSession, sf_dir: str, options: Options | None) -> DataFrame:
    table = Table(read(spark, sf_dir, "supplier").where("s_suppkey % 5 <> 1"))
    rule = R.Mapping(order=1, table="supplier", keys=(("s_suppkey", "lines.l_suppkey"),), target="s_name", output="lines.supplier")
    out = conform(_orders_with_lines(spark, sf_dir), [rule], {"supplier": table}, options)
    return out.select("l_orderkey", (F.size("errCol") > 0).alias("failed"), F.inline("lines")).select("l_orderkey", "l_linenumber", "supplier", "failed")


@query(_MAPPED_LINES)
def map_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key within an array, found without exploding it."""
    return _mapped_lines(spark, sf_dir, None)


@query(_MAPPED_LINES)
def map_array_large_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a table that is too large to travel with every row: each row gets the entries of its own keys."""
    return _mapped_lines(spark, sf_dir, Options(map_rows=0))


@query(_MAPPED_LINES)
def map_array_beyond_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a table that is too large to broadcast: sets of keys are joined to it."""
    return _mapped_lines(spark, sf_dir, Options(map_rows=0, broadcast_bytes=0))


@query("""
SELECT s_suppkey, n.n_name AS s_name_2, CASE WHEN n.n_nationkey IS NULL THEN 1 ELSE 0 END AS n_errors
FROM supplier LEFT JOIN nation n ON s_nationkey = n.n_nationkey AND n.n_regionkey = 1 AND n.n_name <> 'NATION_3'
""")
def map_own_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's own filter and the rule's hold together."""
    table = Table(read(spark, sf_dir, "nation"), own_filter=P.Equals("n_regionkey", "1", "integer"))
    rule = R.Mapping(order=1, table="nation", keys=(("n_nationkey", "s_nationkey"),), target="n_name", output="s_name_2", filter=P.Differs("n_name", "NATION_3"))
    return conform(read(spark, sf_dir, "supplier"), [rule], {"nation": table}).select("s_suppkey", "s_name_2", F.size("errCol").alias("n_errors"))


@query("SELECT c_custkey, 42 AS a_int, CAST(3000000000 AS BIGINT) AS a_long, CAST(2.5 AS DOUBLE) AS a_double, true AS a_bool, 'x1' AS a_text FROM customer")
def rule_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = {"a_int": "42", "a_long": "3000000000", "a_double": "2.5", "a_bool": "true", "a_text": "x1"}
    rules = [R.Literal(order=i, output=o, text=t) for i, (o, t) in enumerate(texts.items())]
    return conform(read(spark, sf_dir, "customer"), rules).select("c_custkey", *texts)


@query("SELECT p_partkey, upper(p_name) AS loud FROM part")
def rule_uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(read(spark, sf_dir, "part"), [R.Uppercase(order=1, input="p_name", output="loud")]).select("p_partkey", "loud")


@query("SELECT p_partkey, p_brand || p_type || CAST(nullif(p_size, 7) AS VARCHAR) AS joined FROM part")
def rule_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumn("size", F.expr("nullif(p_size, 7)"))
    return conform(df, [R.Concatenation(order=1, columns=("p_brand", "p_type", "size"), output="joined")]).select("p_partkey", "joined")


@query("""
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, TRY_CAST(o_orderpriority AS INTEGER) AS whole,
  CASE WHEN o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL THEN 1 ELSE 0 END + CASE WHEN TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) IS NULL THEN 1 ELSE 0 END AS n_errors
FROM orders
""")
def rule_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "orders").withColumn("first", F.substring("o_orderpriority", 1, 1))
    rules = [R.Casting(order=1, input="first", to="integer", output="level"), R.Casting(order=2, input="o_orderpriority", to="integer", output="whole")]
    return conform(df, rules).select("o_orderkey", "level", "whole", F.size("errCol").alias("n_errors"))


@query("SELECT c_custkey, 0 - c_acctbal AS owed, NOT (c_acctbal > 0) AS broke FROM customer")
def rule_negate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "customer").withColumn("rich", F.col("c_acctbal") > 0)
    rules = [R.Negation(order=1, input="c_acctbal", output="owed"), R.Negation(order=2, input="rich", output="broke")]
    return conform(df, rules).select("c_custkey", "owed", "broke")


@query("SELECT n_nationkey, n_name AS inner_name FROM nation")
def rule_single_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = conform(read(spark, sf_dir, "nation"), [R.SingleColumn(order=1, input="n_name", alias="name", output="boxed")])
    return out.select("n_nationkey", F.col("boxed.name").alias("inner_name"))


@query("SELECT n_nationkey, 'UTC' AS zone, CAST(NULL AS VARCHAR) AS unset FROM nation")
def rule_session_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [R.SessionConf(order=1, key="spark.sql.session.timeZone", output="zone"), R.SessionConf(order=2, key="millrace.not.set", output="unset")]
    return conform(read(spark, sf_dir, "nation"), rules).select("n_nationkey", "zone", "unset")


@query("SELECT p_partkey, coalesce(nullif(p_size, 7), 99) AS size FROM part")
def rule_fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumn("maybe", F.expr("nullif(p_size, 7)"))
    return conform(df, [R.FillNulls(order=1, input="maybe", text="99", output="size")]).select("p_partkey", "size")


@query("SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#1'), p_type) AS best FROM part")
def rule_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumn("brand", F.expr("nullif(p_brand, 'Brand#1')"))
    return conform(df, [R.Coalesce(order=1, columns=("brand", "p_type"), output="best")]).select("p_partkey", "best")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem")
def rule_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops a field within an array."""
    out = conform(_orders_with_lines(spark, sf_dir), [R.Drop(order=1, output="lines.l_quantity"), R.Drop(order=2, output="no.such")], options=Options(allow_original_changes=True))
    return out.select("l_orderkey", F.inline("lines"))


@query("SELECT c_custkey, upper(c_name) || '!' AS cry FROM customer")
def rule_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule of the caller's own between others."""
    rules = [R.Uppercase(order=1, input="c_name", output="loud"), R.Custom(order=2, output="cry", change=lambda df: df.withColumn("cry", F.concat("loud", F.lit("!"))))]
    return conform(read(spark, sf_dir, "customer"), rules).select("c_custkey", "cry")


@query("""
SELECT l_orderkey, l_linenumber, TRY_CAST(CAST(l_suppkey AS VARCHAR) AS INTEGER) AS supp, upper('sup' || CAST(l_suppkey AS VARCHAR)) AS tag FROM lineitem
""")
def rules_in_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casting, concatenation and upper case on fields of array elements."""
    rules = [R.Literal(order=1, output="lines.sup", text="sup"), R.Concatenation(order=2, columns=("lines.sup", "lines.l_suppkey"), output="lines.low"), R.Uppercase(order=3, input="lines.low", output="lines.tag"), R.Casting(order=4, input="lines.l_suppkey", to="integer", output="lines.supp")]
    out = conform(_orders_with_lines(spark, sf_dir), rules)
    return out.select("l_orderkey", F.inline("lines")).select("l_orderkey", "l_linenumber", "supp", "tag")


@query("SELECT p_partkey FROM part WHERE (p_size = 7 OR p_brand = 'Brand#2') AND NOT (p_type IS NULL) AND p_name <> 'x'")
def filter_and_or_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = (P.Equals("p_size", "7", "integer") | P.Equals("p_brand", "Brand#2")) & ~P.IsNull("p_type") & P.Differs("p_name", "x")
    return read(spark, sf_dir, "part").where(P.from_json(chosen.to_json()).condition()).select("p_partkey")


_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("number", T.IntegerType(), False, {"sourcecolumn": "props", "default": "-1"}),
    T.StructField("amount", T.DoubleType(), True, {"sourcecolumn": "value"}),
    T.StructField("kind", T.StringType(), False, {"sourcecolumn": "event_type"}),
    T.StructField("missing", T.DateType(), True),
])


@query("""
SELECT event_id, coalesce(TRY_CAST(nullif(event_type, 'click') AS INTEGER), -1) AS number, value AS amount, coalesce(nullif(event_type, 'click'), '') AS kind, CAST(NULL AS VARCHAR) AS missing,
  CASE WHEN event_type = 'click' THEN 'E00002' ELSE 'E00000' END AS err_code, CASE WHEN event_type = 'click' THEN 'null' ELSE event_type END AS raw
FROM events
""")
def std_cast_nonnull_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardization: renames, casts, defaults of what may not be null, a missing column."""
    kind = F.expr("nullif(event_type, 'click')")
    raw = read(spark, sf_dir, "events").select("event_id", kind.alias("props"), F.col("value").cast("string").alias("value"), kind.alias("event_type"))
    out = standardize(raw, _EVENTS)
    e = F.element_at("errCol", 1)
    return out.select("event_id", "number", "amount", "kind", F.col("missing").cast("string").alias("missing"), e["errCode"].alias("err_code"), F.element_at(e["rawValues"], 1).alias("raw"))


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(date_trunc('second', o_orderdate) AS VARCHAR) AS moment, CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS n_errors
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS o_orderdate FROM orders)
""")
def std_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and timestamps by pattern."""
    bad = F.col("o_orderkey") % 10 == 0
    raw = read(spark, sf_dir, "orders").select("o_orderkey", F.when(bad, "31 of May").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day"), F.when(~bad, F.date_format("o_orderdate", "yyyyMMdd HH:mm:ss")).alias("moment"))
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("day", T.DateType(), True, {"pattern": "dd/MM/yyyy"}), T.StructField("moment", T.TimestampType(), True, {"pattern": "yyyyMMdd HH:mm:ss"})])
    return standardize(raw, schema).select("o_orderkey", F.col("day").cast("string").alias("day"), F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"), F.size("errCol").alias("n_errors"))


@query("SELECT l_orderkey, count(DISTINCT CASE WHEN l_quantity >= 25 THEN l_linenumber END) AS n_errors, sum(CASE WHEN l_quantity >= 25 THEN 0 ELSE l_partkey END)::BIGINT AS kept FROM lineitem GROUP BY l_orderkey")
def std_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of arrays are cast one by one and report their own errors."""
    text = F.transform("lines", lambda x: F.struct(F.when(x["l_quantity"] >= 25, F.concat(F.lit("x"), x["l_linenumber"])).otherwise(x["l_partkey"].cast("string")).alias("part")))
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("lines", T.ArrayType(T.StructType([T.StructField("part", T.LongType(), False)])))])
    out = standardize(_orders_with_lines(spark, sf_dir).select("l_orderkey", text.alias("lines")), schema)
    return out.select("l_orderkey", F.size("errCol").cast("long").alias("n_errors"), F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x["part"]).alias("kept"))


@query("SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_name, 'E00006' AS err_code, 'Standardization Error - Type ''string'' cannot be cast to ''array''' AS err_msg FROM part")
def std_wrong_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.ArrayType(T.StringType()))])
    e = F.element_at("errCol", 1)
    return standardize(read(spark, sf_dir, "part"), schema).select("p_partkey", F.array_join("p_name", ",").alias("p_name"), e["errCode"].alias("err_code"), e["errMsg"].alias("err_msg"))


def _murmur3(columns: list[tuple[str, bool]]) -> str:
    """SQL of Spark's hash (Murmur3 of 32 bits from seed 42) of integers and ASCII texts (``True``) in a row."""
    two32 = 4294967296
    mixed = lambda k: f"(((({k}) * 3432918353 % {two32}) * 32768 % {two32} + (({k}) * 3432918353 % {two32}) // 131072) * 461845907 % {two32})"
    turned = lambda x: f"((({x}) * 8192 % {two32} + ({x}) // 524288) * 5 + 3864292196) % {two32}"
    out = "CAST(42 AS HUGEINT)"
    for name, text in columns:
        size = f"strlen({name})" if text else "4"
        byte = lambda i: f"CAST(ascii(substr({name}, {i}, 1)) AS HUGEINT)"
        words = f"list_transform(range(0, strlen({name}) // 4), lambda i: {byte('4*i+1')} + 256 * {byte('4*i+2')} + 65536 * {byte('4*i+3')} + 16777216 * {byte('4*i+4')}) || list_transform(range(strlen({name}) // 4 * 4, strlen({name})), lambda i: {byte('i+1')})" if text else f"[CAST({name} AS HUGEINT) % {two32}]"
        turn = turned(f"xor(h, {mixed('k')})")
        h = f"xor(list_reduce({words}, lambda h, k: {turn}, {out}), CAST({size} AS HUGEINT))"
        for factor, shift in ((2246822507, 65536), (3266489909, 8192), (1, 65536)):  # each bit reaches all others
            h = f"list_transform([{h}], lambda x: xor(x, x // {shift}) * {factor} % {two32})[1]"
        out = h
    return out


@query("SELECT * EXCLUDE (h), CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS record_id FROM (SELECT *, " + _murmur3([("n_nationkey", False), ("n_name", True), ("n_regionkey", False)]) + " AS h FROM nation)")
def std_record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stable id hashed from all columns."""
    df = read(spark, sf_dir, "nation")
    return standardize(df, df.schema, StdOptions(record_id="stable")).drop("errCol")


@query("SELECT count(*) AS records, count(*) FILTER (WHERE n > 0) AS failed, count(*) FILTER (WHERE n = 0) AS succeeded, sum(n)::BIGINT AS errors FROM (SELECT CASE WHEN TRY_CAST(o_orderpriority AS INTEGER) IS NULL THEN 1 ELSE 0 END + CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END AS n FROM orders)")
def err_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "orders").withColumn("s", F.when(F.col("o_orderstatus") == "F", "1").otherwise(F.col("o_orderstatus")))
    rules = [R.Casting(order=1, input="o_orderpriority", to="integer", output="a"), R.Casting(order=2, input="s", to="integer", output="b")]
    return errors.statistics(conform(df, rules))


@query("SELECT o_orderkey, 'E00003' AS \"errCode\", 'a' AS \"errCol\", o_orderpriority AS raw FROM orders WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL")
def err_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each error, as error sinks get them."""
    out = conform(read(spark, sf_dir, "orders"), [R.Casting(order=1, input="o_orderpriority", to="integer", output="a")])
    return errors.exploded(out, "o_orderkey").select("o_orderkey", "errCode", "errCol", F.element_at("rawValues", 1).alias("raw"))


@query("SELECT o_orderkey, 'O' AS o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END AS n_errors FROM orders")
def info_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A system column that differs is overwritten and reported."""
    out = overwrite(errors.with_errors(read(spark, sf_dir, "orders")), "O_ORDERSTATUS", F.lit("O"))
    return out.select("o_orderkey", "o_orderstatus", F.size("errCol").alias("n_errors"))


@query("SELECT r_regionkey, '2024-05-01' AS info_date, '2024-05-01' AS info_date_string, 3 AS info_version FROM region")
def info_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_info(errors.with_errors(read(spark, sf_dir, "region")), F.lit("2024-05-01").cast("date"), F.lit(3))
    return out.select("r_regionkey", F.col("info_date").cast("string").alias("info_date"), "info_date_string", "info_version")


@query("SELECT count(*) AS records, CAST(sum(CAST(l_quantity AS DECIMAL(38,10))) AS DOUBLE) AS quantity, count(DISTINCT l_suppkey) AS suppliers, CAST(sum(abs(l_linenumber - 4)) AS DOUBLE) AS spread FROM lineitem")
def control_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums of a checkpoint in one pass."""
    df = read(spark, sf_dir, "lineitem").withColumn("off", F.col("l_linenumber") - 4)
    C = measures.Control
    out = measures.measured(df, [C("records", "count"), C("quantity", "aggregatedTotal", "l_quantity"), C("suppliers", "distinctCount", "l_suppkey"), C("spread", "absAggregatedTotal", "off")])
    return out.select("records", F.col("quantity").cast("double").alias("quantity"), "suppliers", F.col("spread").cast("double").alias("spread"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken as runs: a dataset for each event type, five versions, ids that rise with the events."""
    e = read(spark, sf_dir, "events")
    status = F.element_at(F.array(*map(F.lit, runs.STATUSES)), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(
        F.col("event_type").alias("dataset"), (F.col("user_id") % 5).cast("int").alias("version"), F.col("event_id").alias("run_id"), F.concat(F.lit("u"), F.col("event_id")).alias("unique_id"),
        F.date_format("ts", "dd-MM-yyyy HH:mm:ss +0000").alias("started"), status.alias("status"), F.to_date("ts").alias("info_date"), (F.col("user_id") % 3).cast("int").alias("report_version"),
        (F.col("event_id") % 7).alias("errors"), F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("raw_records"), F.col("user_id").alias("source_records"),
    )


_RUNS = """
WITH runs AS (
  SELECT event_type AS dataset, CAST(user_id % 5 AS INTEGER) AS version, event_id AS run_id, 'u' || event_id AS unique_id, date_trunc('second', ts) AS started_at,
    CASE event_id % 4 WHEN 0 THEN 'running' WHEN 1 THEN 'stageSucceeded' WHEN 2 THEN 'allSucceeded' ELSE 'failed' END AS status, CAST(ts AS DATE) AS info_date, CAST(user_id % 3 AS INTEGER) AS report_version,
    event_id % 7 AS errors, CASE WHEN event_id % 2 = 0 THEN user_id END AS raw_records, user_id AS source_records
  FROM events)
"""


@query(_RUNS + "SELECT dataset, version, run_id FROM runs QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY version DESC, run_id DESC) = 1")
def runs_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_runs(_runs(spark, sf_dir)).select("dataset", "version", "run_id")


@query(_RUNS + "SELECT dataset, version, max(run_id) AS run_id FROM runs GROUP BY dataset, version ORDER BY dataset, version LIMIT 6 OFFSET 2")
def runs_latest_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_of_each(_runs(spark, sf_dir), offset=2, limit=6).select("dataset", "version", "run_id")


@query(_RUNS + "SELECT dataset, count(*) AS runs, strftime(max(started_at), '%d-%m-%Y %H:%M:%S') AS latest_start FROM runs GROUP BY dataset")
def runs_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.grouped_by_dataset(_runs(spark, sf_dir))


@query(_RUNS + "SELECT dataset, version, count(*) AS runs, strftime(max(started_at), '%d-%m-%Y %H:%M:%S') AS latest_start FROM runs WHERE dataset = 'click' GROUP BY dataset, version")
def runs_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.grouped_by_version(_runs(spark, sf_dir), "click")


@query(_RUNS + """, d AS (SELECT max(info_date) AS day FROM runs)
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'running') AS running, count(*) FILTER (WHERE status = 'stageSucceeded') AS "stageSucceeded", count(*) FILTER (WHERE status = 'allSucceeded') AS "allSucceeded",
  count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'allSucceeded' AND errors > 0) AS succeeded_with_errors
FROM runs, d WHERE info_date = day
""")
def runs_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _runs(spark, sf_dir)
    return runs.statuses_on(rows, F.lit(rows.agg(F.max("info_date")).first()[0]))


@query(_RUNS + """
SELECT CAST(info_date AS VARCHAR) AS info_date, report_version, run_id, attempts FROM (
  SELECT *, count(*) OVER (PARTITION BY info_date, report_version) AS attempts, row_number() OVER (PARTITION BY info_date, report_version ORDER BY run_id DESC) AS rn FROM runs WHERE dataset = 'click') WHERE rn = 1
""")
def runs_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.monitoring(_runs(spark, sf_dir), "click", F.lit("1970-01-01").cast("date"), F.lit("2999-01-01").cast("date"))
    return out.select(F.col("info_date").cast("string").alias("info_date"), "report_version", "run_id", "attempts")


@query(_RUNS + "SELECT status, count(*) AS reports, sum(coalesce(raw_records, source_records))::BIGINT AS raw_records, sum(errors)::BIGINT AS errors FROM runs GROUP BY status")
def runs_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.totals(_runs(spark, sf_dir), ["raw_records", "errors"])


@query(_RUNS + "SELECT run_id FROM runs WHERE status = 'running' AND started_at < (SELECT max(started_at) FROM runs) - INTERVAL 1 DAY")
def runs_zombies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _runs(spark, sf_dir)
    return runs.zombies(rows, F.lit(rows.agg(F.max(runs.started_at())).first()[0])).select("run_id")


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.concat(F.lit("set"), F.col("user_id") % 17).alias("name"), (F.col("event_id") % 4).cast("int").alias("version")).agg(F.max("event_id").alias("doc")).withColumn("disabled", F.col("version") == 3)


_ENTITIES = "WITH entities AS (SELECT 'set' || (user_id % 17) AS name, CAST(event_id % 4 AS INTEGER) AS version, max(event_id) AS doc, event_id % 4 = 3 AS disabled FROM events GROUP BY ALL)"


@query(_ENTITIES + "SELECT name, max(version) AS version, arg_max(doc, version) AS doc FROM entities WHERE NOT disabled GROUP BY name")
def catalog_latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.versions(_entities(spark, sf_dir))


@query(_ENTITIES + "SELECT name, array_to_string(list_sort(list_distinct(list(version))), ',') AS versions, count(*) FILTER (WHERE NOT disabled) AS enabled, bool_and(disabled) AS is_disabled FROM entities GROUP BY name")
def catalog_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.status_of_names(_entities(spark, sf_dir)).withColumn("versions", F.array_join(F.transform("versions", lambda v: v.cast("string")), ","))


@query(_ENTITIES + "SELECT count(DISTINCT name) AS names FROM entities")
def catalog_count_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.count_names(_entities(spark, sf_dir))


@query("SELECT name, essentiality, (SELECT count(*) FROM customer) - (SELECT count(*) FROM customer WHERE c_custkey % n <> 0) AS missing FROM (VALUES ('owner', 'Mandatory', 3), ('team', 'Recommended', 5)) v(name, essentiality, n)")
def catalog_property_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets that lack a property; customers stand for datasets."""
    pairs = F.array_compact(F.array(*(F.when(F.col("c_custkey") % n != 0, F.struct(F.lit(p).alias("k"), F.lit("v").alias("v"))) for p, n in (("owner", 3), ("team", 5)))))
    datasets = read(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.map_from_entries(pairs).alias("properties"))
    definitions = spark.createDataFrame([("owner", "Mandatory"), ("team", "Recommended")], "name string, essentiality string")
    return runs.property_statistics(datasets, definitions)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.page(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 40, 20)


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'd rod')")
def search_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.search(read(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "D Rod")


@query("SELECT vec_id, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS \"order\", unnest(embedding) AS element FROM embeddings")
def array_zip_with_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.inline(arrays.zip_with_order(F.col("embedding"))))


@query("SELECT l_suppkey, count(*) AS n, sum(l_partkey)::BIGINT AS total FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY l_suppkey")
def array_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner arrays that are null are skipped."""
    parts = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.collect_list("l_partkey").alias("parts"))
    nested = parts.groupBy("l_suppkey").agg(F.collect_list(F.struct(F.when(F.col("l_orderkey") % 3 != 0, F.col("parts")).alias("p")))["p"].alias("all"))
    flat = nested.select("l_suppkey", arrays.flatten_arrays(F.col("all")).alias("flat"))
    return flat.select("l_suppkey", F.size("flat").cast("long").alias("n"), F.aggregate("flat", F.lit(0).cast("long"), lambda a, x: a + x).alias("total")).where("n > 0")


@query("SELECT l_orderkey, l_linenumber, l_quantity * 2 AS l_quantity FROM lineitem")
def array_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = arrays.array_transform(_orders_with_lines(spark, sf_dir), "lines", lambda x: x.withField("l_quantity", x["l_quantity"] * 2))
    return out.select("l_orderkey", F.inline("lines")).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS info_date, strftime(ts, '%Y-%m-%d') AS info_date_string, CAST(user_id AS INTEGER) AS info_version, upper(event_type) AS kind FROM events")
def stream_rules_on_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream gives, on a frame: date and version from the data."""
    rules = [R.Uppercase(order=1, input="event_type", output="kind")]
    out = conformed(read(spark, sf_dir, "events"), rules, settings=Settings(date_column="ts", version_column="user_id"))
    return out.select("event_id", F.col("info_date").cast("string").alias("info_date"), "info_date_string", "info_version", "kind")


@query("SELECT event_id, upper(event_type) AS kind, strftime(ts, '%Y-%m-%d') AS info_date FROM events")
def stream_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules on a file stream that runs until it has read what is there, written as Parquet."""
    events = read(spark, sf_dir, "events")
    single = _is_file(spark, f"{sf_dir}/events.parquet")  # a stream reads folders
    source = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet" if single else "*.parquet")
    stream = source.parquet(sf_dir if single else f"{sf_dir}/events.parquet")
    out = conformed(stream, [R.Uppercase(order=1, input="event_type", output="kind")], settings=Settings(date_column="ts")).select("event_id", "kind", F.col("info_date").cast("string").alias("info_date"))
    at = shared_path(spark, "stream")
    out.writeStream.format("parquet").option("path", f"{at}/data").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{at}/data")


def _is_file(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile()
