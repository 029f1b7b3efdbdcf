"""Queries of publishing, messages in Avro, sizes of files, catalogs and migrations, and the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import sql
from millrace.operators import rules as R
from millrace.plans import catalog, sizing
from millrace.plans import migrations as M
from millrace.plans.conform import conform
from millrace.registry import query, read
from millrace.session import shared_path
from millrace.sources import avro, messages, publish

DAY = dt.date(2024, 1, 2)


@query("SELECT o_orderkey, o_orderstatus, v.v AS info_version FROM orders, (VALUES ('F', 1), ('O', 2), ('P', 4)) v(s, v) WHERE o_orderstatus = v.s")
def job_writers_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four writers claim versions before any is done: one gives up, the others publish in another order, and no version is taken twice."""
    orders, base = read(spark, sf_dir, "orders"), shared_path(spark, "publish")
    writers = {s: publish.begin(spark, base, DAY) for s in ("F", "O", "x", "P")}
    for status in ("P", "O", "F"):
        orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus").write.parquet(writers[status].staged)
    writers["x"].abort()
    for status in ("P", "F", "O"):
        writers[status].commit()
    out = spark.read.parquet(base)
    return out.select("o_orderkey", "o_orderstatus", F.col("info_version").cast("int").alias("info_version"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS key, 'erp' AS system, 'orders' AS dataset, 'E00003' AS code, '2024-01-02' AS day, o_orderpriority AS raw, 'conformance' AS stage, 'none' AS team
FROM orders WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL
""")
def msg_errors_avro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message for each error in Avro, kept in files and read with a later schema: a renamed and a new field, a date and a wider number."""
    out = conform(read(spark, sf_dir, "orders"), [R.Casting(order=1, input="o_orderpriority", to="integer", output="a")])
    values = messages.error_values(out, "erp", "orders", F.lit("2024-01-02").cast("date"), F.lit(1), record_id="o_orderkey")
    wrote = avro.schema_of(values.schema["value"].dataType, "dataError", "errors")
    messages.in_avro(values, wrote, schema_id=7).write.parquet(at := shared_path(spark, "avro"))
    fields = {f["name"]: f for f in wrote["fields"]}
    day = {"name": "informationDate", "type": ["null", {"type": "int", "logicalType": "date"}], "default": None}
    later = {**wrote, "fields": [{**fields["errorSourceId"], "name": "stage", "aliases": ["errorSourceId"]}, day, {"name": "team", "type": "string", "default": "none"}, *(fields[n] for n in ("sourceSystem", "dataset", "errorCode", "additionalInfo"))]}
    v = F.col("v")
    sent = spark.read.parquet(at).select("key", avro.decode(F.col("value"), wrote, later, framed=True).alias("v"))
    return sent.select("key", v["sourceSystem"].alias("system"), v["dataset"].alias("dataset"), v["errorCode"].alias("code"), v["informationDate"].cast("string").alias("day"), v["additionalInfo"]["rawValues"].alias("raw"), v["stage"].alias("stage"), v["team"].alias("team"))


@query("""
SELECT c_custkey, CAST(c_nationkey AS INT) AS nation, 'customer' AS kind, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_custkey % 4 AS n_orders, (c_custkey % 4) * (c_custkey % 4 + 1) * 5 AS total, CAST(NULL AS VARCHAR) AS segment
FROM customer WHERE c_acctbal >= 0
""")
def doc_migrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of customers over two versions of their model, in one projection: fields renamed, added and dropped, elements of arrays changed, documents dropped."""
    orders = F.transform(F.when(F.col("c_custkey") % 4 > 0, F.sequence(F.lit(1).cast("long"), F.col("c_custkey") % 4)).otherwise(F.array().cast("array<long>")), lambda i: F.struct(i.alias("no")))
    balance = F.round(F.col("c_acctbal") * 100).cast("long")
    made = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), balance.alias("balance"), F.col("c_mktsegment").alias("segment"), orders.alias("orders")))
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.parse_json(made).alias("doc"))
    long = lambda doc, path: F.variant_get(doc, f"$.{path}", "long")
    one = M.Migration(1, {"customer": lambda doc: F.when(long(doc, "balance") >= 0, M.put(M.renamed(doc, "nation", "nationKey"), "kind", F.lit("customer")))})
    two = M.Migration(2, {"client": lambda doc: M.without(M.each(M.renamed(doc, "balance", "cents"), "orders", lambda o: M.put(o, "price", long(o, "no") * 10)), "segment")}, renames={"customer": "client"}, added=("note",))
    documents = M.Documents(spark, shared_path(spark, "documents"), ["customer"], [one, two])
    documents.insert("customer", customers)
    documents.migrate(2)
    doc = F.col("doc")
    prices = F.transform(F.variant_get(doc, "$.orders", "array<variant>"), lambda o: long(o, "price"))
    return documents.read("client").select(
        F.col("id").cast("long").alias("c_custkey"), F.variant_get(doc, "$.nationKey", "int").alias("nation"), F.variant_get(doc, "$.kind", "string").alias("kind"), long(doc, "cents").alias("cents"),
        F.size(prices).cast("long").alias("n_orders"), F.aggregate(prices, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.variant_get(doc, "$.segment", "string").alias("segment"),
    )


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 3 <> 1 THEN 1 ELSE 2 END AS version, CASE WHEN c_custkey % 5 = 0 THEN 'x customer-' || c_custkey || ' is at version 1, not 7' END AS refused, c_custkey % 5 <> 0 AND c_custkey % 3 = 2 AND c_custkey % 7 <> 0 AS disabled,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 3 = 2 AND c_custkey % 7 = 0 THEN 1 ELSE 0 END AS held
FROM customer
""")
def catalog_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as documents of the catalog in one commit; a second one changes a third of them, refuses what was made from another version, and disables what nothing uses."""
    keys = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("customer-"), "c_custkey").alias("name"))
    c = catalog.Catalog(spark, shared_path(spark, "catalog"))
    doc = F.to_json(F.struct(F.col("c_custkey").alias("key")))
    users = keys.where("c_custkey % 7 = 0").select(F.lit("dataset").alias("kind"), F.concat(F.lit("of "), "name").alias("name"), F.lit("create").alias("action"), F.lit(None).cast("int").alias("based_on"), F.to_json(F.struct(F.array(F.struct(F.col("name").alias("mappingTable"), F.lit(1).alias("mappingTableVersion"))).alias("conformance"))).alias("doc"))
    tables = keys.select(F.lit("mappingTable").alias("kind"), "name", F.lit("create").alias("action"), F.lit(None).cast("int").alias("based_on"), doc.alias("doc"))
    assert c.apply(tables.unionByName(users)).where("refused IS NOT NULL").isEmpty()
    action = F.when((F.col("c_custkey") % 5 == 0) | (F.col("c_custkey") % 3 == 1), "update").when(F.col("c_custkey") % 3 == 2, "disable")
    changes = keys.withColumn("action", action).where("action IS NOT NULL").select(F.lit("mappingTable").alias("kind"), "name", "action", F.when(F.col("c_custkey") % 5 == 0, 7).otherwise(1).alias("based_on"), F.lit('{"changed":true}').alias("doc"))
    report = c.apply(changes, partly=True).select("name", F.regexp_replace("refused", "^mappingTable ", "x ").alias("said"))
    last = c.entities().where("kind = 'mappingTable'").groupBy("name").agg(F.max("version").alias("version"), F.bool_and("disabled").alias("disabled"))
    rows = keys.join(last, "name").join(report, "name", "left")
    held = F.col("said").like("%is used by%")
    return rows.select("c_custkey", "version", F.when(~held, F.col("said")).alias("refused"), "disabled", F.when(held, 1).otherwise(0).alias("held"))


@query("SELECT l_orderkey, l_linenumber, true AS within FROM lineitem")
def job_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of sizes within a window, as the folder shows them, told by a sample that is written first."""
    lines, at = read(spark, sf_dir, "lineitem"), shared_path(spark, "sized")
    least, most = 60_000, 240_000
    sizing.resized(lines, "sample", least, most, 20_000).write.parquet(at)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(at).select("path", "length")
    alone = files.count() == 1
    fits = files.select(F.substring_index("path", "/", -1).alias("file"), ((F.col("length") <= most) & ((F.col("length") >= least) | F.lit(alone))).alias("within"))
    return spark.read.parquet(at).select("l_orderkey", "l_linenumber", F.substring_index(F.input_file_name(), "/", -1).alias("file")).join(F.broadcast(fits), "file").drop("file")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' END AS state, CASE WHEN o_orderstatus IN ('F', 'O') THEN '' ELSE 'E00001:state:' || o_orderstatus END
  || CASE WHEN o_orderkey % 10 = 0 THEN 'E00003:price:' || o_orderpriority ELSE '' END AS told
FROM orders
""")
def rule_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule of the caller's own in SQL text, with errors made and gathered by functions of the session."""
    sql.register(spark)

    def change(df: DataFrame) -> DataFrame:
        state = "CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END"
        unknown = "confMappingErr('state', array(o_orderstatus), array(named_struct('mappingTableColumn', 'code', 'mappedDatasetColumn', 'o_orderstatus')))"
        df = df.selectExpr("*", f"{state} AS state")
        df = df.withColumn("errCol", F.expr(f"CASE WHEN state IS NULL THEN errorColumnAppend(errCol, {unknown}) ELSE errCol END"))
        again = "CASE WHEN o_orderkey % 10 = 0 THEN errorColumnAppend(errorColumnAppend(errCol, confCastErr('price', o_orderpriority)), confCastErr('price', o_orderpriority)) ELSE errCol END"
        return df.withColumn("errCol", F.expr(f"arrayDistinctErrors({again})"))

    out = conform(read(spark, sf_dir, "orders"), [R.Custom(order=1, output="state", change=change)])
    told = F.array_join(F.transform("errCol", lambda e: F.concat_ws(":", e["errCode"], e["errCol"], F.array_join(e["rawValues"], ","))), "")
    return out.select("o_orderkey", "state", told.alias("told"))


@query("""
WITH g AS (SELECT c_custkey, unnest([{'n': 'segment', 'v': c_mktsegment}, {'n': CASE WHEN c_custkey % 3 = 0 THEN 'owner' END, 'v': 'x'}, {'n': CASE WHEN c_nationkey < 5 THEN 'color' END, 'v': c_name}, {'n': CASE WHEN c_custkey % 4 = 0 THEN 'old' END, 'v': ''}]) AS p FROM customer)
SELECT c_custkey, p.n AS property, 'error' AS level, CASE p.n WHEN 'color' THEN 'there is no property definition for ''color''' WHEN 'old' THEN 'property definition ''old'' is disabled' ELSE 'value ''' || p.v || ''' is not one of BUILDING, MACHINERY' END AS said
FROM g WHERE p.n IN ('color', 'old') OR p.n = 'segment' AND p.v NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT c_custkey, 'owner', 'warning', 'property ''owner'' is mandatory, but there is no value' FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT c_custkey, 'team', 'warning', 'property ''team'' is recommended, but there is no value' FROM customer
""")
def catalog_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of as many datasets as there are customers, checked for a run against their definitions."""
    pairs = {"segment": F.col("c_mktsegment"), "owner": F.when(F.col("c_custkey") % 3 == 0, "x"), "color": F.when(F.col("c_nationkey") < 5, F.col("c_name")), "old": F.when(F.col("c_custkey") % 4 == 0, "")}
    each = F.array(*(F.struct(F.when(v.isNotNull(), n).alias("name"), v.alias("value")) for n, v in pairs.items()))
    given = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("dataset"), F.inline(each))
    definitions = [catalog.Property("segment", allowed=("BUILDING", "MACHINERY")), catalog.Property("owner", "Mandatory", allow_run=True), catalog.Property("team", "Recommended"), catalog.Property("old", "Mandatory", disabled=True)]
    return catalog.property_findings(given, definitions, for_run=True).withColumnRenamed("dataset", "c_custkey")
