"""Partitions within a window of bytes, error functions in SQL, and what the command line refuses."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import errors, sizes, sql
from millrace.operators import rules as R
from millrace.plans import job, sizing
from millrace.plans.conform import conform
from millrace.registry import read

SMALL = "/root/testdata/sf0.001"


def test_wanted_partitions():
    assert [sizing.wanted(1000, 4, None, m) for m in (300, 250, 100, 10)] == [4, 4, 10, 100]
    assert [sizing.wanted(1000, 100, n, None) for n in (5, 100, 300, 5000)] == [100, 10, 3, 1]
    assert sizing.wanted(1000, 10, 50, 200) == 10 and sizing.wanted(1000, 1, 50, 200) == 8 and sizing.wanted(1000, 100, 50, 200) == 8
    assert sizing.wanted(0, 8, 10, 20) == 1 and sizing.wanted(0, 0, None, 5) == 1 and sizing.wanted(30, 1, 40, 80) == 1
    for size, now in ((1000, 1), (1000, 77), (123, 5), (99999, 3)):
        n = sizing.wanted(size, now, 60, 100)
        assert size / n <= 100 and (size / n >= 60 or n == 1 or size < 120)
    with pytest.raises(ValueError):
        sizing.wanted(1, 1, 5, 4)


def test_sizes(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 4).select("id", F.md5(F.col("id").cast("string")).alias("s"))
    df.write.parquet(f"{tmp_path}/x")
    rows, whole = spark.read.parquet(f"{tmp_path}/x"), sum(f.stat().st_size for f in (tmp_path / "x").glob("*.parquet"))
    assert sizes.by_rows(rows) == 20_000 * (16 + 32 + 8) and abs(sizes.by_plan(rows) - whole) < 0.1 * whole
    assert abs(sizes.by_sample(rows, 8000) - whole) < 0.15 * whole and sizes.by_sample(rows, 1 << 30) > 0 and sizes.by_sample(rows.where("false"), 10) == 0


@pytest.mark.parametrize("strategy", sizing.STRATEGIES)
def test_files_within_the_window(spark, tmp_path, strategy):
    df = spark.range(0, 40_000, 1, 3).select("id", F.md5(F.col("id").cast("string")).alias("s"))
    df.write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    size = {"plan": sizes.by_plan(df), "dataframe": sizes.by_rows(df), "sample": sizes.by_sample(df, 10_000)}[strategy]
    out = sizing.resized(df, strategy, size // 16, size // 9)
    out.write.parquet(f"{tmp_path}/out")
    files = [f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")]
    assert 9 <= len(files) <= 16 and spark.read.parquet(f"{tmp_path}/out").count() == 40_000
    if strategy != "dataframe":  # sizes in memory are others than those of files
        assert all(size // 18 <= f <= size // 8 for f in files)
    assert sizing.resized(df, strategy) is df
    shuffled = df.groupBy("s").count()
    assert sizing.partitions(shuffled) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sizing.resized(df, strategy, 1, 1 << 40) is df
    with pytest.raises(ValueError):
        sizing.resized(df, "guess", 1, 2)


def test_error_functions_in_sql(spark):
    sql.register(spark)
    sql.register(spark)
    df = spark.createDataFrame([("a", ["x", None]), (None, None)], "c string, r array<string>")
    pairs = "array(named_struct('mappingTableColumn', 'k', 'mappedDatasetColumn', 'c'))"
    out = df.select(
        F.expr("confCastErr(c, 'raw')"), F.expr("confNegErr('c', c)"), F.expr("confLitErr('c', c)"), F.expr(f"confMappingErr('c', r, {pairs})"),
        errors.error(errors.CONF_CAST, "", [F.lit("raw")]).withField("errCol", F.col("c")), errors.error(errors.CONF_NEG, "c", [F.col("c")]), errors.error(errors.CONF_LIT, "c", [F.col("c")]), errors.error(errors.CONF_MAP, "c", [], [("k", "c")]).withField("rawValues", F.col("r")),
    )
    for row in out.collect():
        assert list(row[:4]) == list(row[4:])
    lists = spark.sql("SELECT confCastErr('a', '1') AS e").select(F.expr("arrayDistinctErrors(array(e, null, e)) AS once"), F.expr("arrayDistinctErrors(null) AS none"), F.expr("errorColumnAppend(array(e), confNegErr('b', '2')) AS two")).first()
    assert [e.errCode for e in lists.once] == ["E00003"] and lists.none == [] and [e.errCode for e in lists.two] == ["E00003", "E00004"]


def test_rules_in_sql_need_no_python(spark):
    sql.register(spark)
    change = lambda df: df.withColumn("errCol", F.expr("CASE WHEN n_regionkey = 1 THEN errorColumnAppend(errCol, confLitErr('x', n_name)) ELSE errCol END"))
    out = conform(read(spark, SMALL, "nation"), [R.Custom(order=1, output="x", change=change)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and out.where("size(errCol) = 1").count() == out.where("n_regionkey = 1").count()


def test_arguments_that_are_refused(spark, tmp_path, capsys):
    schema = {"type": "struct", "fields": []}
    (tmp_path / "d.json").write_text(json.dumps({"name": "d", "version": 3, "schema": schema, "rawPath": "r", "standardizedPath": "s", "publishedPath": "p"}))
    base = ["both", "--dataset-file", str(tmp_path / "d.json"), "--report-date", "2024-01-02"]
    _, found = job.from_arguments(spark, [*base, "--dataset-name", "d", "--dataset-version", "3", "--partition-strategy", "sample", "--partition-least", "5", "--partition-most", "9", "--auth-keytab", "k"])
    assert (found.partition_strategy, found.partition_least, found.partition_most) == ("sample", 5, 9)
    for more, said in (
        (["--report-version", "0"], "not a number above 0"), (["--dataset-version", "-1"], "not a number above 0"), (["--credentials-file", "c", "--auth-keytab", "k"], "not allowed with"),
        (["--partition-strategy", "guess"], "invalid choice"), (["--partition-most", "x"], "not a number"), (["--report-date", "02/01/2024"], "invalid"),
    ):
        with pytest.raises(SystemExit):
            job.from_arguments(spark, [*base, *more])
        assert said in capsys.readouterr().err
    for more, said in ((["--dataset-name", "e"], "the name d, not e"), (["--dataset-version", "4"], "the version 3, not 4")):
        with pytest.raises(ValueError, match=said):
            job.from_arguments(spark, [*base, *more])


def test_options_of_formats(spark, tmp_path):
    (tmp_path / "book").write_text("01 R. 05 A PIC X(3).")
    doc = {"name": "d", "version": 3, "schema": {"type": "struct", "fields": []}, "rawPath": "r", "standardizedPath": "s", "publishedPath": "p", "mappingTables": [{"name": "t", "path": f"{tmp_path}/t"}]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    spark.range(3).write.parquet(f"{tmp_path}/t/2024/01-02")
    base = ["both", "--dataset-file", str(tmp_path / "d.json"), "--report-date", "2024-01-02", "--mapping-table-pattern", "{0}/{1}-{2}"]

    def given(*more):
        return job.from_arguments(spark, [*base, *more])[1]

    csv = given("--raw-format", "csv", "--delimiter", "U+00A1", "--header", "true", "--csv-quote", "none", "--charset", "ISO-8859-1", "--null-value", "-", "--strict-schema-check", "false", "--option", "multi_line=true")
    assert csv.format_options == {"multi_line": True, "charset": "ISO-8859-1", "delimiter": "U+00A1", "header": True, "quote": "none", "null_value": "-", "strict": False} and csv.tables["t"].rows.count() == 3
    book = given("--raw-format", "cobol", "--copybook", str(tmp_path / "book"), "--cobol-encoding", "ascii", "--cobol-is-text", "false", "--cobol-trimming-policy", "left", "--is-xcom", "true")
    assert book.format_options == {"copybook": "01 R. 05 A PIC X(3).", "encoding": "ascii", "is_text": False, "trimming": "left", "xcom": True}
    fixed = given("--raw-format", "fixed-width", "--trim-values", "true", "--empty-values-as-nulls", "true", "--standardized-path", "/x/{0}-{1}/{2}/v{3}", "--debug-set-raw-path", "/raw", "--report-version", "4")
    assert fixed.format_options == {"trim": True, "empty_as_null": True} and (fixed.standardized_path, fixed.raw_path, fixed.raw_folder) == ("/x/d-3/2024-01-02/v4", "r", "/raw")
    with pytest.raises(ValueError, match="--row-tag is an option of xml, not of csv"):
        given("--raw-format", "csv", "--row-tag", "x")
    with pytest.raises(SystemExit):
        given("--raw-format", "csv", "--header", "maybe")
    with pytest.raises(FileNotFoundError):
        given("--mapping-table-pattern", "{0}")
