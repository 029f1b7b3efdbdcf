from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import registry, registry_io  # noqa: F401 registers further queries
from millrace.functions import arrays, text
from millrace.functions.paths import PathError
from millrace.operators import rules as R
from millrace.plans import catalog, job, lifecycle, measures, runs
from millrace.streaming.conformed import Settings, check_settings, conformed

from .conftest import SMALL, rows

TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else str(x) if isinstance(x, dt.date | dt.datetime) else x


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, oracle, name):
    df = registry.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    cursor = oracle.execute(registry.SQL[name])
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(at) == cols
    want = sorted(repr([plain(r[at[c]]) for c in cols]) for r in cursor.fetchall())
    assert sorted(repr([plain(r[c]) for c in cols]) for r in df.collect()) == want


HALVES = [(i, f"c{i}", x) for i, x in enumerate((0.5, -0.5, 1.5, 0.49999999999999994, 0.5000000000000001, -0.0, 1.0, None))]


@pytest.mark.parametrize("data", [HALVES, [(None, None, 2.0), (0, "c0", 0.0)]], ids=["halves", "nulls"])
def test_parquet_source_matches_sql(spark, tmp_path, data):
    spark.createDataFrame(data, "c_custkey long, c_name string, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    want = con.execute(registry.SQL["src_parquet"]).fetchall()
    df = registry.QUERIES["src_parquet"](spark, str(tmp_path))
    assert sorted(repr(tuple(r)) for r in df.collect()) == sorted(map(repr, want)) and len(want) == len(data)


def test_arrays(spark):
    df = spark.createDataFrame([(1, [[1], None, [2, None]], ((5,),)), (2, None, None)], "id int, a array<array<int>>, s struct<t:struct<x:int>>")
    flat = df.select(arrays.flatten_arrays(F.col("a")).alias("f"), arrays.zip_with_order(arrays.flatten_arrays(F.col("a"))).alias("z"))
    assert [r["f"] for r in rows(flat)] == [[1, 2, None], None] and rows(flat)[0]["z"][1] == {"order": 1, "element": 2}
    made = arrays.nested_with_column(df, "s.new.deep", F.lit(1))
    assert rows(made)[0]["s"] == {"t": {"x": 5}, "new": {"deep": 1}} and rows(arrays.nested_drop(made, "s.new"))[0]["s"] == {"t": {"x": 5}}
    nested = spark.createDataFrame([([(1,)],)], "l array<struct<x:int>>")
    with pytest.raises(PathError):
        arrays.nested_drop(nested, "l.x")


def test_measures(spark, tmp_path):
    m = measures.Measures({"source": "s"}, (measures.Control("n", "count"), measures.Control("sum", "aggregatedTotal", "id"), measures.Control("x", "count", "missing")))
    heard = []
    m.listeners = [lambda x: heard.append(len(x.checkpoints)), lambda x: 1 / 0]
    with pytest.warns(UserWarning):
        m.checkpoint("Source", spark.range(5))
    assert [(c["controlName"], c["controlValue"]) for c in m.checkpoints[0]["controls"]] == [("n", "5"), ("sum", "10")] and heard == [1]
    m.write(spark, str(tmp_path))
    again = measures.Measures.read(spark, str(tmp_path))
    assert again.to_json() == m.to_json() and again.count("source") == 5
    with pytest.raises(ValueError, match="no count at Raw"):
        measures.check_counts(again)
    with pytest.warns(UserWarning):
        measures.check_counts(again, "warning")
    with pytest.raises(ValueError, match="no output"):
        measures.check_not_empty(spark.range(0), again)
    df, seen = measures.observed(spark.range(7), "o", [measures.Control("n", "count")])
    df.collect()
    assert seen.get["n"] == 7


def test_paging_and_filters(spark):
    with pytest.raises(ValueError):
        runs.page(spark.range(3), ["id"], -1)
    with pytest.raises(ValueError):
        runs.latest_of_each(spark.range(1), dataset="a", unique_id="u", app_id="x")
    names = spark.createDataFrame([("a.B",), ("aXb",)], "name string")
    assert [r.name for r in runs.search(names, "name", "A.b").collect()] == ["a.B"]


def test_catalog(spark, tmp_path):
    c = catalog.Catalog(spark, str(tmp_path / "c"))
    assert c.create("schema", "s", {"fields": []}) == 1 and c.update("schema", "s", 1, {"fields": [1]}) == 2
    with pytest.raises(catalog.Conflict, match="version 2"):
        c.update("schema", "s", 1, {})
    c.create("dataset", "d", {"schemaName": "s", "schemaVersion": 2})
    assert c.used_in("schema", "s") == [("dataset", "d", 1)] and c.used_in("schema", "s", 1) == []
    with pytest.raises(catalog.Conflict, match="used by"):
        c.disable("schema", "s")
    c.disable("dataset", "d")
    c.disable("schema", "s")
    assert c.get("schema", "s") is None and c.create("schema", "s", {}) == 3
    c.lock("schema", "s")
    with pytest.raises(catalog.Conflict, match="locked"):
        c.update("schema", "s", 3, {})
    other = catalog.Catalog(spark, str(tmp_path / "other"))
    assert other.load(c.export("schema", "s", 3)) == 1 and other.get("schema", "s")["version"] == 1
    assert [r.action for r in c.audit("dataset", "d").collect()] == ["create", "disable"]


def test_rule_list_and_properties():
    schema = T.StructType([T.StructField("a", T.StringType())])
    steps = [R.Uppercase(order=1, input="a", output="b"), R.Uppercase(order=2, input="zz", output="b"), R.Mapping(order=3, table="t", keys=(("k", "a"),), target="v", output="m")]
    found = catalog.check_rules(schema, steps)
    assert not found and sorted(found.errors) == ["item.conformanceRules.2", "item.conformanceRules.3"] and len(found.errors["item.conformanceRules.2"]) == 2
    definitions = [catalog.Property("owner", "Mandatory", allow_run=True), catalog.Property("team", "Recommended"), catalog.Property("kind", allowed=("x",)), catalog.Property("old", disabled=True)]
    said = catalog.check_properties({"kind": "y", "old": "1", "new": "1"}, definitions)
    assert sorted(said.errors) == ["kind", "new", "old", "owner"] and list(said.warnings) == ["team"]
    assert "owner" in catalog.check_properties({}, definitions, for_run=True).warnings


def test_stream_settings(spark):
    good = {"dataset.name": "d", "dataset.version": "1", "auth.keytab": "k", "event.timestamp.column": "t"}
    assert check_settings(good).date_column == "t"
    for wrong in ({**good, "credentials.file": "f"}, {**good, "dataset.name": ""}):
        with pytest.raises(ValueError):
            check_settings(wrong)
    df = spark.createDataFrame([("2024-02-03T10:00Z",), (None,)], "t string")
    out = rows(conformed(df, [], settings=Settings(date_column="t")))
    assert (str(out[0]["info_date"]), out[0]["info_date_string"], out[0]["info_version"]) == ("2024-02-03", "2024-02-03", 1)
    assert out[1]["info_date"] is not None and out[1]["info_date_string"] == ""
    with pytest.raises(ValueError, match="not a timestamp"):
        conformed(spark.range(1), [], settings=Settings(date_column="id"))


def test_jobs(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    raw = f"{tmp_path}/raw/2024/01/02/v1"
    spark.createDataFrame([("1", "a"), ("x", "b")], "id string, v string").write.csv(raw)
    said, sent = [], []
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("v", T.StringType())])
    one = job.Job("d", 1, day, schema, f"{tmp_path}/raw", f"{tmp_path}/std", f"{tmp_path}/out", rules=[R.Uppercase(order=1, input="v", output="loud", checkpoint=True)], format="csv", record_id="stable", clean_standardized=True, partition_bytes=1 << 20, performance_file=f"{tmp_path}/performance",
                  on_status=lambda stage, status: said.append((stage, status)), post_processors=[lambda df, what: sent.append((what["stage"], df.count()))])
    out = {r["v"]: r for r in rows(job.both(spark, one))}
    assert (out["a"]["loud"], out["b"]["id"], out["b"]["errCol"][0]["errCode"]) == ("A", 0, "E00000")
    assert said == [("Standardization", "running"), ("Standardization", "stageSucceeded"), ("Conformance", "running"), ("Conformance", "allSucceeded")]
    assert sent == [("Standardization", 2), ("Conformance", 2)]
    info = measures.Measures.read(spark, f"{tmp_path}/out/info_date=2024-01-02/info_version=1")
    assert {"stage=Conformance", "records=2", "failed=1", "executors=1"} <= set((tmp_path / "performance").read_text().split())
    assert {"info_date", "info_version"} <= set(spark.read.parquet(f"{tmp_path}/out/info_date=2024-01-02/info_version=1").columns) and [c["controls"][0]["controlValue"] for c in info.checkpoints] == ["2"] * 4
    assert [c["name"] for c in info.checkpoints] == ["Standardization - End", "1 UppercaseConformanceRule before", "1 UppercaseConformanceRule after", "Conformance - End"] and info.metadata["conformance_failed"] == 1
    assert job.plugins({"p.1": "math:sqrt", "p.3": "math:pi"}, "p")[0](9) == 3


def test_observed_checkpoints_need_no_pass_of_their_own(spark, tmp_path):
    m = measures.Measures(controls=(measures.Control("n", "count"), measures.Control("sum", "aggregatedTotal", "id")))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = m.observe("b", m.observe("a", spark.range(5)).where("id > 0"))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before and m.checkpoints == []
    df.write.parquet(f"{tmp_path}/o")
    m.settle()
    assert [(c["name"], [x["controlValue"] for x in c["controls"]]) for c in m.checkpoints] == [("a", ["5", "10"]), ("b", ["4", "10"])]


def test_run_numbers_and_catalog_changes_are_claimed(spark, tmp_path, monkeypatch):
    log = lifecycle.RunLog(spark, str(tmp_path / "log"))
    first, second = (log.start("d", 1, dt.date(2024, 1, 2)) for _ in range(2))
    assert (first.run_id, second.run_id) == (1, 2) and first.unique_id != second.unique_id
    log.add(second, 5, "allSucceeded", {"records": 3})
    assert [(r.run_id, r.status, r.records) for r in log.runs().orderBy("run_id").collect()] == [(1, "running", None), (2, "allSucceeded", 3)]
    one, other = (catalog.Catalog(spark, str(tmp_path / "c")) for _ in range(2))
    one.create("schema", "a/b", {})
    seen, state, last = other._last(), other._state("schema", "a/b"), other._last
    one.update("schema", "a/b", 1, {"x": 1})
    stale = [seen]  # the other one looked before that: its rows are refused, and what it sees then is a conflict
    monkeypatch.setattr(other, "_last", lambda: stale.pop() if stale else last())
    monkeypatch.setattr(other, "_state", lambda *a: state if not stale and state else catalog.Catalog._state(other, *a))
    commits = []
    commit = other._commit
    monkeypatch.setattr(other, "_commit", lambda rows, seen: (monkeypatch.setattr(other, "_state", lambda *a: catalog.Catalog._state(other, *a)), commits.append(commit(rows, seen)))[0] or commits[-1])
    with pytest.raises(catalog.Conflict, match="is at version 2, not 1"):
        other.update("schema", "a/b", 1, {"x": 2})
    assert commits == [False]
    assert one.get("schema", "a/b") == {"x": 1, "name": "a/b", "version": 2}


def test_settings_of_the_session_are_set_again(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    job.write_sized(spark.range(10), f"{tmp_path}/x", 1 << 20)
    assert spark.conf.get(key) == before and spark.read.parquet(f"{tmp_path}/x").count() == 10


@pytest.mark.parametrize("value", ["", ",", "a", "a,b", 'a,"b,c",d', '"a', 'a,b"c,d', '"x"y,"', ",,a,,", 'é"é,"ü', "a,b,,"])
def test_lists_with_quotes(spark, value):
    def even(x: str) -> bool:
        return x.count('"') % 2 == 0

    parts, last = [], 0
    for i, c in enumerate(value):
        if c == "," and even(value[i:]):
            parts.append(value[last:i])
            last = i + 1
    parts.append(value[last:])
    df = spark.createDataFrame([(value,)], "v string").select(text.split_quoted(F.col("v")).alias("p"), text.split_quoted(F.col("v"), keep_empty_end=True).alias("all"), text.trim_ends(F.col("v"), '"').alias("t"))
    row = df.first()
    assert row["all"] == ([] if value == "" else parts)
    while parts and parts[-1] == "":
        parts.pop()
    assert row["p"] == parts and row["t"] == (value[1:-1] if len(value) > 1 and value[0] == value[-1] == '"' else value)


def test_arguments():
    args = job.parser().parse_args(["both", "--dataset-file", "f", "--report-date", "2024-01-02", "--raw-format", "csv", "--option", "delimiter=;"])
    assert args.report_date == dt.date(2024, 1, 2) and args.option == ["delimiter=;"]
