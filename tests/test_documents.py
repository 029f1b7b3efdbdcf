"""Batches of catalog changes, and migrations of documents."""

from __future__ import annotations

import random
import threading

import pytest
from pyspark.sql import functions as F

from millrace.plans import catalog
from millrace.plans import migrations as M


def batch(spark, *rows):
    return spark.createDataFrame([(k, n, a, b, d) for k, n, a, b, d in rows], catalog.CHANGES)


def refused(report):
    return {(r.kind, r.name): r.refused for r in report.collect()}


def test_batches_are_judged_and_made_as_one(spark, tmp_path):
    c = catalog.Catalog(spark, str(tmp_path / "c"))
    c.create("schema", "old", {"fields": []})
    first = batch(spark, ("schema", "s", "create", None, "{}"), ("dataset", "d", "create", None, '{"schemaName":"s","schemaVersion":1}'), ("schema", "old", "update", 1, '{"fields":[1]}'))
    assert set(refused(c.apply(first)).values()) == {None}
    assert c.get("schema", "old") == {"fields": [1], "name": "old", "version": 2} and c.get("dataset", "d")["schemaName"] == "s"
    second = batch(
        spark, ("schema", "s", "disable", None, None), ("schema", "new", "create", None, "{}"), ("schema", "new2", "update", 1, "{}"), ("dataset", "d", "create", None, "{}"), ("schema", "old", "update", 1, "{}"),
        ("x", "twice", "create", None, "{}"), ("x", "twice", "create", None, "{}"), ("x", "y", "sing", None, "{}"), (None, "y", "create", None, "{}"), ("x", "z", "lock", None, None), ("x", "n", None, None, None),
    )
    want = {
        ("schema", "s"): "schema s is used by dataset d 1", ("schema", "new"): None, ("schema", "new2"): "there is no schema new2", ("dataset", "d"): "dataset d exists", ("schema", "old"): "schema old is at version 2, not 1",
        ("x", "twice"): "x twice is in the batch more than once", ("x", "y"): "there is no action sing", (None, "y"): "a change needs a kind and a name", ("x", "z"): "there is no x z", ("x", "n"): "there is no action null",
    }
    assert refused(c.apply(second)) == want and c.get("schema", "new") is None
    assert refused(c.apply(second, partly=True)) == want and c.get("schema", "new")["version"] == 1
    assert refused(c.apply(batch(spark, ("dataset", "d", "disable", None, None), ("schema", "old", "lock", None, None)))) == {("dataset", "d"): None, ("schema", "old"): None}
    assert refused(c.apply(batch(spark, ("schema", "s", "disable", None, None), ("schema", "old", "update", 2, "{}"), ("dataset", "d", "create", None, "{}")), partly=True)) == {("schema", "s"): None, ("schema", "old"): "schema old is locked", ("dataset", "d"): None}
    assert c.get("schema", "s") is None and c.get("dataset", "d")["version"] == 2 and c.get("schema", "old")["version"] == 2
    assert [r.action for r in c.audit("schema", "s").collect()] == ["create", "disable"] and c.apply(first.where("false")).count() == 0


def test_jobs_of_a_batch_dont_depend_on_its_size(spark, tmp_path):
    jobs = []
    for n in (10, 20_000):
        c = catalog.Catalog(spark, str(tmp_path / str(n)))
        rows = spark.range(n).select(F.lit("x").alias("kind"), F.col("id").cast("string").alias("name"), F.lit("create").alias("action"), F.lit(None).cast("int").alias("based_on"), F.lit("{}").alias("doc"))
        spark.sparkContext.setJobGroup(f"batch {n}", "")
        c.apply(rows)
        c.apply(rows.withColumn("action", F.lit("disable")))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"batch {n}")))
        spark.sparkContext._jsc.clearJobGroup()
        assert c.entities().where("disabled").count() == n
    assert jobs[1] <= jobs[0] + 6


def test_writers_at_once_lose_no_change(spark, tmp_path):
    c = catalog.Catalog(spark, str(tmp_path / "c"))
    threads = [threading.Thread(target=lambda i=i: catalog.Catalog(spark, c.path).create("schema", f"s{i}", {"i": i})) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.name for r in c.entities().collect()) == ["s0", "s1", "s2", "s3"]
    assert c._last() == 4 and c._commit(spark.createDataFrame([("k", "n", 1, 1, "create", False, False, "{}")], catalog.SCHEMA.replace(", at timestamp", "")), 2) is False


def test_references_over_several_steps(spark, tmp_path):
    c = catalog.Catalog(spark, str(tmp_path / "c"))
    c.apply(batch(spark, ("schema", "s", "create", None, "{}"), ("mappingTable", "m", "create", None, '{"schemaName":"s","schemaVersion":1}'), ("dataset", "d", "create", None, '{"schemaName":"t","schemaVersion":4,"conformance":[{"mappingTable":"m","mappingTableVersion":1},{"outputColumn":"x"}]}')))
    edges = {("dataset", "d", 1, "schema", "t", 4), ("dataset", "d", 1, "mappingTable", "m", 1), ("mappingTable", "m", 1, "schema", "s", 1)}
    assert {tuple(r) for r in c.references().collect()} == edges
    assert {tuple(r) for r in c.reachable().collect()} == edges | {("dataset", "d", 1, "schema", "s", 1)}


def test_migrations(spark, tmp_path):
    steps = [
        M.Migration(1, {"a": lambda d: F.when(F.variant_get(d, "$.n", "int") != 2, M.put(d, "n", F.variant_get(d, "$.n", "int") + 1))}, added=("c",)),
        M.Migration(2, {"z": lambda d: M.renamed(M.renamed(d, "n", "m"), "none", "x")}, renames={"a": "z"}, dropped=("b",)),
    ]
    docs = M.Documents(spark, str(tmp_path / "d"), ["a", "b"], steps)
    docs.insert("a", spark.createDataFrame([("1", '{"n":1,"l":[{"q":1},{"q":2}]}'), ("2", '{"n":2}'), ("3", '{"n":3,"l":null}')], "id string, j string").select("id", F.parse_json("j").alias("doc")))
    one = M.Documents(spark, str(tmp_path / "d"), ["a", "b"], steps[:1])
    assert docs.version() == 0 and docs.collections(2) == ["z", "c"]
    docs.migrate(2)
    found = {r.id: r.j for r in docs.read("z").select("id", F.to_json("doc").alias("j")).collect()}
    assert found == {"1": '{"l":[{"q":1},{"q":2}],"m":2}', "3": '{"l":null,"m":4}'} and docs.read("c").count() == 0 and docs.read("a", 0).count() == 3
    assert docs.version() == 2 and docs.migrate(2) is None
    with pytest.raises(ValueError, match="can't go back"):
        docs.migrate(1)
    with pytest.raises(KeyError):
        docs.read("a")
    with pytest.raises(ValueError, match="no version 2"):
        one.collections(2)
    each = spark.range(1).select(F.parse_json(F.lit('{"l":[{"q":1},{"q":2}]}')).alias("d")).select(F.to_json(M.each(F.col("d"), "l", lambda e: M.put(M.without(e, "q"), "r", F.variant_get(e, "$.q", "int") * 2))), F.to_json(M.each(F.col("d"), "none", lambda e: e)))
    assert tuple(each.first()) == ('{"l":[{"r":2},{"r":4}]}', '{"l":[{"q":1},{"q":2}]}')


@pytest.mark.parametrize("steps,said", [
    ([M.Migration(2)], "one migration for each version"),
    ([M.Migration(1, {"none": lambda d: d})], "would change none"),
    ([M.Migration(1, dropped=("none",))], "would drop none"),
    ([M.Migration(1, renames={"a": "b"})], "makes b"),
])
def test_migrations_that_dont_fit(spark, tmp_path, steps, said):
    with pytest.raises(ValueError, match=said):
        M.Documents(spark, str(tmp_path / "d"), ["a", "b"], steps).migrate(1)


@pytest.mark.parametrize("for_run", [False, True])
def test_findings_of_many_datasets_are_those_of_each(spark, for_run):
    rng = random.Random(9)
    definitions = [catalog.Property("a", "Mandatory"), catalog.Property("b", "Mandatory", allow_run=True), catalog.Property("c", "Recommended", ("x", "y")), catalog.Property("d", disabled=True), catalog.Property("e", allowed=())]
    datasets = {n: {k: rng.choice(["x", "z", ""]) for k in rng.sample("abcdeq", rng.randrange(6))} for n in range(40)}
    rows = [(n, k, v) for n, given in datasets.items() for k, v in (given.items() or [(None, None)])]
    found = catalog.property_findings(spark.createDataFrame(rows, "dataset int, name string, value string"), definitions, for_run).collect()
    for n, given in datasets.items():
        want = catalog.check_properties(given, definitions, for_run)
        pairs = [(k, "error", t) for k, texts in want.errors.items() for t in texts] + [(k, "warning", t) for k, texts in want.warnings.items() for t in texts]
        assert sorted((r.property, r.level, r.said) for r in found if r.dataset == n) == sorted(pairs)
