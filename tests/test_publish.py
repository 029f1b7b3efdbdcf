"""Versions are published whole or not at all, each by one job; controls take no pass before the write."""

from __future__ import annotations

import datetime as dt
import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import rules as R
from millrace.plans import conform as C
from millrace.plans import job as J
from millrace.plans import measures as M
from millrace.plans.lifecycle import RunLog
from millrace.sources import layout, publish

DAY = dt.date(2024, 5, 6)


def job(tmp_path, **more):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])
    return J.Job("d", 1, DAY, schema, f"{tmp_path}/raw", f"{tmp_path}/std", f"{tmp_path}/out", rules=[R.Uppercase(order=1, input="s", output="loud", checkpoint=True)], **more)


@pytest.fixture
def raw(spark, tmp_path):
    spark.range(50).select(F.col("id").alias("k"), F.concat(F.lit("s"), F.col("id") % 7).alias("s")).write.parquet(layout.raw_path(f"{tmp_path}/raw", DAY, 1))


def test_jobs_at_once_get_versions_of_their_own(spark, tmp_path, raw):
    J.standardize(spark, job(tmp_path))
    done = []

    def run(session):
        J.conform(session, job(tmp_path))
        done.append(1)

    threads = [threading.Thread(target=run, args=(spark.newSession(),)) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 3 and layout.children(spark, f"{tmp_path}/out/info_date={DAY}") == [f"info_version={v}" for v in (1, 2, 3)]
    found = spark.read.parquet(f"{tmp_path}/out").groupBy("info_version").count().collect()
    assert sorted((int(r.info_version), r["count"]) for r in found) == [(1, 50), (2, 50), (3, 50)]
    assert layout.children(spark, f"{tmp_path}/out/{publish.STAGING}") == [] and M.Measures.read(spark, layout.publish_path(f"{tmp_path}/out", DAY, 2)).count("Conformance - End") == 50


def test_a_failed_job_leaves_nothing(spark, tmp_path, raw):
    J.standardize(spark, job(tmp_path))
    broken = job(tmp_path)
    broken.rules = [R.Custom(order=1, output="", change=lambda df: df.withColumn("x", F.raise_error(F.lit("no"))))]
    with pytest.raises(Exception, match="no"):
        J.conform(spark, broken)
    assert not layout.exists(spark, layout.publish_path(f"{tmp_path}/out", DAY, 1)) and layout.children(spark, f"{tmp_path}/out/{publish.STAGING}") == []
    J.conform(spark, job(tmp_path))
    assert layout.children(spark, f"{tmp_path}/out/info_date={DAY}") == ["info_version=1"]
    with pytest.raises(publish.Taken, match="already exists"):
        J.conform(spark, job(tmp_path, report_version=1))
    with pytest.raises(ValueError, match="begin with 1"):
        J.conform(spark, job(tmp_path, report_version=-2))


def test_what_a_killed_job_leaves_is_hidden_and_recovered(spark, tmp_path):
    base = f"{tmp_path}/out"
    killed = publish.begin(spark, base, DAY, prefix="p")
    spark.range(5).write.parquet(killed.staged)
    alive = publish.begin(spark, base, DAY, prefix="p")
    spark.range(3).write.parquet(alive.staged)
    assert (killed.version, alive.version) == (1, 2) and layout.children(spark, f"{base}/p") == []
    with pytest.raises(publish.Taken):
        publish.begin(spark, base, DAY, 1, "p")
    old = time.time() - 7200
    for folder, _, names in os.walk(killed.staged):
        for at in (folder, *(f"{folder}/{n}" for n in names)):
            os.utime(at, (old, old))
    os.utime(killed.claim, (old, old))
    os.utime(alive.claim, (old, old))  # claimed long ago, but still writing
    assert publish.recover(spark, base, dt.timedelta(hours=1), "p") == sorted([killed.staged.rpartition("/")[2], f"{DAY} 1"])
    assert alive.commit() == layout.publish_path(base, DAY, 2, "p") and spark.read.parquet(f"{base}/p").count() == 3
    assert publish.begin(spark, base, DAY, 1, "p").version == 1 and publish.recover(spark, f"{tmp_path}/none", dt.timedelta(0)) == []


def test_distinct_counts_take_no_pass_before_the_write(spark, tmp_path):
    controls = (M.Control("n", "count"), M.Control("same", "distinctCount", "s"), M.Control("changed", "distinctCount", "t"), M.Control("gone", "distinctCount", "u"))
    df = spark.range(40).select("id", (F.col("id") % 7).alias("s"), (F.col("id") % 5).alias("t"), (F.col("id") % 3).alias("u"))
    told = M.Measures(controls=controls)
    rules = [R.Literal(order=1, output="one", text="1", checkpoint=True), R.Literal(order=2, output="t", text="x"), R.Drop(order=3, output="u"), R.Literal(order=4, output="two", text="2", checkpoint=True)]
    spark.sparkContext.setJobGroup("before", "plans only")
    out = C.conform(df, rules, options=C.Options(allow_original_changes=True, on_checkpoint=told.observe))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("before")) == []
    spark.sparkContext.setJobGroup("write", "")
    out.write.parquet(f"{tmp_path}/x")
    spark.sparkContext.setJobGroup("finish", "")
    stats = told.finish("End", spark.read.parquet(f"{tmp_path}/x"), out)
    spark.sparkContext._jsc.clearJobGroup()
    values = {p["name"]: {c["controlName"]: c["controlValue"] for c in p["controls"]} for p in told.checkpoints}
    assert stats["records"] == 40 and values["End"] == {"n": "40", "same": "7", "changed": "1"}
    assert values["1 LiteralConformanceRule before"] == {"n": "40", "same": "7", "changed": "5", "gone": "3"}
    assert values["4 LiteralConformanceRule after"] == {"n": "40", "same": "7", "changed": "1"}
    assert M._same(df, out, "s") and not M._same(df, out, "t") and not M._same(df, out, "u")


def test_events_are_compacted(spark, tmp_path):
    log = RunLog(spark, f"{tmp_path}/log")
    runs = [log.start("d", 1, DAY) for _ in range(3)]
    log.add(runs[0], 5, "allSucceeded", {"records": 7, "checkpoints": []})
    before = sorted(map(repr, log.events().collect()))
    assert log.compact() == 4 and layout.children(spark, f"{tmp_path}/log/events") == [] and sorted(map(repr, log.events().collect())) == before
    log.add(runs[1], 6, "failed")
    assert [(r.run_id, r.status, r.records) for r in log.runs().orderBy("run_id").collect()] == [(1, "allSucceeded", 7), (2, "failed", None), (3, "running", None)]
    assert log.compact() == 1 and log.compact() == 0 and log.events().count() == 5 and log.start("d", 1, DAY).run_id == 4
