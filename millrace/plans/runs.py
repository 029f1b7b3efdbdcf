"""Questions about runs of jobs, as plans over a table of runs.

Columns: dataset, version, run_id, unique_id, started (``dd-MM-yyyy HH:mm:ss Z`` text), status, and for monitoring info_date,
report_version and counters. "Latest of each group" is an aggregate of a struct, which is combined before the shuffle; no
group is sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("running", "stageSucceeded", "allSucceeded", "failed")
STARTED = "dd-MM-yyyy HH:mm:ss Z"


def started_at(text: str = "started") -> Column:
    return F.to_timestamp(text, STARTED)


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each group that is largest by ``order``; ties are decided by the other columns."""
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    best = F.max(F.struct(*order, *rest)).alias("__best")
    return rows.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*rows.columns)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The latest run of the latest version of each dataset."""
    return latest(runs, ["dataset"], ["version", "run_id"])


def latest_of_each(runs: DataFrame, dataset: str | None = None, version: int | None = None, start_date: Column | None = None, app_id: str | None = None, unique_id: str | None = None, offset: int = 0, limit: int = 20) -> DataFrame:
    """The latest run of each dataset and version, by name and version.

    Dataset and version may be given with any other filter; of start date, application and unique id at most one.
    """
    if sum(x is not None for x in (start_date, app_id, unique_id)) > 1:
        raise ValueError("give one of start_date, app_id and unique_id")
    for column, value in (("dataset", dataset), ("version", version), ("app_id", app_id), ("unique_id", unique_id)):
        if value is not None:
            runs = runs.where(F.col(column) == value)
    if start_date is not None:
        runs = runs.where(F.to_date(started_at()) >= start_date)
    return page(latest(runs, ["dataset", "version"], ["run_id"]), ["dataset", "version"], offset, limit)


def grouped_by_dataset(runs: DataFrame) -> DataFrame:
    """Runs of each dataset: how many, and when the last one started."""
    return runs.groupBy("dataset").agg(F.count("*").alias("runs"), F.date_format(F.max(started_at()), "dd-MM-yyyy HH:mm:ss").alias("latest_start"))


def grouped_by_version(runs: DataFrame, dataset: str) -> DataFrame:
    """Runs of each version of a dataset, latest version first."""
    chosen = runs.where(F.col("dataset") == dataset).groupBy("dataset", "version")
    return chosen.agg(F.count("*").alias("runs"), F.date_format(F.max(started_at()), "dd-MM-yyyy HH:mm:ss").alias("latest_start")).orderBy(F.desc("version"))


def statuses_on(runs: DataFrame, day: Column, errors: str = "errors") -> DataFrame:
    """One row: runs started on a day by status, and those that succeeded with errors."""
    today = F.to_date(started_at()) == day
    counts = [F.count_if(today & (F.col("status") == s)).alias(s) for s in STATUSES]
    failed = today & (F.col("status") == "allSucceeded") & (F.coalesce(F.col(errors), F.lit(0)) > 0)
    return runs.agg(F.count_if(today).alias("total"), *counts, F.count_if(failed).alias("succeeded_with_errors"))


def monitoring(runs: DataFrame, dataset: str, first: Column, last: Column, limit: int | None = None) -> DataFrame:
    """The latest attempt of each report (info date and version) of a dataset between two dates, with the number of attempts."""
    chosen = runs.where((F.col("dataset") == dataset) & F.col("info_date").between(first, last))
    rest = [c for c in runs.columns if c not in ("info_date", "report_version", "run_id")]
    best = chosen.groupBy("info_date", "report_version").agg(F.max(F.struct("run_id", *rest)).alias("__best"), F.count("*").alias("attempts"))
    found = best.select("info_date", "report_version", "__best.*", "attempts").orderBy("info_date", "report_version")
    return found if limit is None else found.limit(limit)


def totals(points: DataFrame, counters: Sequence[str], raw: str = "raw_records", source: str = "source_records") -> DataFrame:
    """Sums over monitoring points by status; the raw count falls back to the source's."""
    sums = [F.sum(F.coalesce(F.col(raw), F.col(source)) if c == raw else F.col(c)).alias(c) for c in counters]
    return points.groupBy("status").agg(F.count("*").alias("reports"), *sums)


def zombies(runs: DataFrame, now: Column, after: str = "1 day") -> DataFrame:
    """Runs that have been running for too long."""
    return runs.where((F.col("status") == "running") & (started_at() < now - F.expr(f"INTERVAL {after}")))


def page(rows: DataFrame, keys: Sequence[str | Column], offset: int = 0, limit: int = 20) -> DataFrame:
    """A page of sorted rows."""
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit can't be negative")
    return rows.orderBy(*keys).offset(offset).limit(limit)


def search(rows: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column contains a text in any case."""
    quoted = text.replace("\\E", "\\E\\\\E\\Q")
    return rows.where(F.col(column).rlike(f"(?i)\\Q{quoted}\\E"))


def last_by(rows: DataFrame, column: str) -> DataFrame:
    """The one row with the largest value."""
    return rows.orderBy(F.desc(column)).limit(1)


def versions(entities: DataFrame) -> DataFrame:
    """Of versioned entities (name, version, disabled, doc): the latest version that isn't disabled, with its document."""
    return entities.where(~F.col("disabled")).groupBy("name").agg(F.max("version").alias("version"), F.max_by("doc", "version").alias("doc"))


def status_of_names(entities: DataFrame) -> DataFrame:
    """Names with all their versions, and whether all are disabled."""
    return entities.groupBy("name").agg(F.sort_array(F.collect_set("version")).alias("versions"), F.count_if(~F.col("disabled")).alias("enabled"), F.bool_and("disabled").alias("is_disabled"))


def names(entities: DataFrame) -> DataFrame:
    return entities.select("name").distinct()


def count_names(entities: DataFrame) -> DataFrame:
    return entities.agg(F.count_distinct("name").alias("names"))


def property_statistics(datasets: DataFrame, definitions: DataFrame) -> DataFrame:
    """For each property definition (name, essentiality): datasets (name, properties map) that lack it."""
    held = datasets.select(F.explode(F.map_keys("properties")).alias("name")).groupBy("name").agg(F.count("*").alias("held"))
    total = datasets.agg(F.count("*").alias("datasets"))
    return definitions.join(held, "name", "left").crossJoin(F.broadcast(total)).select("name", "essentiality", (F.col("datasets") - F.coalesce("held", F.lit(0))).alias("missing"))


def landing_totals(statistics: DataFrame) -> DataFrame:
    """Sums of missing mandatory and recommended properties."""
    return statistics.agg(*(F.coalesce(F.sum(F.when(F.col("essentiality") == e, F.col("missing"))), F.lit(0)).alias(f"missing_{e.lower()}") for e in ("Mandatory", "Recommended")))
