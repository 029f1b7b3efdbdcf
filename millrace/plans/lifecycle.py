"""What happened to runs: an append-only table of events, from which the state of every run is read.

A run is registered when a job starts; each change of its status, each checkpoint and what it was measured by at the end is one more row. An event is
a small file that the driver writes without a Spark job; ``compact`` puts those that there are into one table, so their number stays small.
Nothing is rewritten. Numbers of runs, and of versions in the catalog, are claimed by files that only one writer can make, so two jobs that start
at once get different ones.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import layout

from . import runs

EVENTS = "dataset string, version int, run_id int, unique_id string, event long, status string, started string, info_date date, report_version int, measures string, at timestamp"


@dataclass(frozen=True)
class Run:
    dataset: str
    version: int
    run_id: int
    unique_id: str
    started: str
    info_date: dt.date
    report_version: int | None = None


@dataclass
class RunLog:
    spark: SparkSession
    path: str

    def events(self) -> DataFrame:
        found = self.spark.createDataFrame([], EVENTS)
        if layout.children(self.spark, f"{self.path}/events"):
            found = self.spark.read.schema(EVENTS).json(f"{self.path}/events")
        if layout.children(self.spark, f"{self.path}/compacted"):  # an event may be in both for a moment
            found = found.unionByName(self.spark.read.schema(EVENTS).option("recursiveFileLookup", "true").parquet(f"{self.path}/compacted")).distinct()
        return found

    def compact(self) -> int:
        """Put the events that are files of their own into the table, and say how many. Readers see each event all the time."""
        names = layout.children(self.spark, f"{self.path}/events")
        if not names:
            return 0
        staged, key = f"{self.path}/_staging/{uuid.uuid4().hex}", uuid.uuid4().hex
        self.spark.read.schema(EVENTS).json([f"{self.path}/events/{n}" for n in names]).coalesce(1).write.parquet(staged)
        layout.move(self.spark, staged, f"{self.path}/compacted/{key}")
        for name in names:
            layout.delete(self.spark, f"{self.path}/events/{name}")
        return len(names)

    def start(self, dataset: str, version: int, info_date: dt.date, report_version: int | None = None) -> Run:
        """A new run, with the next number of its dataset and version and an id of its own."""
        claims = f"{self.path}/numbers/{dataset}/{version}"
        number = max((int(n) for n in layout.children(self.spark, claims)), default=0) + 1
        while not layout.claim(self.spark, f"{claims}/{number}"):
            number += 1
        run = Run(dataset, version, number, uuid.uuid4().hex, dt.datetime.now(dt.UTC).strftime("%d-%m-%Y %H:%M:%S +0000"), info_date, report_version)
        self.add(run, 0, "running")
        return run

    def add(self, run: Run, event: int, status: str, measures: Mapping[str, Any] | None = None, report_version: int | None = None) -> None:
        """One more event of a run; a later one has a larger number."""
        row = (run.dataset, run.version, run.run_id, run.unique_id, event, status, run.started, run.info_date.isoformat(), report_version or run.report_version, json.dumps(measures, sort_keys=True) if measures else None, dt.datetime.now(dt.UTC).isoformat())
        names = [f.split()[0] for f in EVENTS.split(", ")]
        layout.write_text(self.spark, f"{self.path}/events/{run.unique_id}-{event}-{status}.json", json.dumps(dict(zip(names, row, strict=True))) + "\n")

    def runs(self) -> DataFrame:
        """The state of every run, as the queries in ``runs`` take it, with the counts and error numbers of its measures."""
        last = runs.latest(self.events(), ["dataset", "version", "run_id"], ["event"])
        def number(path: str):
            return F.get_json_object("measures", f"$.{path}").cast("long")

        return last.select(
            "dataset", "version", "run_id", "unique_id", "started", "status", "info_date", "report_version",
            number("source_records").alias("source_records"), number("raw_records").alias("raw_records"), number("records").alias("records"), number("errors").alias("errors"), "measures",
        )

    def checkpoints(self) -> DataFrame:
        """Rows (dataset, version, run_id, checkpoint, control, value) of the checkpoints of every run's last measures."""
        kind = "array<struct<name:string,`order`:int,controls:array<struct<controlName:string,controlType:string,controlCol:string,controlValue:string>>>>"
        last = runs.latest(self.events().where("measures IS NOT NULL"), ["dataset", "version", "run_id"], ["event"])
        points = last.select("dataset", "version", "run_id", F.explode(F.from_json(F.get_json_object("measures", "$.checkpoints"), kind)).alias("p"))
        each = points.select("dataset", "version", "run_id", F.col("p.name").alias("checkpoint"), F.col("p.order").alias("order"), F.explode("p.controls").alias("c"))
        return each.select("dataset", "version", "run_id", "checkpoint", "order", F.col("c.controlName").alias("control"), F.col("c.controlValue").alias("value"))


def counts(checkpoints: Sequence[Mapping[str, Any]]) -> dict[str, int]:
    """Source and raw counts of a run's checkpoints, by their names, for its state."""
    out = {}
    for point in checkpoints:
        for c in point["controls"]:
            if c["controlType"].lower().removeprefix("controltype.") == "count" and point["name"].lower() in ("source", "raw"):
                out[f"{point['name'].lower()}_records"] = int(c["controlValue"])
    return out
