"""Control measures: counts and sums at checkpoints, their file next to the data, and the checks on them."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions import errors
from millrace.sources import layout

KINDS = ("count", "distinctCount", "aggregatedTotal", "absAggregatedTotal")
INFO_FILE = "_INFO"


@dataclass(frozen=True)
class Control:
    name: str
    kind: str
    column: str = "*"

    def expression(self) -> Column:
        of = F.col(self.column) if self.column != "*" else F.lit(1)
        numeric = of.cast("decimal(38,10)")
        return {
            "count": lambda: F.count("*"),
            "distinctCount": lambda: F.count_distinct(of),
            "aggregatedTotal": lambda: F.coalesce(F.sum(numeric), F.lit(0)),
            "absAggregatedTotal": lambda: F.coalesce(F.sum(F.abs(numeric)), F.lit(0)),
        }[self.kind]()


def measured(df: DataFrame, controls: Sequence[Control]) -> DataFrame:
    """One row with all controls of a frame, in one pass."""
    return df.agg(*(c.expression().alias(c.name) for c in controls))


def observed(df: DataFrame, name: str, controls: Sequence[Control]) -> tuple[DataFrame, Observation]:
    """``df`` that measures its controls when it is written, without a pass of its own; distinct counts can't be taken so."""
    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("__rows"), *(c.expression().alias(c.name) for c in controls if c.kind != "distinctCount")), seen


@dataclass
class Measures:
    """Checkpoints of a run and its metadata; the JSON form is that of ``_INFO`` files."""

    metadata: dict[str, Any] = field(default_factory=dict)
    controls: tuple[Control, ...] = (Control("recordCount", "count"),)
    checkpoints: list[dict[str, Any]] = field(default_factory=list)
    listeners: list = field(default_factory=list)
    #: Checkpoints that are measured when what they observe is written: name, controls, observation, the frame.
    pending: list[tuple[str, list[Control], Observation, DataFrame]] = field(default_factory=list)

    def _there(self, df: DataFrame) -> list[Control]:
        """Controls whose column a frame has."""
        return [c for c in self.controls if c.column == "*" or c.column in df.columns]

    def checkpoint(self, name: str, df: DataFrame) -> dict[str, Any]:
        """Measure a frame in a pass of its own; controls whose column it doesn't have are left out."""
        there = self._there(df)
        return self.add(name, there, measured(df, there).first().asDict())

    def finish(self, name: str, df: DataFrame, source: DataFrame | None = None) -> dict[str, int]:
        """Checkpoint of written data and its error statistics, in one pass; ``source`` is the frame that was written.

        Distinct counts of observed checkpoints come from this pass as well, for columns that are in what was written as they were there.
        """
        there = self._there(df)
        stats = errors.counted() if errors.ERRORS in df.columns else {"records": F.count("*")}
        row = df.agg(*(c.expression().alias(f"c{i}") for i, c in enumerate(there)), *(v.alias(k) for k, v in stats.items())).first()
        values = {c.name: row[f"c{i}"] for i, c in enumerate(there)}
        self.settle(source, {c.column: values[c.name] for c in there if c.kind == "distinctCount"})
        check_not_empty(row["records"], self)
        self.add(name, there, values)
        return {"records": 0, "failed": 0, "succeeded": 0, "errors": 0} | {k: row[k] for k in stats}

    def observe(self, name: str, df: DataFrame) -> DataFrame:
        """The frame with a checkpoint that measures itself in the pass that writes it; ``settle`` adds it then. No pass is made before."""
        there = self._there(df)
        out, seen = observed(df, f"{len(self.checkpoints) + len(self.pending)} {name}", there)
        self.pending.append((name, there, seen, df))
        return out

    def settle(self, source: DataFrame | None = None, distinct: dict[str, Any] | None = None) -> None:
        """Add the observed checkpoints, in order, after the write.

        ``distinct`` has distinct counts of columns of ``source``. They hold for a checkpoint too if the column is the same attribute there: rows are
        never dropped or repeated between. Others, of columns that were changed or dropped since, take a pass of their own over what they observe.
        """
        for name, there, seen, df in self.pending:
            values = dict(seen.get)
            apart = []
            for c in there:
                if c.kind == "distinctCount":
                    if source is not None and c.column in (distinct or {}) and _same(df, source, c.column):
                        values[c.name] = distinct[c.column]
                    else:
                        apart.append(c)
            if apart:
                values |= measured(df, apart).first().asDict()
            self.add(name, there, values)
        self.pending = []

    def add(self, name: str, there: list[Control], row: dict[str, Any]) -> dict[str, Any]:
        """Failing listeners are only warned about."""
        point = {"name": name, "order": len(self.checkpoints) + 1, "controls": [{"controlName": c.name, "controlType": c.kind, "controlCol": c.column, "controlValue": _text(row[c.name])} for c in there]}
        self.checkpoints.append(point)
        for listener in self.listeners:
            try:
                listener(self)
            except Exception as e:  # noqa: BLE001 a listener must not end the job
                warnings.warn(f"a checkpoint listener failed: {e}", stacklevel=2)
        return point

    def to_json(self) -> str:
        return json.dumps({"metadata": self.metadata, "checkpoints": self.checkpoints}, indent=2, sort_keys=True)

    @classmethod
    def from_json(cls, text: str, **more: Any) -> Measures:
        doc = json.loads(text)
        return cls(metadata=doc.get("metadata", {}), checkpoints=doc.get("checkpoints", []), **more)

    def write(self, spark: SparkSession, folder: str) -> None:
        layout.write_text(spark, f"{folder.rstrip('/')}/{INFO_FILE}", self.to_json())

    @classmethod
    def read(cls, spark: SparkSession, folder: str, **more: Any) -> Measures:
        return cls.from_json(layout.read_text(spark, f"{folder.rstrip('/')}/{INFO_FILE}"), **more)

    def count(self, checkpoint: str) -> int | None:
        """The record count of a checkpoint."""
        for point in self.checkpoints:
            if point["name"].lower() == checkpoint.lower():
                for c in point["controls"]:
                    if c["controlType"].lower().removeprefix("controltype.") == "count":
                        return int(c["controlValue"])
        return None


def _attribute(df: DataFrame, column: str) -> int | None:
    """What the optimizer knows a column by: projections, joins and filters that let it be keep it."""
    output = df._jdf.queryExecution().analyzed().output()
    found = [a for a in (output.apply(i) for i in range(output.size())) if a.name() == column]
    return found[0].exprId().id() if len(found) == 1 else None


def _same(before: DataFrame, after: DataFrame, column: str) -> bool:
    one, other = _attribute(before, column), _attribute(after, column)
    return one is not None and one == other


def _text(value: Any) -> str:
    text = format(value, "f") if not isinstance(value, int) else str(value)
    return text.rstrip("0").rstrip(".") if "." in text else text


def check_counts(measures: Measures, how: str = "strict", first: str = "Source", second: str = "Raw") -> None:
    """Compare the counts of the first two checkpoints: ``strict`` fails, ``warning`` warns, ``none`` doesn't look."""
    if how not in ("strict", "warning", "none"):
        raise ValueError(f"validation is strict, warning or none, not {how}")
    if how == "none":
        return
    a, b = measures.count(first), measures.count(second)
    problem = f"there is no count at {first if a is None else second}" if a is None or b is None else f"{a} records at {first}, {b} at {second}" if a != b else None
    if problem and how == "strict":
        raise ValueError(problem)
    if problem:
        warnings.warn(problem, stacklevel=2)


def check_not_empty(found: DataFrame | int, measures: Measures) -> None:
    """No output (a frame, or a number of records) is an error, unless every count so far is 0."""
    counts = [int(c["controlValue"]) for p in measures.checkpoints for c in p["controls"] if c["controlType"].lower().removeprefix("controltype.") == "count"]
    empty = found == 0 if isinstance(found, int) else found.isEmpty()
    if empty and (not counts or any(counts)):
        raise ValueError("there are no output records")


def unequal(checkpoints: DataFrame) -> DataFrame:
    """Of rows (run, checkpoint, control, value): runs and controls whose values differ between checkpoints."""
    return checkpoints.groupBy("run", "control").agg(F.min("value").alias("least"), F.max("value").alias("most")).where("least <> most").select("run", "control")
