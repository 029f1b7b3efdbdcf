"""Versioned documents (datasets, schemas, mapping tables, properties) in an append-only table, and what is checked about them.

Every change appends rows; the state of an entity is its latest row for each version. Nothing is rewritten, so readers need no locks and history is
kept. Changes come in commits, of one change or of a whole batch, which are numbered in a row: rows are written aside, then the next number is claimed by a file
that only one writer can make, and the rows are moved to their place with one rename. A writer whose state is older than the last commit looks again.

A batch is checked against the state by one join and committed as one, in a number of jobs that doesn't depend on its size. What refers to what is
a table of edges taken from the documents.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import paths
from millrace.operators import rules as R
from millrace.sources import layout

from . import runs

SCHEMA = "kind string, name string, version int, change long, action string, disabled boolean, locked boolean, doc string, at timestamp"
#: Columns of a batch of changes; ``based_on`` is the version that an update was made from.
CHANGES = "kind string, name string, action string, based_on int, doc string"
ACTIONS = ("create", "update", "disable", "enable", "lock", "unlock")
#: Users of an entity that a refusal names, and seconds that a writer waits for a commit that was claimed.
NAMED, PATIENCE = 20, 30


class Conflict(ValueError):
    """A change that was made against an older state."""


@dataclass
class Catalog:
    spark: SparkSession
    path: str

    def history(self) -> DataFrame:
        """All changes."""
        if not layout.children(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")

    def entities(self) -> DataFrame:
        """The state of every version of every entity."""
        return runs.latest(self.history(), ["kind", "name", "version"], ["change"])

    def get(self, kind: str, name: str, version: int | None = None) -> dict[str, Any] | None:
        """A document, by default of the latest version that isn't disabled."""
        rows = self.entities().where((F.col("kind") == kind) & (F.col("name") == name) & ~F.col("disabled"))
        rows = rows.where(F.col("version") == version) if version is not None else rows
        row = runs.last_by(rows, "version").first()
        return None if row is None else {**json.loads(row.doc), "name": name, "version": row.version}

    def _state(self, kind: str, name: str) -> tuple[int, int, bool, bool]:
        """Latest version, latest change, whether it is locked, whether all is disabled."""
        rows = self.entities().where((F.col("kind") == kind) & (F.col("name") == name))
        row = rows.agg(F.max("version").alias("v"), F.max("change").alias("c"), F.bool_or("locked").alias("l"), F.bool_and("disabled").alias("d")).first()
        return row.v or 0, row.c or 0, bool(row.l), bool(row.d)

    def _last(self) -> int:
        """The number of the last commit. One that is claimed is waited for, as a state without it would be an old one."""
        until = time.time() + PATIENCE
        while True:
            done, claimed = (max((int(n) for n in layout.children(self.spark, f"{self.path}/{what}")), default=0) for what in ("commits", "_log"))
            if claimed <= done:
                return done
            if time.time() > until:
                raise Conflict(f"commit {claimed} of {self.path} was begun and isn't done")
            time.sleep(0.2)

    def _commit(self, rows: DataFrame, seen: int) -> bool:
        """Add rows as the commit after ``seen``; False if there is one by now."""
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        rows.withColumn("at", F.current_timestamp()).select(*(f.split()[0] for f in SCHEMA.split(", "))).write.parquet(staged)
        if not layout.claim(self.spark, f"{self.path}/_log/{seen + 1}"):
            layout.delete(self.spark, staged)
            return False
        layout.move(self.spark, staged, f"{self.path}/commits/{seen + 1}")
        return True

    def _change(self, rows: Callable[[], list[tuple]]) -> None:
        """Commit rows that are made from the state, again from the next one if another writer was faster."""
        while True:
            seen = self._last()
            if self._commit(self.spark.createDataFrame(rows(), SCHEMA.replace(", at timestamp", "")).coalesce(1), seen):
                return

    def create(self, kind: str, name: str, doc: Mapping[str, Any]) -> int:
        """A new entity, or a new version of a disabled one."""
        made: list[int] = []

        def rows() -> list[tuple]:
            version, change, locked, disabled = self._state(kind, name)
            if version and not disabled:
                raise Conflict(f"{kind} {name} exists")
            made.append(version + 1)
            return [(kind, name, version + 1, change + 1, "create", False, locked, json.dumps(doc, sort_keys=True))]

        self._change(rows)
        return made[-1]

    def update(self, kind: str, name: str, based_on: int, doc: Mapping[str, Any]) -> int:
        """A new version of an entity, made from its latest one."""
        def rows() -> list[tuple]:
            version, change, locked, disabled = self._state(kind, name)
            if not version or disabled:
                raise KeyError(f"there is no {kind} {name}")
            if locked:
                raise Conflict(f"{kind} {name} is locked")
            if based_on != version:
                raise Conflict(f"{kind} {name} is at version {version}, not {based_on}")
            return [(kind, name, version + 1, change + 1, "update", False, False, json.dumps(doc, sort_keys=True))]

        self._change(rows)
        return based_on + 1

    def _mark(self, kind: str, name: str, action: str, version: int | None = None, **flags: bool) -> None:
        def rows() -> list[tuple]:
            versions = self.entities().where((F.col("kind") == kind) & (F.col("name") == name))
            change = self._state(kind, name)[1]
            chosen = versions if version is None else versions.where(F.col("version") == version)
            return [(kind, name, r.version, change + 1, action, flags.get("disabled", r.disabled), flags.get("locked", r.locked), r.doc) for r in chosen.collect()]

        self._change(rows)

    def disable(self, kind: str, name: str, version: int | None = None) -> None:
        """Disable an entity that nothing enabled uses."""
        if users := self.used_in(kind, name, version):
            raise Conflict(f"{kind} {name} is used by {', '.join(f'{k} {n} {v}' for k, n, v in users)}")
        self._mark(kind, name, "disable", version, disabled=True)

    def enable(self, kind: str, name: str, version: int | None = None) -> None:
        self._mark(kind, name, "enable", version, disabled=False)

    def lock(self, kind: str, name: str, locked: bool = True) -> None:
        self._mark(kind, name, "lock" if locked else "unlock", locked=locked)

    def references(self) -> DataFrame:
        """Edges (kind, name, version) to (ref_kind, ref_name, ref_version): schemas and mapping tables that enabled documents name."""
        doc = lambda path: F.get_json_object("doc", f"$.{path}")
        rules = F.from_json(doc("conformance"), "array<struct<mappingTable:string,mappingTableVersion:int>>")
        tables = F.transform(F.coalesce(rules, F.array().cast("array<struct<mappingTable:string,mappingTableVersion:int>>")), lambda r: F.struct(F.lit("mappingTable").alias("ref_kind"), r["mappingTable"].alias("ref_name"), r["mappingTableVersion"].alias("ref_version")))
        schema = F.array(F.struct(F.lit("schema").alias("ref_kind"), doc("schemaName").alias("ref_name"), doc("schemaVersion").cast("int").alias("ref_version")))
        edges = self.entities().where(~F.col("disabled")).select("kind", "name", "version", F.inline(F.concat(schema, tables)))
        return edges.where("ref_name IS NOT NULL").distinct()

    def reachable(self) -> DataFrame:
        """Edges and what they lead to, over any number of steps; as many joins as the longest chain has steps."""
        edges = self.references()
        step = edges.select(F.col("kind").alias("k"), F.col("name").alias("n"), F.col("version").alias("v"), *(F.col(f"ref_{c}").alias(f"next_{c}") for c in ("kind", "name", "version")))
        found = last = edges
        while True:
            onward = (F.col("ref_kind") == F.col("k")) & (F.col("ref_name") == F.col("n")) & (F.col("ref_version") == F.col("v"))
            last = last.join(step, onward).select("kind", "name", "version", *(F.col(f"next_{c}").alias(f"ref_{c}") for c in ("kind", "name", "version"))).distinct().subtract(found)
            last.write.parquet(at := f"{self.path}/_staging/{uuid.uuid4().hex}")
            last = self.spark.read.parquet(at)
            if last.isEmpty():
                return found
            found = found.unionByName(last)

    def used_in(self, kind: str, name: str, version: int | None = None) -> list[tuple[str, str, int]]:
        """Enabled datasets and mapping tables that refer to a schema or mapping table, the first NAMED of them."""
        rows = self.references().where((F.col("ref_kind") == kind) & (F.col("ref_name") == name))
        rows = rows if version is None else rows.where(F.col("ref_version") == version)
        return [tuple(r) for r in rows.select("kind", "name", "version").distinct().orderBy("kind", "name", "version").limit(NAMED).collect()]

    def apply(self, changes: DataFrame, partly: bool = False) -> DataFrame:
        """Commit a batch of changes as one: the given columns and ``refused``, which says why a change can't be made (null where it was).

        All changes are judged by the state before the batch, so an entity may be in it once. Unless ``partly``, one refusal keeps the whole batch from being made.
        """
        while True:
            seen = self._last()
            judged = self._judged(changes)
            judged.write.parquet(at := f"{self.path}/_reports/{uuid.uuid4().hex}")  # as the state is now
            judged = self.spark.read.schema(judged.schema).parquet(at)
            report = judged.select(*(f.split()[0] for f in CHANGES.split(", ")), "refused")
            if not partly and not judged.where("refused IS NOT NULL").isEmpty():
                return report
            good = judged.where("refused IS NULL")
            versions = good.where(F.col("action").isin("create", "update")).select("kind", "name", (F.col("at_version") + 1).alias("version"), (F.col("change") + 1).alias("change"), "action", F.lit(False).alias("disabled"), ((F.col("action") == "create") & F.col("locked")).alias("locked"), "doc")
            marks = good.where(~F.col("action").isin("create", "update")).select("kind", "name", "action", (F.col("change") + 1).alias("next"))
            marked = marks.join(self.entities().drop("action"), ["kind", "name"]).select(
                "kind", "name", "version", F.col("next").alias("change"), "action",
                F.when(F.col("action") == "disable", True).when(F.col("action") == "enable", False).otherwise(F.col("disabled")).alias("disabled"),
                F.when(F.col("action") == "lock", True).when(F.col("action") == "unlock", False).otherwise(F.col("locked")).alias("locked"), "doc",
            )
            if self._commit(versions.unionByName(marked), seen):
                return report

    def _judged(self, changes: DataFrame) -> DataFrame:
        """Changes with the state of their entities and why they can't be made."""
        key = ["kind", "name"]
        state = self.entities().groupBy(*key).agg(F.max("version").alias("at_version"), F.max("change").alias("change"), F.bool_or("locked").alias("locked"), F.bool_and("disabled").alias("gone"))
        users = self.references().groupBy(F.col("ref_kind").alias("kind"), F.col("ref_name").alias("name")).agg(F.min(F.struct("kind", "name", "version")).alias("user"))
        times = changes.groupBy(*key).agg(F.count("*").alias("times"))
        rows = changes.select(*(f.split()[0] for f in CHANGES.split(", "))).join(times, key, "left").join(state, key, "left").join(users, key, "left")
        rows = rows.withColumns({"at_version": F.coalesce("at_version", F.lit(0)), "change": F.coalesce("change", F.lit(0)), "locked": F.coalesce("locked", F.lit(False)), "gone": F.coalesce("gone", F.lit(False))})
        here = F.concat_ws(" ", "kind", "name")
        there = (F.col("at_version") > 0) & ~F.col("gone")
        action, based_on = F.col("action"), F.col("based_on")
        refused = (
            F.when(F.col("kind").isNull() | F.col("name").isNull(), "a change needs a kind and a name")
            .when(F.coalesce(~action.isin(*ACTIONS), F.lit(True)), F.concat(F.lit("there is no action "), F.coalesce(action, F.lit("null"))))
            .when(F.col("times") > 1, F.concat(here, F.lit(" is in the batch more than once")))
            .when((action == "create") & there, F.concat(here, F.lit(" exists")))
            .when((action == "update") & ~there | (action != "create") & (F.col("at_version") == 0), F.concat(F.lit("there is no "), here))
            .when((action == "update") & F.col("locked"), F.concat(here, F.lit(" is locked")))
            .when((action == "update") & ~based_on.eqNullSafe(F.col("at_version")), F.concat(here, F.lit(" is at version "), F.col("at_version"), F.lit(", not "), F.coalesce(based_on.cast("string"), F.lit("null"))))
            .when((action == "disable") & F.col("user").isNotNull(), F.concat(here, F.lit(" is used by "), F.concat_ws(" ", "user.kind", "user.name", "user.version")))
        )
        return rows.withColumn("refused", refused).drop("times", "user")

    def audit(self, kind: str, name: str) -> DataFrame:
        return self.history().where((F.col("kind") == kind) & (F.col("name") == name)).orderBy("change").select("version", "action", "at")

    def export(self, kind: str, name: str, version: int | None = None) -> str:
        doc = self.get(kind, name, version)
        if doc is None:
            raise KeyError(f"there is no {kind} {name}")
        return json.dumps({"metadata": {"exportVersion": 1}, "kind": kind, "item": doc}, sort_keys=True)

    def load(self, text: str) -> int:
        """Import an exported document as a new entity or version."""
        doc = json.loads(text)
        item = dict(doc["item"])
        name = item.pop("name")
        item.pop("version", None)
        version = self._state(doc["kind"], name)[0]
        return self.update(doc["kind"], name, version, item) if version else self.create(doc["kind"], name, item)


@dataclass
class Findings:
    """Errors and warnings by key."""

    errors: dict[str, list[str]] = field(default_factory=lambda: defaultdict(list))
    warnings: dict[str, list[str]] = field(default_factory=lambda: defaultdict(list))

    def __bool__(self) -> bool:
        return not self.errors

    def merge(self, other: Findings) -> Findings:
        out = Findings()
        for of in (self, other):
            for mine, theirs in ((out.errors, of.errors), (out.warnings, of.warnings)):
                for key, said in theirs.items():
                    mine[key].extend(said)
        return out


def check_rules(schema: T.StructType, rules: Sequence[R.Rule], tables: Iterable[str] = ()) -> Findings:
    """What a rule list would fail with: unknown inputs, outputs that exist, missing tables, repeated orders."""
    found, known, names = Findings(), set(tables), _leaves(schema)
    seen: set[int] = set()
    for rule in sorted(rules, key=lambda r: r.order):
        key = f"item.conformanceRules.{rule.order}"
        if rule.order in seen:
            found.errors[key].append(f"order {rule.order} is used twice")
        seen.add(rule.order)
        found.errors[key].extend(f"input column {c} does not exist" for c in rule.inputs if c.lower() not in names)
        if isinstance(rule, R.Mapping) and rule.table not in known:
            found.errors[key].append(f"mapping table {rule.table} does not exist")
        for output in rule.outputs:
            if isinstance(rule, R.Drop):
                names.discard(output.lower())
            elif output.lower() in names:
                found.errors[key].append(f"output column {output} already exists")
            else:
                names.add(output.lower())
    found.errors = defaultdict(list, {k: v for k, v in found.errors.items() if v})
    return found


def _leaves(schema: T.StructType, head: str = "") -> set[str]:
    """All paths of a schema, in lower case."""
    out = set()
    for f in schema.fields:
        path = f"{head}{f.name}".lower()
        out.add(path)
        inner = paths.inner(f.dataType)
        if isinstance(inner, T.StructType):
            out |= _leaves(inner, f"{path}.")
    return out


@dataclass(frozen=True)
class Property:
    """A definition that dataset properties are checked against; ``allow_run`` lets jobs run without a mandatory one."""

    name: str
    essentiality: str = "Optional"
    allowed: tuple[str, ...] | None = None
    disabled: bool = False
    allow_run: bool = False


def check_properties(given: Mapping[str, str], definitions: Sequence[Property], for_run: bool = False) -> Findings:
    found, known = Findings(), {d.name: d for d in definitions}
    for name, value in given.items():
        d = known.get(name)
        if d is None:
            found.errors[name].append(f"there is no property definition for '{name}'")
        elif d.disabled:
            found.errors[name].append(f"property definition '{name}' is disabled")
        elif d.allowed is not None and value not in d.allowed:
            found.errors[name].append(f"value '{value}' is not one of {', '.join(d.allowed)}")
    for d in definitions:
        if d.disabled or given.get(d.name):
            continue
        if d.essentiality == "Mandatory":
            (found.warnings if for_run and d.allow_run else found.errors)[d.name].append(f"property '{d.name}' is mandatory, but there is no value")
        elif d.essentiality == "Recommended":
            found.warnings[d.name].append(f"property '{d.name}' is recommended, but there is no value")
    return found


def property_findings(given: DataFrame, definitions: Sequence[Property], for_run: bool = False) -> DataFrame:
    """What ``check_properties`` says about the properties (dataset, name, value) of any number of datasets: rows (dataset, property, level, said).

    Properties meet their definitions by broadcast; what a dataset lacks is the definitions that ask for a value without the names that it has one for. A dataset
    without any property is given as a row without a name.
    """
    spark = given.sparkSession
    kind = "name string, allowed array<string>, disabled boolean"
    known = spark.createDataFrame([(d.name, None if d.allowed is None else list(d.allowed), d.disabled) for d in definitions], kind).withColumn("known", F.lit(True))
    rows = given.where("name IS NOT NULL").join(F.broadcast(known), "name", "left")
    said = (
        F.when(F.col("known").isNull(), F.concat(F.lit("there is no property definition for '"), "name", F.lit("'")))
        .when(F.col("disabled"), F.concat(F.lit("property definition '"), "name", F.lit("' is disabled")))
        .when(F.col("allowed").isNotNull() & ~F.coalesce(F.array_contains("allowed", F.col("value")), F.lit(False)), F.concat(F.lit("value '"), F.coalesce("value", F.lit("None")), F.lit("' is not one of "), F.array_join("allowed", ", ")))
    )
    wrong = rows.select("dataset", F.col("name").alias("property"), F.lit("error").alias("level"), said.alias("said")).where("said IS NOT NULL")
    wanted = []
    for d in definitions:
        if not d.disabled and d.essentiality in ("Mandatory", "Recommended"):
            mandatory = d.essentiality == "Mandatory"
            text = f"property '{d.name}' is {d.essentiality.lower()}, but there is no value"
            wanted.append(F.struct(F.lit(d.name).alias("property"), F.lit("error" if mandatory and not (for_run and d.allow_run) else "warning").alias("level"), F.lit(text).alias("said")))
    if not wanted:
        return wrong
    named = given.groupBy("dataset").agg(F.collect_set(F.when(F.col("name").isin([d.name for d in definitions]) & (F.coalesce("value", F.lit("")) != ""), F.col("name"))).alias("names"))
    lacking = named.select("dataset", F.inline(F.filter(F.array(*wanted), lambda w: ~F.array_contains("names", w["property"]))))
    return wrong.unionByName(lacking)
