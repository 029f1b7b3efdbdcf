"""Applying an ordered list of rules to a DataFrame.

Rules that don't read each other's outputs are fused into one projection, so the plan grows by one node for each dependency and
not for each rule. What is written into structs stays in a column of its own, from which later rules read it, and goes to its place when all
are done: a struct that each rule built again from itself would make the optimizer's work double with every rule. Mapping rules add a
join or a lookup of their own.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import errors, paths
from millrace.operators import mapping as lookups
from millrace.operators.rules import Custom, Drop, Rule, RuleError
from millrace.operators.rules import Mapping as MappingRule
from millrace.session import lenient_casts

#: Called before and after a rule that asks for a checkpoint, with its name and the frame; may give another frame to go on with, as one that observes itself.
OnCheckpoint = Callable[[str, DataFrame], DataFrame | None]


@dataclass
class Options:
    #: Let rules change or drop columns of the input.
    allow_original_changes: bool = False
    errors_nullable: bool | None = None
    broadcast_bytes: int = lookups.BROADCAST_BYTES
    map_rows: int = lookups.MAP_ROWS
    on_checkpoint: OnCheckpoint | None = None


class _Steps:
    """A frame with the writes that are to go into its next projection, and the fields of structs that are columns of their own for now."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.columns: dict[str, Column] = {}
        self.problems: list[Column] = []
        self.written: list[str] = []
        #: Path to the column that holds its value; how many there have been.
        self.apart: dict[str, str] = {}
        self.count = 0

    @property
    def schema(self) -> T.StructType:
        """As the frame will be when all fields are in their places."""
        kinds = T.StructType([f for f in self.df.schema.fields if f.name not in self.apart.values()])
        for path, column in self.apart.items():
            if column in self.df.columns:
                kinds = paths.with_field(kinds, path, self.df.schema[column].dataType, self.df.schema[column].nullable)
        return kinds

    def touches(self, path: str) -> bool:
        low = path.lower()
        return any(low == w or low.startswith(f"{w}.") or w.startswith(f"{low}.") for w in self.written)

    def own(self, read: paths.Reader) -> paths.Reader:
        """A reader that also finds the fields that are apart."""
        known = {path.lower(): column for path, column in self.apart.items()}

        def find(path: str) -> Column:
            column = known.get(path.lower())
            return read(path) if column is None else F.col(column)

        return find

    def within_structs(self, path: str) -> bool:
        """Whether a path is below a column that is there, through structs only."""
        parts, kind = path.split("."), self.schema
        if len(parts) < 2 or paths.field(self.df.schema, parts[0]) is None:
            return False
        for part in parts[:-1]:
            found = paths.field(kind, part)
            if found is None:
                return True
            kind = found.dataType
            if not isinstance(kind, T.StructType):
                return False
        return True

    def parent(self, path: str) -> Column | None:
        """Whether the struct that a path is written to isn't null; None if it never is."""
        parts, kind, column, sure = path.split(".")[:-1], self.df.schema, None, True
        for part in parts:
            found = paths.field(kind, part)
            if found is None:
                break
            column = F.col(f"`{found.name}`") if column is None else column.getField(found.name)
            kind, sure = found.dataType, sure and not found.nullable
        return None if sure else column.isNotNull()

    def put(self, path: str, value: Column) -> None:
        """A field of a struct as a column of its own."""
        there = self.parent(path)
        self.count += 1
        known = next((p for p in self.apart if p.lower() == path.lower()), path)
        self.apart[known] = f"__field{self.count}"
        self.columns[self.apart[known]] = value if there is None else F.when(there, value)

    def flush(self) -> None:
        """The next projection."""
        if self.columns:
            columns = dict(self.columns)
            if self.problems:
                columns[errors.ERRORS] = errors.joined(F.col(errors.ERRORS), *self.problems)
            self.df = self.df.withColumns(columns)
        self.columns, self.problems, self.written = {}, [], []

    def settle(self) -> DataFrame:
        """The frame with all fields in their places."""
        self.flush()
        if self.apart:
            by_root: dict[str, dict[str, Column]] = {}
            for path, column in self.apart.items():
                root, _, rest = path.partition(".")
                by_root.setdefault(paths.field(self.df.schema, root).name, {})[rest] = F.col(column)
            self.df = self.df.withColumns({root: paths.write_all(self.df.schema, root, values) for root, values in by_root.items()}).drop(*(f.name for f in self.df.schema.fields if f.name.startswith("__field")))
            self.apart = {}
        return self.df


def ordered(rules: Sequence[Rule]) -> list[Rule]:
    """By order; rules of the same order as they are listed."""
    return sorted(rules, key=lambda r: r.order)


def check_originals(schema: T.StructType, rules: Sequence[Rule], allowed: bool) -> None:
    """No rule may write or drop a column of the input, unless allowed."""
    for rule in rules:
        if isinstance(rule, Custom):
            continue
        for output in rule.outputs:
            if paths.type_at(schema, output) is not None:
                said = f"rule {rule.order} changes the original column '{output}'"
                if not allowed:
                    raise RuleError(said)
                warnings.warn(said, stacklevel=3)


def conform(df: DataFrame, rules: Sequence[Rule], tables: Mapping[str, lookups.Table] | None = None, options: Options | None = None) -> DataFrame:
    """``df`` with the outputs of all rules and the error column; columns keep their order, new ones follow."""
    options = options or Options()
    spark, steps = df.sparkSession, ordered(rules)
    check_originals(df.schema, steps, options.allow_original_changes)
    with lenient_casts(spark):
        state = _Steps(errors.with_errors(df, options.errors_nullable))
        waiting: list[lookups.Lookup] = []  # mapping rules that share a pass

        def look_up() -> None:
            if waiting:
                state.df = lookups.apply_all(state.df, waiting, options.broadcast_bytes, options.map_rows)
                waiting.clear()

        for rule in steps:
            watched = rule.checkpoint and options.on_checkpoint is not None
            if waiting and not (isinstance(rule, MappingRule) and not watched and lookups.together(state.df.schema, waiting, rule)):
                look_up()
            if isinstance(rule, MappingRule | Drop | Custom) or watched:
                state.settle()
            if watched:
                state.df = _measured(options, f"{rule.order} {rule.kind} before", state.df)
            if isinstance(rule, MappingRule):
                rule.check(state.df.schema)
                if rule.table not in (tables or {}):
                    raise RuleError(f"rule {rule.order}: there is no mapping table '{rule.table}'")
                waiting.append(lookups.Lookup(rule, tables[rule.table]))
                if watched or not lookups.nested(state.df.schema, rule):
                    look_up()
            elif isinstance(rule, Drop):
                state.df = _drop(state.df, rule)
            elif isinstance(rule, Custom):
                state.df = rule.change(state.df)
            else:
                _add(state, rule, options)
            if watched:
                state.df = _measured(options, f"{rule.order} {rule.kind} after", state.settle())
        look_up()
        return errors.with_nullability(state.settle(), options.errors_nullable)


def _measured(options: Options, name: str, df: DataFrame) -> DataFrame:
    other = options.on_checkpoint(name, df)
    return df if other is None else other


def _add(state: _Steps, rule: Rule, options: Options) -> None:
    within = state.within_structs(rule.output)
    around = rule.output if within else rule.output.rpartition(".")[0] or rule.output
    if any(state.touches(p) for p in [*rule.inputs, around]):
        state.flush()
    root = rule.output.split(".")[0]
    if not within and any(p.lower().startswith(f"{root.lower()}.") for p in state.apart):
        state.settle()
    schema, spark = state.schema, state.df.sparkSession
    if not (options.allow_original_changes and paths.type_at(schema, rule.output) is not None):
        rule.check(schema)
    read = state.own(paths.reader({}))
    fails = rule.problem(schema, read) is not None
    if within:
        there = state.parent(rule.output)
        if fails:
            problem = F.array(rule.problem(schema, read))
            state.problems.append(problem if there is None else F.when(there, problem).otherwise(errors.none()))
        state.put(rule.output, rule.value(spark, schema, read))
    else:
        found = paths.field(schema, root)
        name = found.name if found else root
        state.columns[name] = paths.write(schema, rule.output, lambda r: rule.value(spark, schema, state.own(r)), state.columns.get(name))
        if fails:
            state.problems.append(paths.gather(schema, rule.output, lambda r: rule.problem(schema, state.own(r)), errors.none()))
    state.written.append(rule.output.lower())


def _drop(df: DataFrame, rule: Drop) -> DataFrame:
    if paths.type_at(df.schema, rule.output) is None:
        return df
    if "." not in rule.output:
        return df.drop(paths.field(df.schema, rule.output).name)
    root = paths.field(df.schema, rule.output.split(".")[0]).name
    return df.withColumn(root, paths.drop(df.schema, rule.output))


def produced(schema: T.StructType, rules: Sequence[Rule], path: str) -> bool:
    """Whether conformed data will have a field: one of the schema or of a rule that is not dropped later."""
    low, there = path.lower(), paths.type_at(schema, path) is not None
    for rule in ordered(rules):
        if isinstance(rule, Drop):
            there = there and rule.output.lower() != low
        else:
            there = there or low in (o.lower() for o in rule.outputs)
    return there


def with_info(df: DataFrame, date: Column, version: Column, prefix: str = "info") -> DataFrame:
    """``df`` with the report's date, date as text and version; a value that was there and differs is overwritten and reported."""
    text = F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit(""))
    for name, value in ((f"{prefix}_date", date), (f"{prefix}_date_string", text), (f"{prefix}_version", version)):
        df = overwrite(df, name, value)
    return df


def overwrite(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column set; rows in which another value stood get an error, a null is no other value."""
    found = paths.field(df.schema, name)
    if found is None:
        return df.withColumn(name, value)
    df = errors.with_errors(df)
    old = F.col(f"`{found.name}`")
    changed = F.when(old != value, F.array(errors.error(errors.CONF_LIT, found.name, [old]))).otherwise(errors.none())
    return df.withColumns({errors.ERRORS: errors.joined(F.col(errors.ERRORS), changed), found.name: value})
