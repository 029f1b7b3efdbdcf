"""Conformance rules: each says what it reads, where it writes, and gives a value and, if it can fail, an error as expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import errors
from millrace.functions.paths import Reader, inner, type_at

from . import filters


class RuleError(ValueError):
    """A rule that doesn't fit the schema."""


@dataclass(frozen=True, kw_only=True)
class Rule:
    order: int
    output: str
    checkpoint: bool = False
    kind: ClassVar[str] = ""

    @property
    def inputs(self) -> list[str]:
        return []

    @property
    def outputs(self) -> list[str]:
        return [self.output]

    def check(self, schema: T.StructType) -> None:
        """Refuse what doesn't fit the schema."""
        for path in self.inputs:
            kind = type_at(schema, path)
            if kind is None:
                raise RuleError(f"rule {self.order}: there is no column '{path}'")
            if isinstance(inner(kind), T.StructType):
                raise RuleError(f"rule {self.order}: '{path}' is not a primitive")
        parents = {path.rpartition(".")[0].lower() for path in [*self.inputs, self.output]}
        if len(self.inputs) > 1 and len({p.rpartition(".")[0].lower() for p in self.inputs}) > 1 and any(parents):
            raise RuleError(f"rule {self.order}: inputs must have the same parent")
        check_output(schema, self.output, self.order)

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        raise NotImplementedError

    def problem(self, schema: T.StructType, read: Reader) -> Column | None:
        """The error at one place, null where there is none; None for rules that can't fail."""
        return None


def check_output(schema: T.StructType, path: str, order: int) -> None:
    """The parent of an output must be a struct (or missing), its last part new in any case of its letters."""
    parent = path.rpartition(".")[0]
    if type_at(schema, path) is not None:
        raise RuleError(f"rule {order}: column '{path}' already exists")
    kind = type_at(schema, parent) if parent else schema
    if kind is not None and not isinstance(inner(kind), T.StructType):
        raise RuleError(f"rule {order}: '{parent}' is not a struct")


@dataclass(frozen=True, kw_only=True)
class Literal(Rule):
    text: str
    kind: ClassVar[str] = "LiteralConformanceRule"

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        return typed_literal(self.text)


def double_text(text: str) -> bool:
    """Whether the text is what a double prints as on the JVM: plain between 0.001 and 10,000,000, else as ``1.0E10``."""
    if text in ("NaN", "Infinity", "-Infinity"):
        return True
    if not re.fullmatch(r"-?[0-9]+\.[0-9]+(E-?[0-9]+)?", text):
        return False
    value = float(text)
    if value == 0 or 1e-3 <= abs(value) < 1e7:
        return repr(value) == text
    shortest = next(d for n in range(17) if float(d := f"{value:.{max(n, 1)}e}") == value or n == 16)
    digits, _, power = shortest.partition("e")
    return f"{digits}E{int(power)}" == text


def typed_literal(text: str) -> Column:
    """The strictest of int, long, double, boolean that prints as the text, else a string."""
    if re.fullmatch(r"-?[0-9]{1,19}", text) and str(int(text)) == text and -(1 << 63) <= int(text) < 1 << 63:
        return F.lit(int(text)).cast("int" if -(1 << 31) <= int(text) < 1 << 31 else "long")
    if double_text(text):
        return F.lit(float(text))
    if text.lower() in ("true", "false"):
        return F.lit(text.lower() == "true")
    return F.lit(text)


@dataclass(frozen=True, kw_only=True)
class _OneInput(Rule):
    input: str

    @property
    def inputs(self) -> list[str]:
        return [self.input]


@dataclass(frozen=True, kw_only=True)
class Uppercase(_OneInput):
    kind: ClassVar[str] = "UppercaseConformanceRule"

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        return F.upper(read(self.input).cast("string"))


@dataclass(frozen=True, kw_only=True)
class Concatenation(Rule):
    """Null if any input is null."""

    columns: tuple[str, ...]
    kind: ClassVar[str] = "ConcatenationConformanceRule"

    @property
    def inputs(self) -> list[str]:
        return list(self.columns)

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        return F.concat(*(read(c).cast("string") for c in self.columns))


@dataclass(frozen=True, kw_only=True)
class Coalesce(Concatenation):
    kind: ClassVar[str] = "CoalesceConformanceRule"

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        return F.coalesce(*(read(c) for c in self.columns))


@dataclass(frozen=True, kw_only=True)
class Casting(_OneInput):
    to: str
    kind: ClassVar[str] = "CastingConformanceRule"

    def check(self, schema: T.StructType) -> None:
        super().check(schema)
        source = inner(type_at(schema, self.input)).typeName()
        target = family(filters.type_name(self.to))
        if target in REFUSED.get(source, ()):
            raise RuleError(f"rule {self.order}: {source} can't be cast to {self.to}")

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        return read(self.input).cast(filters.type_name(self.to))

    def problem(self, schema: T.StructType, read: Reader) -> Column:
        raw = read(self.input)
        failed = raw.isNotNull() & raw.cast(filters.type_name(self.to)).isNull()
        return F.when(failed, errors.error(errors.CONF_CAST, self.output, [raw]))


#: Casts that are refused when a rule is planned, by the name of the source type.
_NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")
REFUSED = {**dict.fromkeys(_NUMBERS, ("date",)), "boolean": ("date", "timestamp")}


def family(name: str) -> str:
    """A type's name without its parameters."""
    return {"int": "integer"}.get(base := name.partition("(")[0], base)


@dataclass(frozen=True, kw_only=True)
class Negation(_OneInput):
    """``not`` of booleans, 0 - x of numbers. The smallest integral value can't be negated: null where the column is nullable, else 0."""

    kind: ClassVar[str] = "NegationConformanceRule"
    SMALLEST: ClassVar[dict[str, int]] = {"byte": -(1 << 7), "short": -(1 << 15), "integer": -(1 << 31), "long": -(1 << 63)}

    def check(self, schema: T.StructType) -> None:
        super().check(schema)
        kind = inner(type_at(schema, self.input))
        if not isinstance(kind, T.NumericType | T.BooleanType):
            raise RuleError(f"rule {self.order}: {kind.typeName()} can't be negated")

    def _overflow(self, schema: T.StructType, read: Reader) -> Column | None:
        least = self.SMALLEST.get(inner(type_at(schema, self.input)).typeName())
        return None if least is None else read(self.input) == F.lit(least)

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        kind, x = inner(type_at(schema, self.input)), read(self.input)
        if isinstance(kind, T.BooleanType):
            return ~x
        negated = (F.lit(0).cast(kind) - x).cast(kind)
        overflow = self._overflow(schema, read)
        if overflow is None:
            return negated
        instead = F.lit(None).cast(kind) if nullable_at(schema, self.input) else F.lit(0).cast(kind)
        return F.when(overflow, instead).otherwise(negated)

    def problem(self, schema: T.StructType, read: Reader) -> Column | None:
        overflow = self._overflow(schema, read)
        return None if overflow is None else F.when(overflow, errors.error(errors.CONF_NEG, self.output, [read(self.input)]))


def nullable_at(schema: T.StructType, path: str) -> bool:
    head, _, last = path.rpartition(".")
    parent = inner(type_at(schema, head)) if head else schema
    return next(f.nullable for f in parent.fields if f.name.lower() == last.lower())


@dataclass(frozen=True, kw_only=True)
class SingleColumn(_OneInput):
    """A struct of one field."""

    alias: str
    kind: ClassVar[str] = "SingleColumnConformanceRule"

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        return F.struct(read(self.input).alias(self.alias))


@dataclass(frozen=True, kw_only=True)
class SessionConf(Rule):
    """The value of a session setting when the plan is built; null if it isn't set."""

    key: str
    kind: ClassVar[str] = "SparkSessionConfConformanceRule"

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        return F.lit(spark.conf.get(self.key, None)).cast("string")


@dataclass(frozen=True, kw_only=True)
class FillNulls(_OneInput):
    text: str
    kind: ClassVar[str] = "FillNullsConformanceRule"

    def check(self, schema: T.StructType) -> None:
        super().check(schema)
        kind = inner(type_at(schema, self.input))
        if not isinstance(kind, T.NumericType | T.StringType | T.BooleanType | T.DateType | T.TimestampType):
            raise RuleError(f"rule {self.order}: nulls of type {kind.simpleString()} can't be filled")

    def value(self, spark: SparkSession, schema: T.StructType, read: Reader) -> Column:
        kind = inner(type_at(schema, self.input))
        filled = spark.createDataFrame([(self.text,)], "text string").select(F.trim("text").cast(kind)).first()[0]  # of a local row, so no job runs
        if filled is None:
            raise RuleError(f"rule {self.order}: '{self.text}' is not of the type {kind.simpleString()} of '{self.input}'")
        return F.coalesce(read(self.input), F.lit(self.text) if isinstance(kind, T.StringType) else F.trim(F.lit(self.text)).cast(kind))


@dataclass(frozen=True, kw_only=True)
class Drop(Rule):
    """Drops a column or nested field; a missing one is no error."""

    kind: ClassVar[str] = "DropConformanceRule"

    def check(self, schema: T.StructType) -> None:
        pass


@dataclass(frozen=True, kw_only=True)
class Mapping(Rule):
    """Looks values up in reference data; ``keys`` pairs columns of the table with columns of the dataset."""

    table: str
    version: int = 0
    keys: tuple[tuple[str, str], ...] = ()
    target: str = ""
    additional: tuple[tuple[str, str], ...] = ()
    null_safe: bool = False
    filter: filters.Filter | None = None
    override_own_filter: bool = False
    kind: ClassVar[str] = "MappingConformanceRule"

    @property
    def inputs(self) -> list[str]:
        return [column for _, column in self.keys]

    @property
    def outputs(self) -> list[str]:
        return [*(o for o, _ in self.additional), self.output]

    @property
    def targets(self) -> dict[str, str]:
        """Output to target attribute, the further outputs first."""
        return {**dict(self.additional), self.output: self.target}

    def check(self, schema: T.StructType) -> None:
        for path in self.inputs:
            if type_at(schema, path) is None:
                raise RuleError(f"rule {self.order}: there is no column '{path}'")
        if len({o.rpartition(".")[0].lower() for o in self.outputs}) > 1:
            raise RuleError(f"rule {self.order}: outputs must have the same parent")
        for output in self.outputs:
            check_output(schema, output, self.order)


@dataclass(frozen=True, kw_only=True)
class Custom(Rule):
    """A function of the caller's own."""

    change: Callable[[DataFrame], DataFrame] = field(compare=False)
    kind: ClassVar[str] = "CustomConformanceRule"

    def check(self, schema: T.StructType) -> None:
        pass


KINDS: dict[str, type[Rule]] = {c.kind: c for c in (Literal, Uppercase, Concatenation, Coalesce, Casting, Negation, SingleColumn, SessionConf, FillNulls, Drop, Mapping)}
#: Names in the JSON form to names here, by rule.
_COMMON = {"order": "order", "outputColumn": "output", "controlCheckpoint": "checkpoint"}
_NAMES = {
    Literal: {"value": "text"}, Uppercase: {"inputColumn": "input"}, Concatenation: {"inputColumns": "columns"}, Coalesce: {"inputColumns": "columns"},
    Casting: {"inputColumn": "input", "outputDataType": "to"}, Negation: {"inputColumn": "input"}, SingleColumn: {"inputColumn": "input", "inputColumnAlias": "alias"},
    SessionConf: {"sparkConfKey": "key"}, FillNulls: {"inputColumn": "input", "value": "text"}, Drop: {},
    Mapping: {"mappingTable": "table", "mappingTableVersion": "version", "attributeMappings": "keys", "targetAttribute": "target", "additionalColumns": "additional", "isNullSafe": "null_safe", "mappingTableFilter": "filter", "overrideMappingTableOwnFilter": "override_own_filter"},
}


def from_json(doc: dict[str, Any]) -> Rule:
    """A rule from its JSON form; unknown names are ignored, missing optional ones take their defaults."""
    name = doc["_t"].rpartition(".")[2]
    if name not in KINDS:
        raise ValueError(f"unknown rule {doc['_t']!r}")
    values = {}
    for theirs, ours in {**_COMMON, **_NAMES[KINDS[name]]}.items():
        value = doc.get(theirs)
        if value is None:
            continue
        if ours in ("keys", "additional"):
            value = tuple(value.items())
        elif ours == "columns":
            value = tuple(value)
        elif ours == "filter":
            value = filters.from_json(value)
        values[ours] = value
    return KINDS[name](**values)


def to_json(rule: Rule) -> dict[str, Any]:
    doc: dict[str, Any] = {"_t": rule.kind}
    for theirs, ours in {**_COMMON, **_NAMES[type(rule)]}.items():
        value = getattr(rule, ours)
        if ours in ("keys", "additional"):
            value = dict(value)
        elif ours == "columns":
            value = list(value)
        elif ours == "filter":
            value = value.to_json() if value else None
        doc[theirs] = value
    return doc
