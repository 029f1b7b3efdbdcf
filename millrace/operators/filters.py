"""Predicates of mapping tables: a small algebra with a JSON form."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of literal types; decimal(p, s) beside them.
TYPES = ("string", "boolean", "byte", "short", "integer", "int", "long", "float", "double", "date", "timestamp", "binary", "calendarinterval", "null")
DECIMAL = re.compile(r"decimal(\(\s*\d+\s*(,\s*-?\d+\s*)?\))?")


def type_name(name: str) -> str:
    """A type's name as Spark takes it; unknown names are refused."""
    low = name.strip().lower().removesuffix("type")
    if low not in TYPES and not DECIMAL.fullmatch(low):
        raise ValueError(f"unknown type {name!r}")
    return {"null": "void", "calendarinterval": "interval"}.get(low, low)


class Filter:
    def __and__(self, other: Filter) -> Filter:
        return All.of([self, other])

    def __or__(self, other: Filter) -> Filter:
        return Any_.of([self, other])

    def __invert__(self) -> Filter:
        return Not(self)

    def condition(self) -> Column:
        raise NotImplementedError

    def to_json(self) -> dict:
        raise NotImplementedError


@dataclass(frozen=True)
class _Compared(Filter):
    column: str
    value: str
    type: str = "string"

    def literal(self) -> Column:
        return F.lit(self.value).cast(type_name(self.type))

    def to_json(self) -> dict:
        return {"_t": self._t, "columnName": self.column, "value": self.value, "valueType": self.type}


class Equals(_Compared):
    _t = "EqualsFilter"

    def condition(self) -> Column:
        return F.col(self.column) == self.literal()


class Differs(_Compared):
    """Rows with null are left out, as by any comparison."""

    _t = "DiffersFilter"

    def condition(self) -> Column:
        return F.col(self.column) != self.literal()


@dataclass(frozen=True)
class IsNull(Filter):
    column: str

    def condition(self) -> Column:
        return F.col(self.column).isNull()

    def to_json(self) -> dict:
        return {"_t": "IsNullFilter", "columnName": self.column}


@dataclass(frozen=True)
class Not(Filter):
    of: Filter

    def __invert__(self) -> Filter:
        return self.of

    def condition(self) -> Column:
        return ~self.of.condition()

    def to_json(self) -> dict:
        return {"_t": "NotFilter", "inputFilter": self.of.to_json()}


@dataclass(frozen=True)
class _Joined(Filter):
    parts: tuple[Filter, ...]

    @classmethod
    def of(cls, parts: Iterable[Filter]) -> Filter:
        """Nested filters of the same kind are taken apart and repeated ones left out."""
        flat = [q for p in parts for q in (p.parts if isinstance(p, cls) else (p,))]
        unique = tuple(dict.fromkeys(flat))
        return unique[0] if len(unique) == 1 else cls(unique)

    def to_json(self) -> dict:
        return {"_t": self._t, "filterItems": [p.to_json() for p in self.parts]}


class All(_Joined):
    _t = "AndJoinedFilters"

    def condition(self) -> Column:
        return reduce(lambda a, b: a & b, (p.condition() for p in self.parts)) if self.parts else F.lit(True)


class Any_(_Joined):
    _t = "OrJoinedFilters"

    def condition(self) -> Column:
        return reduce(lambda a, b: a | b, (p.condition() for p in self.parts)) if self.parts else F.lit(True)


def from_json(doc: dict[str, Any] | None) -> Filter | None:
    """A filter from its JSON form."""
    if doc is None:
        return None
    kind = doc["_t"].rpartition(".")[2]
    if kind in ("EqualsFilter", "DiffersFilter"):
        return {"EqualsFilter": Equals, "DiffersFilter": Differs}[kind](doc["columnName"], doc["value"], doc.get("valueType", "string"))
    if kind == "IsNullFilter":
        return IsNull(doc["columnName"])
    if kind == "NotFilter":
        return Not(from_json(doc["inputFilter"]))
    if kind in ("AndJoinedFilters", "OrJoinedFilters"):
        return {"AndJoinedFilters": All, "OrJoinedFilters": Any_}[kind].of(from_json(x) for x in doc["filterItems"])
    raise ValueError(f"unknown filter {doc['_t']!r}")
