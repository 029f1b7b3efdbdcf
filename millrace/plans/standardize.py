"""Standardization: raw columns to a declared schema, with an error for every value that doesn't fit.

The whole schema becomes one projection. Structs are built again field by field, arrays element by element with ``transform``;
what can't be cast, is null where it may not be, or has another shape, turns into null or a default and an error of its row.
Field metadata: ``sourcecolumn`` (name in the input), ``pattern`` (of dates and timestamps), ``default``, ``timezone`` (of timestamps
that name none).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import errors
from millrace.session import lenient_casts

#: Values of non-nullable columns whose own value is missing or wrong, by type.
DEFAULTS = {"string": "", "boolean": "false", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "binary": ""}
RECORD_IDS = ("none", "uuid", "stable")


@dataclass
class Options:
    #: Refuse shapes that don't fit instead of reporting them.
    fail_fast: bool = False
    #: "none", "uuid" or "stable" (a hash of all columns), and the column's name.
    record_id: str = "none"
    record_id_column: str = "record_id"
    #: Column of the reader with lines that it couldn't read.
    corrupt_column: str | None = None
    errors_nullable: bool | None = None


@dataclass
class _Plan:
    options: Options
    problems: list[Column] = field(default_factory=list)


#: Wraps an expression over an element into one over the column it comes from.
Lift = Callable[[Callable[[Column], Column]], Column]


def standardize(df: DataFrame, schema: T.StructType, options: Options | None = None) -> DataFrame:
    """``df`` as the schema declares it, then the error column, then the record id if asked for."""
    options = options or Options()
    if options.record_id not in RECORD_IDS:
        raise ValueError(f"record ids are {', '.join(RECORD_IDS)}, not {options.record_id}")
    plan = _Plan(options)
    with lenient_casts(df.sparkSession):
        errors.with_errors(df)  # refuses an error column of another type
        old = [F.col(errors.ERRORS)] if errors.ERRORS in df.columns else []
        named = [_root(plan, df.schema, f).alias(f.name, metadata=f.metadata) for f in schema.fields if f.name != errors.ERRORS]
        corrupt = []
        if options.corrupt_column and options.corrupt_column in df.columns:
            record = F.col(f"`{options.corrupt_column}`")
            corrupt = [F.when(record.isNotNull(), F.array(errors.error(errors.STD_SCHEMA, None, [record])))]
        found = errors.joined(*old, *corrupt, *plan.problems) if old or corrupt or plan.problems else errors.none()
        out = df.select(*named, found.alias(errors.ERRORS))
        return errors.with_nullability(with_record_id(out, options.record_id, options.record_id_column), options.errors_nullable)


def with_record_id(df: DataFrame, how: str, name: str = "record_id") -> DataFrame:
    """``df`` with an id for each row, unless it has one."""
    if how == "none" or name in df.columns:
        return df
    if how == "uuid":
        return df.withColumn(name, F.expr("uuid()"))
    return df.withColumn(name, F.hash(*(F.col(f"`{c}`") for c in df.columns)))


def _name(f: T.StructField) -> str:
    return f.metadata.get("sourcecolumn", f.name)


def _source(schema: T.StructType, f: T.StructField) -> str | None:
    """The input's name of a field, or None if it has no such column."""
    return next((c.name for c in schema.fields if c.name.lower() == _name(f).lower()), None)


def _root(plan: _Plan, given: T.StructType, f: T.StructField) -> Column:
    """The value of a column of the schema."""
    name = _source(given, f)
    if name is None:
        return _field(plan, f, None, None, _name(f), lambda make: make(None))
    return _field(plan, f, F.col(f"`{name}`"), given[name].dataType, _name(f), lambda make: make(None))


def shape(kind: T.DataType) -> str:
    return "struct" if isinstance(kind, T.StructType) else "array" if isinstance(kind, T.ArrayType) else "map" if isinstance(kind, T.MapType) else "primitive"


def _field(plan: _Plan, f: T.StructField, source: Column | None, kind: T.DataType | None, path: str, lift: Lift) -> Column:
    """The value of a field; its errors go to the plan.

    ``source`` is the raw value, a lambda variable within arrays; ``lift`` turns errors of one value into errors of the row.
    """
    if source is None:
        if not f.nullable:
            plan.problems.append(lift(lambda _: F.array(errors.error(errors.STD_NULL, path, [F.lit("null")]))))
        return _empty(f)
    if shape(kind) != shape(f.dataType):
        if plan.options.fail_fast:
            raise TypeError(f"Cannot standardize field '{path}' from type {kind.typeName()} into {f.dataType.typeName()}")
        plan.problems.append(lift(lambda _: F.array(errors.error(errors.STD_TYPE, path, [], words=(kind.typeName(), f.dataType.typeName())))))
        return _empty(f)
    if isinstance(f.dataType, T.StructType):
        return _struct(plan, f.dataType, source, kind, path, lift)
    if isinstance(f.dataType, T.ArrayType):
        return _array(plan, f, source, kind, path, lift)
    problem = _problem(f, kind, path)
    if problem is not None:
        plan.problems.append(lift(lambda x: F.array(problem(source if x is None else x))))
    return _value(f, source, kind)


def _struct(plan: _Plan, target: T.StructType, source: Column, kind: T.StructType, path: str, lift: Lift) -> Column:
    parts = []
    for f in target.fields:
        own = _source(kind, f)
        child = source.getField(own) if own else None

        def deeper(make: Callable[[Column], Column], own: str | None = own) -> Column:
            return lift(lambda x: make(None if own is None else (source if x is None else x).getField(own)))

        parts.append(_field(plan, f, child, kind[own].dataType if own else None, f"{path}.{_name(f)}", deeper).alias(f.name))
    return F.struct(*parts)


def _array(plan: _Plan, f: T.StructField, source: Column, kind: T.ArrayType, path: str, lift: Lift) -> Column:
    element = T.StructField(f.name, f.dataType.elementType, f.dataType.containsNull, {k: v for k, v in f.metadata.items() if k != "sourcecolumn"})
    if not f.nullable:
        plan.problems.append(lift(lambda x: F.when((source if x is None else x).isNull(), F.array(errors.error(errors.STD_NULL, path, [F.lit("null")])))))

    def deeper(make: Callable[[Column], Column]) -> Column:
        def each(x: Column | None) -> Column:
            lists = F.transform(source if x is None else x, lambda y: F.coalesce(make(y), errors.none()))
            return F.flatten(lists)

        return lift(each)

    inner_plan = _Plan(plan.options)
    value = F.transform(source, lambda x: _field(inner_plan, element, x, kind.elementType, path, deeper))
    plan.problems.extend(inner_plan.problems)
    return value if f.nullable else F.coalesce(value, F.array().cast(f.dataType))


def _parsed(f: T.StructField, source: Column, kind: T.DataType) -> Column:
    """The cast value, null where it can't be cast."""
    pattern, target = f.metadata.get("pattern"), f.dataType
    if isinstance(target, T.DateType) and pattern and not isinstance(kind, T.DateType | T.TimestampType):
        return F.to_date(source.cast("string"), pattern)
    if isinstance(target, T.TimestampType):
        if pattern and not isinstance(kind, T.DateType | T.TimestampType):
            value = F.to_timestamp(source.cast("string"), pattern)
        else:
            value = source.cast(target)
        zone = f.metadata.get("timezone")
        return F.to_utc_timestamp(value, zone) if zone else value
    if isinstance(kind, T.StringType) and isinstance(target, T.NumericType | T.BooleanType):
        return F.trim(source).try_cast(target)
    if isinstance(kind, T.NumericType) and isinstance(target, T.NumericType):
        return source.try_cast(target)
    return source.cast(target)


def _default(f: T.StructField) -> Column:
    given = f.metadata.get("default")
    if given is not None:
        return _parsed(f, F.lit(str(given)), T.StringType())
    return F.lit(DEFAULTS.get(f.dataType.typeName(), "0")).cast(f.dataType)


def _empty(f: T.StructField) -> Column:
    if isinstance(f.dataType, T.ArrayType) and not f.nullable:
        return F.array().cast(f.dataType)
    if f.nullable or isinstance(f.dataType, T.StructType):
        return F.lit(None).cast(f.dataType)
    return _default(f)


def _value(f: T.StructField, source: Column, kind: T.DataType) -> Column:
    parsed = _parsed(f, source, kind)
    return parsed if f.nullable else F.coalesce(parsed, _default(f))


def _problem(f: T.StructField, kind: T.DataType, path: str) -> Callable[[Column], Column] | None:
    """The error of one value, null if it is fine; None where every value is."""
    def of(x: Column) -> Column:
        failed = F.when(x.isNotNull() & _parsed(f, x, kind).isNull(), errors.error(errors.STD_CAST, path, [x]))
        return failed if f.nullable else F.when(x.isNull(), errors.error(errors.STD_NULL, path, [F.lit("null")])).otherwise(failed)

    return None if f.nullable and kind == f.dataType else of
