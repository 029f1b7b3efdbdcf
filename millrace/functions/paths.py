"""Reading and writing at dotted paths through structs and arrays of any depth, as column expressions.

A path doesn't mention arrays: ``items.payments.amount`` is the amount of every payment of every item. All
expressions are built from ``transform``, ``withField`` and ``dropFields``; null and empty arrays and null structs stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Reads a path from where a value is written: elements of arrays around the place, plain columns elsewhere.
Reader = Callable[[str], Column]


class PathError(ValueError):
    """A path that doesn't fit the schema."""


def field(struct: T.StructType, name: str) -> T.StructField | None:
    """The field of that name in any case."""
    return next((f for f in struct.fields if f.name.lower() == name.lower()), None)


def inner(kind: T.DataType) -> T.DataType:
    """The element type below all arrays."""
    while isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return kind


def type_at(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at a path, arrays around it left out; None where there is no such field."""
    kind: T.DataType = schema
    for part in path.split("."):
        kind = inner(kind)
        found = field(kind, part) if isinstance(kind, T.StructType) else None
        if found is None:
            return None
        kind = found.dataType
    return kind


def arrays_of(schema: T.StructType, path: str) -> list[str]:
    """Paths of the arrays that a path goes through, outermost first, its own last part left out."""
    parts = path.split(".")
    heads = [".".join(parts[:k]) for k in range(1, len(parts))]
    return [h for h in heads if isinstance(type_at(schema, h), T.ArrayType)]


def _below(column: Column, parts: list[str]) -> Column:
    for part in parts:
        column = column.getField(part)
    return column


def reader(bound: Mapping[str, Column]) -> Reader:
    """Reads paths given the columns or lambda variables that some of their heads are bound to."""
    def read(path: str) -> Column:
        parts = path.split(".")
        for k in range(len(parts), 0, -1):
            if (head := ".".join(parts[:k])) in bound:
                return _below(bound[head], parts[k:])
        return _below(F.col(f"`{parts[0]}`"), parts[1:])

    return read


def write(schema: T.StructType, path: str, value: Callable[[Reader], Column], base: Column | None = None) -> Column:
    """The root column of ``path`` with ``value`` written at it, on top of ``base`` where earlier writes are pending.

    Missing structs on the way are made; a missing field below an existing one is added.
    """
    root, *rest = path.split(".")
    known = field(schema, root)
    if not rest:
        return value(reader({}))
    if known is None:
        return _made(rest, value, {})
    column = base if base is not None else F.col(f"`{known.name}`")
    return _written(column, known.dataType, [root], rest, value, {})


def _made(rest: list[str], value: Callable[[Reader], Column], bound: dict[str, Column]) -> Column:
    name, *deeper = rest
    return F.struct((_made(deeper, value, bound) if deeper else value(reader(bound))).alias(name))


def _written(column: Column, kind: T.DataType, done: list[str], rest: list[str], value: Callable[[Reader], Column], bound: dict[str, Column]) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _written(x, kind.elementType, done, rest, value, {**bound, ".".join(done): x}))
    if not isinstance(kind, T.StructType):
        raise PathError(f"'{'.'.join(done)}' is {kind.simpleString()}, not a struct; '{'.'.join(done + rest)}' can't be written")
    name, *deeper = rest
    known = field(kind, name)
    if not deeper:
        return column.withField(f"`{name}`", value(reader(bound)))
    if known is None:
        return column.withField(f"`{name}`", _made(deeper, value, bound))
    return column.withField(f"`{name}`", _written(column.getField(known.name), known.dataType, [*done, known.name], deeper, value, bound))


def write_together(schema: T.StructType, values: Mapping[str, Callable[[Reader], Column]]) -> dict[str, Column]:
    """Root columns with values written at several paths, arrays and structs that paths share walked once; each path is read as it was before."""
    out: dict[str, Column] = {}
    for root in dict.fromkeys(p.split(".")[0].lower() for p in values):
        below = {tuple(p.split(".")[1:]): v for p, v in values.items() if p.split(".")[0].lower() == root}
        known = field(schema, root)
        name = known.name if known else next(p.split(".")[0] for p in values if p.lower().startswith(root))
        if () in below:
            out[name] = below[()](reader({}))
        elif known is None:
            out[name] = _together(None, None, [name], below, {})
        else:
            out[name] = _together(F.col(f"`{known.name}`"), known.dataType, [name], below, {})
    return out


def _together(column: Column | None, kind: T.DataType | None, done: list[str], values: Mapping[tuple[str, ...], Callable[[Reader], Column]], bound: dict[str, Column]) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _together(x, kind.elementType, done, values, {**bound, ".".join(done): x}))
    if kind is not None and not isinstance(kind, T.StructType):
        raise PathError(f"'{'.'.join(done)}' is {kind.simpleString()}, not a struct; nothing can be written into it")
    fields: dict[str, Column] = {}
    for name in dict.fromkeys(p[0].lower() for p in values):
        below = {p[1:]: v for p, v in values.items() if p[0].lower() == name}
        known = field(kind, name) if kind is not None else None
        said = known.name if known else next(p[0] for p in values if p[0].lower() == name)
        if () in below:
            fields[said] = below[()](reader(bound))
        else:
            fields[said] = _together(column.getField(known.name) if known else None, known.dataType if known else None, [*done, said], below, bound)
    if column is None:
        return F.struct(*(v.alias(n) for n, v in fields.items()))
    for name, value in fields.items():
        column = column.withField(f"`{name}`", value)
    return column


def write_all(schema: T.StructType, root: str, values: Mapping[str, Column]) -> Column:
    """The root column with values written at several paths of structs below it (given without the root), each struct changed once."""
    known = field(schema, root)
    return _all(F.col(f"`{known.name}`"), known.dataType, {tuple(p.split(".")): v for p, v in values.items()})


def _all(column: Column | None, kind: T.DataType | None, values: Mapping[tuple[str, ...], Column]) -> Column:
    """``column`` is None for a struct that isn't there yet."""
    fields: dict[str, Column] = {}
    for name in dict.fromkeys(p[0].lower() for p in values):
        below = {p: v for p, v in values.items() if p[0].lower() == name}
        known = field(kind, name) if kind is not None else None
        said = known.name if known else next(iter(below))[0]
        own = [v for p, v in below.items() if len(p) == 1]
        deeper = {p[1:]: v for p, v in below.items() if len(p) > 1}
        fields[said] = own[-1] if own else _all(column.getField(known.name) if known else None, known.dataType if known else None, deeper)
    if column is None:
        return F.struct(*(v.alias(n) for n, v in fields.items()))
    for name, value in fields.items():
        column = column.withField(f"`{name}`", value)
    return column


def with_field(schema: T.StructType, path: str, kind: T.DataType, nullable: bool) -> T.StructType:
    """The schema with a field at a path of structs, in the place of one that is there; missing structs are made."""
    name, _, rest = path.partition(".")
    known = field(schema, name)
    if rest:
        inside = known.dataType if known is not None else T.StructType([])
        new = T.StructField(known.name if known else name, with_field(inside, rest, kind, nullable), known.nullable if known else False)
    else:
        new = T.StructField(known.name if known else name, kind, nullable)
    if known is None:
        return T.StructType([*schema.fields, new])
    return T.StructType([new if f is known else f for f in schema.fields])


def gather(schema: T.StructType, path: str, each: Callable[[Reader], Column], empty: Column) -> Column:
    """One array of what ``each`` gives at every place that ``path`` is written; nothing below null structs and arrays.

    ``empty`` is an empty array of the type that ``each`` gives.
    """
    root, *rest = path.split(".")
    known = field(schema, root)
    if not rest or known is None:
        return F.array(each(reader({})))
    return _gathered(F.col(f"`{known.name}`"), known.dataType, [root], rest, each, {}, empty)


def _gathered(column: Column, kind: T.DataType, done: list[str], rest: list[str], each: Callable[[Reader], Column], bound: dict[str, Column], empty: Column) -> Column:
    if isinstance(kind, T.ArrayType):
        lists = F.transform(column, lambda x: _gathered(x, kind.elementType, done, rest, each, {**bound, ".".join(done): x}, empty))
        return F.coalesce(F.flatten(lists), empty)
    name, *deeper = rest
    known = field(kind, name) if isinstance(kind, T.StructType) else None
    if not deeper or known is None:
        return F.when(column.isNotNull(), F.array(each(reader(bound)))).otherwise(empty)
    return _gathered(column.getField(known.name), known.dataType, [*done, known.name], deeper, each, bound, empty)


def drop(schema: T.StructType, path: str, base: Column | None = None) -> Column:
    """The root column of a nested path without the field at it."""
    root, *rest = path.split(".")
    known = field(schema, root)
    return _dropped(base if base is not None else F.col(f"`{known.name}`"), known.dataType, rest)


def _dropped(column: Column, kind: T.DataType, rest: list[str]) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _dropped(x, kind.elementType, rest))
    known = field(kind, rest[0])
    if len(rest) == 1:
        return column.dropFields(f"`{known.name}`")
    return column.withField(f"`{known.name}`", _dropped(column.getField(known.name), known.dataType, rest[1:]))
