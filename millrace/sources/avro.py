"""Avro: schemas with named types, their Spark types, and binary values of columns, written and read in Arrow batches.

Data is read with the schema that it was written with and the one that is wanted, by Avro's rules: fields meet by name or alias, new ones take their
defaults, numbers are promoted, unions take the branch that fits. What can't be read so is found when the schemas are compared, before any data is.
"""

from __future__ import annotations

import datetime as dt
import json
import struct
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

PRIMITIVES = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType()}
#: What a reader's number may be of, beside itself.
PROMOTED = {"long": ("int",), "float": ("int", "long"), "double": ("int", "long", "float"), "bytes": ("string",), "string": ("bytes",)}
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)

Write = Callable[[bytearray, Any], None]
Read = Callable[[bytes, int], tuple[Any, int]]


class AvroError(ValueError):
    """A schema that isn't one, or two that don't fit."""


class Schema:
    """A parsed schema: ``root``, in which names stand for the definitions in ``names``."""

    def __init__(self, text: str | dict | list):
        self.names: dict[str, dict] = {}
        doc = json.loads(text) if isinstance(text, str) and text.strip()[:1] in '{["' else text
        self.root = self._parse(doc, "")

    def _parse(self, kind: Any, space: str) -> Any:
        if isinstance(kind, list):
            return [self._parse(k, space) for k in kind]
        if isinstance(kind, str):
            full = kind if kind in PRIMITIVES or kind == "null" or "." in kind or not space else f"{space}.{kind}"
            full = full if full in self.names or "." in kind else full if full in PRIMITIVES or full == "null" else kind if kind in self.names else full
            if full not in PRIMITIVES and full != "null" and full not in self.names:
                raise AvroError(f"unknown Avro type {kind}")
            return full
        if not isinstance(kind, dict) or "type" not in kind:
            raise AvroError(f"not an Avro type: {kind}")
        of = kind["type"]
        if of in ("record", "enum", "fixed", "error"):
            name = kind["name"]
            full = name if "." in name or not kind.get("namespace", space) else f"{kind.get('namespace', space)}.{name}"
            if full in self.names:
                raise AvroError(f"{full} is defined twice")
            out = self.names[full] = {**kind, "type": "record" if of == "error" else of, "name": full}
            if out["type"] == "record":
                inside = full.rpartition(".")[0]
                out["fields"] = [{**f, "type": self._parse(f["type"], inside)} for f in kind["fields"]]
            return full
        if of == "array":
            return {**kind, "items": self._parse(kind["items"], space)}
        if of == "map":
            return {**kind, "values": self._parse(kind["values"], space)}
        if isinstance(of, str) and of in PRIMITIVES:
            return dict(kind)
        return self._parse(of, space)

    def at(self, kind: Any) -> Any:
        """The definition of a name, anything else as it is."""
        return self.names.get(kind, kind) if isinstance(kind, str) else kind

    def of(self, kind: Any) -> str:
        """union, record, enum, fixed, array, map or a primitive."""
        kind = self.at(kind)
        return "union" if isinstance(kind, list) else kind if isinstance(kind, str) else kind["type"]

    def logical(self, kind: Any) -> str | None:
        kind = self.at(kind)
        return kind.get("logicalType") if isinstance(kind, dict) else None

    def type(self, kind: Any = None, around: tuple[str, ...] = ()) -> tuple[T.DataType, bool]:
        """Spark's type and whether it may be null."""
        kind = self.root if kind is None else kind
        of, known, logical = self.of(kind), self.at(kind), self.logical(kind)
        if of == "union":
            some = [k for k in known if k != "null"]
            if len(some) != 1:
                raise AvroError(f"unions of several types are not supported: {kind}")
            return self.type(some[0], around)[0], "null" in known
        if logical == "decimal" and of in ("bytes", "fixed"):
            return T.DecimalType(known["precision"], known.get("scale", 0)), False
        if logical == "date" and of == "int":
            return T.DateType(), False
        if logical in ("timestamp-millis", "timestamp-micros") and of == "long":
            return T.TimestampType(), False
        if of == "record":
            if known["name"] in around:
                raise AvroError(f"{known['name']} holds itself")
            fields = []
            for f in known["fields"]:
                found, null = self.type(f["type"], (*around, known["name"]))
                fields.append(T.StructField(f["name"], found, null, {"default": f["default"]} if f.get("default") is not None else {}))
            return T.StructType(fields), False
        if of == "array":
            element, null = self.type(known["items"], around)
            return T.ArrayType(element, null), False
        if of == "map":
            value, null = self.type(known["values"], around)
            return T.MapType(T.StringType(), value, null), False
        return {"enum": T.StringType(), "fixed": T.BinaryType(), "null": T.NullType()}.get(of) or PRIMITIVES[of], of == "null"


def schema_of(kind: T.StructType, name: str, namespace: str = "") -> dict:
    """An Avro schema of a Spark type; what may be null is a union with null and null by default."""

    def one(kind: T.DataType, name: str) -> Any:
        if isinstance(kind, T.StructType):
            fields = [{"name": f.name, "type": ["null", one(f.dataType, f"{name}_{f.name}")], "default": None} if f.nullable else {"name": f.name, "type": one(f.dataType, f"{name}_{f.name}")} for f in kind.fields]
            return {"type": "record", "name": name, "fields": fields}
        if isinstance(kind, T.ArrayType):
            items = one(kind.elementType, f"{name}_item")
            return {"type": "array", "items": ["null", items] if kind.containsNull else items}
        if isinstance(kind, T.MapType):
            values = one(kind.valueType, f"{name}_value")
            return {"type": "map", "values": ["null", values] if kind.valueContainsNull else values}
        if isinstance(kind, T.DecimalType):
            return {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
        if isinstance(kind, T.DateType):
            return {"type": "int", "logicalType": "date"}
        if isinstance(kind, T.TimestampType):
            return {"type": "long", "logicalType": "timestamp-micros"}
        if isinstance(kind, T.ByteType | T.ShortType):
            return "int"
        return next(n for n, k in PRIMITIVES.items() if k == kind)

    return {**one(kind, name), **({"namespace": namespace} if namespace else {})}


def _put_long(out: bytearray, value: int) -> None:
    value = value << 1 if value >= 0 else (-value << 1) - 1
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)


def _get_long(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value >> 1 ^ -(value & 1), at
        shift += 7


def _unscaled(value: Decimal, scale: int) -> int:
    return int(value.scaleb(scale).to_integral_exact())


def _to_plain(schema: Schema, kind: Any) -> Callable[[Any], Any]:
    """What a logical value is written as."""
    of, logical, known = schema.of(kind), schema.logical(kind), schema.at(kind)
    if logical == "date" and of == "int":
        return lambda v: v if isinstance(v, int) else (v - _EPOCH.date()).days
    if logical in ("timestamp-millis", "timestamp-micros") and of == "long":
        part = dt.timedelta(milliseconds=1) if logical.endswith("millis") else dt.timedelta(microseconds=1)
        return lambda v: v if isinstance(v, int) else ((v if v.tzinfo else v.replace(tzinfo=dt.UTC)) - _EPOCH) // part
    if logical == "decimal" and of in ("bytes", "fixed"):
        size = known.get("size") if of == "fixed" else None

        def decimal(v: Decimal) -> bytes:
            n = _unscaled(v, known.get("scale", 0))
            return n.to_bytes(size or (n + (n < 0)).bit_length() // 8 + 1, "big", signed=True)

        return decimal
    return lambda v: v


def _from_plain(schema: Schema, kind: Any) -> Callable[[Any], Any]:
    of, logical, known = schema.of(kind), schema.logical(kind), schema.at(kind)
    if logical == "date" and of == "int":
        return lambda v: _EPOCH.date() + dt.timedelta(days=v)
    if logical in ("timestamp-millis", "timestamp-micros") and of == "long":
        return lambda v: _EPOCH + (dt.timedelta(milliseconds=v) if logical.endswith("millis") else dt.timedelta(microseconds=v))
    if logical == "decimal" and of in ("bytes", "fixed"):
        return lambda v: Decimal(int.from_bytes(v, "big", signed=True)).scaleb(-known.get("scale", 0))
    return lambda v: v


def writer(schema: Schema, kind: Any = None, path: str = "value") -> Write:
    """A function that appends values of a type to bytes."""
    kind = schema.root if kind is None else kind
    of, known, plain = schema.of(kind), schema.at(kind), _to_plain(schema, kind)
    if of == "union":
        branches = [None if b == "null" else writer(schema, b, path) for b in known]
        null, some = next((i for i, b in enumerate(branches) if b is None), None), next((i for i, b in enumerate(branches) if b is not None), None)

        def union(out: bytearray, v: Any) -> None:
            if v is None and null is None:
                raise AvroError(f"{path} is null")
            _put_long(out, null if v is None else some)
            if v is not None:
                branches[some](out, v)

        return union
    if of == "record":
        fields = [(f["name"], writer(schema, f["type"], f"{path}.{f['name']}")) for f in known["fields"]]

        def record(out: bytearray, v: dict) -> None:
            if v is None:
                raise AvroError(f"{path} is null")
            for name, put in fields:
                put(out, v.get(name))

        return record
    if of in ("array", "map"):
        put = writer(schema, known["items" if of == "array" else "values"], f"{path}[]")

        def several(out: bytearray, v: Any) -> None:
            if v is None:
                raise AvroError(f"{path} is null")
            if v:
                _put_long(out, len(v))
            for each in v.items() if isinstance(v, dict) else v:
                if of == "map":
                    _bytes(out, each[0].encode())
                    each = each[1]
                put(out, each)
            out.append(0)

        return several
    symbols = {s: i for i, s in enumerate(known["symbols"])} if of == "enum" else {}
    puts: dict[str, Write] = {
        "null": lambda out, v: None,
        "boolean": lambda out, v: out.append(1 if v else 0),
        "int": _put_long,
        "long": _put_long,
        "float": lambda out, v: out.extend(struct.pack("<f", v)),
        "double": lambda out, v: out.extend(struct.pack("<d", v)),
        "bytes": _bytes,
        "string": lambda out, v: _bytes(out, v.encode()),
        "fixed": lambda out, v: out.extend(v),
        "enum": lambda out, v: _put_long(out, symbols[v]),
    }
    put = puts[of]

    def checked(out: bytearray, v: Any) -> None:
        if v is None and of != "null":
            raise AvroError(f"{path} is null")
        put(out, plain(v))

    return checked


def _bytes(out: bytearray, v: bytes) -> None:
    _put_long(out, len(v))
    out += v


def _take(size: int) -> Read:
    return lambda data, at: (data[at : at + size], at + size)


def _get_bytes(data: bytes, at: int) -> tuple[bytes, int]:
    size, at = _get_long(data, at)
    return data[at : at + size], at + size


_GET: dict[str, Read] = {
    "null": lambda data, at: (None, at),
    "boolean": lambda data, at: (data[at] == 1, at + 1),
    "int": _get_long,
    "long": _get_long,
    "float": lambda data, at: (struct.unpack_from("<f", data, at)[0], at + 4),
    "double": lambda data, at: (struct.unpack_from("<d", data, at)[0], at + 8),
    "bytes": _get_bytes,
    "string": _get_bytes,
}


def _default(schema: Schema, kind: Any, value: Any) -> Any:
    """A default as it stands in a schema; that of a union is of its first branch."""
    of, known = schema.of(kind), schema.at(kind)
    if of == "union":
        return None if value is None else _default(schema, next(k for k in known if k != "null"), value)
    if of == "record":
        return {f["name"]: _default(schema, f["type"], value.get(f["name"], f.get("default"))) for f in known["fields"]}
    if of == "array":
        return [_default(schema, known["items"], v) for v in value]
    if of == "map":
        return [(k, _default(schema, known["values"], v)) for k, v in value.items()]
    return _from_plain(schema, kind)(value.encode("latin-1") if of in ("bytes", "fixed") else value)


def _short(name: str) -> str:
    return name.rpartition(".")[2]


def resolver(wrote: Schema, wanted: Schema, w: Any = None, r: Any = None, path: str = "value") -> Read:
    """A function that reads what was written with one schema as another one has it; AvroError if their types don't fit."""
    w, r = (wrote.root if w is None else w), (wanted.root if r is None else r)
    of_w, of_r, known_w, known_r = wrote.of(w), wanted.of(r), wrote.at(w), wanted.at(r)
    if of_w == "union":
        branches = [resolver(wrote, wanted, b, r, path) for b in known_w]

        def union(data: bytes, at: int) -> tuple[Any, int]:
            branch, at = _get_long(data, at)
            return branches[branch](data, at)

        return union
    if of_r == "union":
        for branch in sorted(known_r, key=lambda b: wanted.of(b) != of_w):
            try:
                return resolver(wrote, wanted, w, branch, path)
            except AvroError:
                continue
        raise AvroError(f"{path}: {of_w} fits no branch of the union")
    if of_w != of_r and of_w not in PROMOTED.get(of_r, ()):
        raise AvroError(f"{path}: {of_w} can't be read as {of_r}")
    if of_w == "record":
        return _record(wrote, wanted, known_w, known_r, path)
    if of_w in ("array", "map"):
        part = "items" if of_w == "array" else "values"
        get = resolver(wrote, wanted, known_w[part], known_r[part], f"{path}[]")

        def several(data: bytes, at: int) -> tuple[list, int]:
            out: list = []
            count, at = _get_long(data, at)
            while count:
                if count < 0:  # with the block's bytes, which nothing here skips
                    count, (_, at) = -count, _get_long(data, at)
                for _ in range(count):
                    if of_w == "map":
                        key, at = _get_bytes(data, at)
                    value, at = get(data, at)
                    out.append((key.decode(), value) if of_w == "map" else value)
                count, at = _get_long(data, at)
            return out, at

        return several
    if of_w == "enum":
        symbols = [s if s in known_r["symbols"] else known_r.get("default") for s in known_w["symbols"]]
        if None in symbols:
            raise AvroError(f"{path}: {known_w['symbols'][symbols.index(None)]} is no symbol of {_short(known_r['name'])}")

        def enum(data: bytes, at: int) -> tuple[str, int]:
            place, at = _get_long(data, at)
            return symbols[place], at

        return enum
    if of_w == "fixed" and known_w["size"] != known_r["size"]:
        raise AvroError(f"{path}: {known_w['size']} bytes can't be read as {known_r['size']}")
    if wrote.logical(w) == wanted.logical(r) == "decimal" and known_w.get("scale", 0) != known_r.get("scale", 0):
        raise AvroError(f"{path}: decimals of scale {known_w.get('scale', 0)} can't be read with scale {known_r.get('scale', 0)}")
    get, plain = _take(known_w["size"]) if of_w == "fixed" else _GET[of_w], _from_plain(wanted, r)
    change = {"float": float, "double": float, "string": bytes.decode}.get(of_r, lambda v: v)

    def one(data: bytes, at: int) -> tuple[Any, int]:
        value, at = get(data, at)
        return plain(change(value)), at

    return one


def _record(wrote: Schema, wanted: Schema, w: dict, r: dict, path: str) -> Read:
    if _short(w["name"]) != _short(r["name"]) and w["name"] not in r.get("aliases", ()) and _short(w["name"]) not in map(_short, r.get("aliases", ())):
        raise AvroError(f"{path}: {w['name']} can't be read as {r['name']}")
    by_name = {n: f for f in r["fields"] for n in (*f.get("aliases", ()), f["name"])}
    steps: list[tuple[str | None, Read]] = []
    for f in w["fields"]:
        target = by_name.get(f["name"])
        if target is None:
            steps.append((None, resolver(wrote, wrote, f["type"], f["type"], f"{path}.{f['name']}")))
        else:
            steps.append((target["name"], resolver(wrote, wanted, f["type"], target["type"], f"{path}.{target['name']}")))
    there = {name for name, _ in steps}
    defaults = {}
    for f in r["fields"]:
        if f["name"] not in there:
            if "default" not in f:
                raise AvroError(f"{path}.{f['name']} wasn't written and has no default")
            defaults[f["name"]] = _default(wanted, f["type"], f["default"])

    def record(data: bytes, at: int) -> tuple[dict, int]:
        out = dict(defaults)
        for name, get in steps:
            value, at = get(data, at)
            if name is not None:
                out[name] = value
        return out, at

    return record


def problems(wrote: str | dict, wanted: str | dict) -> list[str]:
    """Why data of one schema can't be read with another; nothing if it can."""
    try:
        resolver(Schema(wrote), Schema(wanted))
    except AvroError as e:
        return [str(e)]
    return []


def encode(column: Column, schema: str | dict, schema_id: int | None = None) -> Column:
    """Binary values of a struct column; with an id, behind the zero byte and four bytes by which registries' clients know a schema."""
    head = b"" if schema_id is None else b"\0" + schema_id.to_bytes(4, "big")
    writer(Schema(schema))  # refuses a schema before there is data

    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        put = writer(Schema(schema))
        for values in batches:
            out = []
            for v in values.to_pylist():
                data = None if v is None else bytearray(head)
                if data is not None:
                    put(data, v)
                out.append(None if data is None else bytes(data))
            yield pa.array(out, pa.binary())

    return F.arrow_udf(encoded, T.BinaryType())(column)


def _open(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as Arrow's maps have them."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _open(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_open(kind.elementType))
    return T.MapType(kind.keyType, _open(kind.valueType)) if isinstance(kind, T.MapType) else kind


def decode(column: Column, wrote: str | dict, wanted: str | dict | None = None, framed: bool = False) -> Column:
    """Structs of binary values, as the wanted schema has them; schemas that don't fit are refused before there is data."""
    wanted = wrote if wanted is None else wanted
    resolver(Schema(wrote), Schema(wanted))
    kind, start = _open(Schema(wanted).type()[0]), 5 if framed else 0

    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = resolver(Schema(wrote), Schema(wanted))
        arrow = to_arrow_type(kind)
        for values in batches:
            yield pa.array([None if v is None else get(v, start)[0] for v in values.to_pylist()], arrow)

    return F.arrow_udf(decoded, kind)(column)
