"""Declared schemas in their forms: Spark's JSON, Avro, copybooks, and the catalog's field documents."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import types as T

from . import avro, copybook

FORMS = ("struct", "avro", "copybook")


def parse(text: str, form: str | None = None) -> T.StructType:
    """A schema from its text; without a form it is taken for Spark's JSON."""
    form = (form or "struct").strip().lower() or "struct"
    if form not in FORMS:
        raise ValueError(f"schema forms are {', '.join(FORMS)}, not {form}")
    if form == "copybook":
        return copybook.schema(copybook.parse(text))
    doc = json.loads(text)
    return T.StructType.fromJson(doc) if form == "struct" else from_avro(doc)


def from_avro(doc: dict[str, Any]) -> T.StructType:
    """A record schema, with types that are named again; a union with null is a nullable field."""
    schema = avro.Schema(doc)
    if schema.of(schema.root) != "record":
        raise ValueError("the Avro schema is not a record")
    return schema.type()[0]


def to_documents(schema: T.StructType, head: str = "") -> list[dict[str, Any]]:
    """Field documents of the catalog: name, type, absolute path, nullability, metadata, and the fields within."""
    return [_document(f, head) for f in schema.fields]


def _document(f: T.StructField, head: str) -> dict[str, Any]:
    path, kind = f"{head}{f.name}", f.dataType
    doc: dict[str, Any] = {"name": f.name, "path": path, "nullable": f.nullable, "metadata": dict(f.metadata), "type": _simple(kind), "children": []}
    if isinstance(kind, T.ArrayType):
        doc |= {"elementType": _simple(kind.elementType), "containsNull": kind.containsNull}
        inner = kind.elementType
        if isinstance(inner, T.ArrayType):
            doc["children"] = [_document(T.StructField("", inner, kind.containsNull), f"{path}.")]
        elif isinstance(inner, T.StructType):
            doc["children"] = to_documents(inner, f"{path}.")
    elif isinstance(kind, T.StructType):
        doc["children"] = to_documents(kind, f"{path}.")
    return doc


def _simple(kind: T.DataType) -> str:
    return kind.typeName() if isinstance(kind, T.StructType | T.ArrayType) else kind.jsonValue()


def from_documents(documents: list[dict[str, Any]]) -> T.StructType:
    return T.StructType([T.StructField(d["name"], _type(d), d.get("nullable", True), d.get("metadata", {})) for d in documents])


def _type(d: dict[str, Any]) -> T.DataType:
    if d["type"] == "struct":
        return from_documents(d["children"])
    if d["type"] == "array":
        element = d["elementType"]
        inner = from_documents(d["children"]) if element == "struct" else _type(d["children"][0]) if element == "array" else _primitive(element)
        return T.ArrayType(inner, d.get("containsNull", True))
    return _primitive(d["type"])


def _primitive(name: str) -> T.DataType:
    return T.StructType.fromJson({"type": "struct", "fields": [{"name": "x", "type": name, "nullable": True, "metadata": {}}]}).fields[0].dataType


def renames(schema: T.StructType, target: str = "", source: str = "") -> dict[str, str]:
    """Target path to source path, for all fields that are renamed or lie within renamed ones."""
    out = {}
    for f in schema.fields:
        mine, theirs = f"{target}{f.name}", f"{source}{f.metadata.get('sourcecolumn', f.name)}"
        if mine != theirs:
            out[mine] = theirs
        kind = f.dataType
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            out |= renames(kind, f"{mine}.", f"{theirs}.")
    return out
