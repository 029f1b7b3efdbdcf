"""Migrations of document collections from one version of a model to the next.

A collection is a table of (id, doc), the document a VARIANT. A migration changes the documents of some collections, each by an expression, and may
rename, add or drop collections. Going over several versions composes the expressions of all of them, so each collection is read and
written once, in one projection. Nothing is rewritten: collections of a version stand beside those of others, and the last step makes
the new version the current one by a file that one writer can make. What an interrupted migration left is written anew by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import layout

#: A document to another one, or null for one that is to be dropped.
Transform = Callable[[Column], Column]
_OBJECT, _ARRAY = "map<string,variant>", "array<variant>"


def entries(doc: Column) -> Column:
    """The fields of a document as a map."""
    return F.variant_get(doc, "$", _OBJECT)


def put(doc: Column, name: str, value: Column) -> Column:
    """A document with a field, in place of one that it has."""
    rest = F.map_filter(entries(doc), lambda k, _: k != name)
    return F.to_variant_object(F.map_concat(rest, F.create_map(F.lit(name), value.cast(T.VariantType()))))


def without(doc: Column, *names: str) -> Column:
    return F.to_variant_object(F.map_filter(entries(doc), lambda k, _: ~k.isin(*names)))


def renamed(doc: Column, old: str, new: str) -> Column:
    """A document with a field under another name; without the field it stays as it is."""
    fields = F.map_filter(entries(doc), lambda k, _: k != new)
    return F.when(F.map_contains_key(entries(doc), old), F.to_variant_object(F.transform_keys(fields, lambda k, _: F.when(k == old, new).otherwise(k)))).otherwise(doc)


def each(doc: Column, name: str, change: Transform) -> Column:
    """A document with each element of an array changed; without the array it stays as it is."""
    found = F.try_variant_get(doc, f"$.{name}", _ARRAY)
    return F.when(found.isNotNull(), put(doc, name, F.transform(found, change))).otherwise(doc)


@dataclass(frozen=True)
class Migration:
    """From the version before to ``version``: collections by their new names are changed; ``renames`` goes from old to new names."""

    version: int
    transforms: dict[str, Transform] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    added: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()

    def collections(self, names: Sequence[str]) -> list[str]:
        """Names after the migration of those before it."""
        for what, given in (("drop", self.dropped), ("rename", tuple(self.renames))):
            if missing := [n for n in given if n not in names]:
                raise ValueError(f"migration {self.version} would {what} {', '.join(missing)}, which isn't there")
        out = [self.renames.get(n, n) for n in names if n not in self.dropped]
        if twice := [n for n in (*self.added, *self.renames.values()) if [*out, *self.added].count(n) > 1]:
            raise ValueError(f"migration {self.version} makes {', '.join(twice)}, which is there")
        if missing := [n for n in self.transforms if n not in out]:
            raise ValueError(f"migration {self.version} would change {', '.join(missing)}, which isn't there")
        return [*out, *self.added]


@dataclass
class Documents:
    """Collections below a path, by version of the model."""

    spark: SparkSession
    path: str
    #: Collections of version 0, and the migrations from it.
    names: Sequence[str]
    migrations: Sequence[Migration] = ()

    def __post_init__(self) -> None:
        if [m.version for m in self.migrations] != list(range(1, len(self.migrations) + 1)):
            raise ValueError("there must be one migration for each version, in order, from 1")

    def collections(self, version: int) -> list[str]:
        if not 0 <= version <= len(self.migrations):
            raise ValueError(f"there is no version {version} of the model")
        names = list(self.names)
        for m in self.migrations[:version]:
            names = m.collections(names)
        return names

    def version(self) -> int:
        """The current version: the largest that was finished."""
        return max((int(n) for n in layout.children(self.spark, f"{self.path}/versions")), default=0)

    def at(self, name: str, version: int) -> str:
        return f"{self.path}/{name}" if version == 0 else f"{self.path}/{name}_v{version}"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A collection as (id, doc)."""
        version = self.version() if version is None else version
        if name not in self.collections(version):
            raise KeyError(f"there is no collection {name} in version {version}")
        at = self.at(name, version)
        return self.spark.read.parquet(at) if layout.exists(self.spark, at) else self.spark.createDataFrame([], "id string, doc variant")

    def insert(self, name: str, documents: DataFrame) -> None:
        """Add documents to a collection of the current version."""
        version = self.version()
        if name not in self.collections(version):
            raise KeyError(f"there is no collection {name} in version {version}")
        documents.select("id", "doc").write.mode("append").parquet(self.at(name, version))

    def migrate(self, to: int) -> None:
        """Bring all collections to a version, each in one projection, and make it the current one."""
        begin = self.version()
        if to < begin:
            raise ValueError(f"the documents are of version {begin}, they can't go back to {to}")
        self.collections(to)  # refuses steps that don't fit before anything is written
        changes: dict[str, tuple[str, list[Transform]]] = {n: (n, []) for n in self.collections(begin)}
        for m in self.migrations[begin:to]:
            kept = {m.renames.get(n, n): c for n, c in changes.items() if n not in m.dropped}
            changes = {n: (source, [*steps, *([m.transforms[n]] if n in m.transforms else [])]) for n, (source, steps) in kept.items()}
        for name, (source, steps) in changes.items():
            doc = F.col("doc")
            for step in steps:
                doc = step(doc)
            out = self.read(source, begin).select("id", doc.alias("doc")).where("doc IS NOT NULL")
            if to > begin:
                out.write.mode("overwrite").parquet(self.at(name, to))
        if to > begin and not layout.claim(self.spark, f"{self.path}/versions/{to}"):
            raise ValueError(f"another migration to version {to} was finished meanwhile")
