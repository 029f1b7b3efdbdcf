"""Array functions beside the built-in ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import paths


def zip_with_order(array: Column) -> Column:
    """Elements with their position from 0; null stays null."""
    return F.transform(array, lambda x, i: F.struct(i.alias("order"), x.alias("element")))


def flatten_arrays(array: Column) -> Column:
    """One level less; null inner arrays are skipped, null elements kept, null stays null."""
    return F.flatten(F.filter(array, lambda x: x.isNotNull()))


def distinct_without_nulls(array: Column) -> Column:
    return F.array_distinct(F.array_compact(array))


def array_transform(df: DataFrame, path: str, change: Callable[[Column], Column]) -> DataFrame:
    """``df`` with every element of the array at ``path`` changed, in order; the path may lead through other arrays."""
    root = path.split(".")[0]
    return df.withColumn(root, paths.write(df.schema, path, lambda read: F.transform(read(path), change)))


def nested_with_column(df: DataFrame, path: str, value: Column) -> DataFrame:
    """``df`` with a value at a path; missing structs are made."""
    return df.withColumn(path.split(".")[0], paths.write(df.schema, path, lambda _: value))


def nested_drop(df: DataFrame, path: str) -> DataFrame:
    """``df`` without the field at a path of structs; a missing field is left out, an array on the way is refused."""
    if paths.type_at(df.schema, path) is None:
        return df
    if paths.arrays_of(df.schema, path):
        raise paths.PathError(f"'{path}' leads through an array")
    if "." not in path:
        return df.drop(path)
    return df.withColumn(path.split(".")[0], paths.drop(df.schema, path))
