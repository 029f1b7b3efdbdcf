"""The error column: an array of what went wrong in a row, which is never dropped for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERRORS = "errCol"
MAPPING = T.StructType([T.StructField("mappingTableColumn", T.StringType()), T.StructField("mappedDatasetColumn", T.StringType())])
ERROR = T.StructType([
    T.StructField("errType", T.StringType()),
    T.StructField("errCode", T.StringType()),
    T.StructField("errMsg", T.StringType()),
    T.StructField("errCol", T.StringType()),
    T.StructField("rawValues", T.ArrayType(T.StringType())),
    T.StructField("mappings", T.ArrayType(MAPPING)),
])
ERROR_LIST = T.ArrayType(ERROR)
_TYPE = ERROR_LIST.simpleString()

#: Type, code and message of each kind of error.
STD_CAST = ("stdCastError", "E00000", "Standardization Error - Type cast")
CONF_MAP = ("confMapError", "E00001", "Conformance Error - Null produced by mapping conformance rule")
STD_NULL = ("stdNullError", "E00002", "Standardization Error - Null detected in non-nullable attribute")
CONF_CAST = ("confCastError", "E00003", "Conformance Error - Null returned by casting conformance rule")
CONF_NEG = ("confNegError", "E00004", "Conformance Error - Negation of numeric type with minimum value overflows and remains unchanged")
CONF_LIT = ("confLitError", "E00005", "Conformance Error - Special column value has changed")
STD_TYPE = ("stdTypeError", "E00006", "Standardization Error - Type '{}' cannot be cast to '{}'")
STD_SCHEMA = ("stdSchemaError", "E00007", "The input data does not adhere to requested schema")


def none() -> Column:
    """An empty error list."""
    return F.array().cast(_TYPE)


def error(kind: tuple[str, str, str], column: str | None, raw: Sequence[Column], mappings: Sequence[tuple[str, str]] = (), words: Sequence[str] = ()) -> Column:
    """An error; ``words`` fill the message."""
    of, code, message = kind
    pairs = F.array(*(F.struct(F.lit(a), F.lit(b)) for a, b in mappings)) if mappings else F.array()
    values = F.array(*(r.cast("string") for r in raw)) if raw else F.array()
    return F.struct(F.lit(of), F.lit(code), F.lit(message.format(*words)), F.lit(column), values, pairs).cast(ERROR.simpleString())


def joined(*lists: Column) -> Column:
    """One list of the distinct errors of several, in order; a null list has none."""
    return F.array_distinct(F.array_compact(F.concat(*(F.coalesce(x, none()) for x in lists)))).cast(_TYPE)


def with_errors(df: DataFrame, nullable: bool | None = None) -> DataFrame:
    """``df`` with an error column; an existing one is kept and must have the right type."""
    if ERRORS in df.columns:
        if df.schema[ERRORS].dataType.simpleString() != _TYPE:
            raise TypeError(f"{ERRORS} is {df.schema[ERRORS].dataType.simpleString()} instead of {_TYPE}")
        return df
    return with_nullability(df.withColumn(ERRORS, none()), nullable)


def with_nullability(df: DataFrame, nullable: bool | None) -> DataFrame:
    """``df`` with the error column declared nullable or not; None leaves it as it is."""
    if nullable in (None, df.schema[ERRORS].nullable):
        return df
    kinds = [T.StructField(f.name, f.dataType, nullable, f.metadata) if f.name == ERRORS else f for f in df.schema.fields]
    value = F.when(F.col(ERRORS).isNotNull(), F.col(ERRORS)) if nullable else F.coalesce(ERRORS, none())
    return df.withColumn(ERRORS, value).to(T.StructType(kinds))


def counted() -> dict[str, Column]:
    """Aggregates: records, records with and without errors, and all errors."""
    n = F.greatest(F.coalesce(F.size(F.col(ERRORS)), F.lit(0)), F.lit(0))
    return {"records": F.count("*"), "failed": F.count_if(n > 0), "succeeded": F.count_if(n == 0), "errors": F.coalesce(F.sum(n), F.lit(0))}


def statistics(df: DataFrame) -> DataFrame:
    """One row of the counts."""
    return df.agg(*(v.alias(k) for k, v in counted().items()))


def exploded(df: DataFrame, *columns: str) -> DataFrame:
    """One row per error with the given columns, for error reports and message sinks."""
    return df.select(*columns, F.explode(ERRORS).alias("error")).select(*columns, "error.*")
