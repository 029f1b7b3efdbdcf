"""Raw data in its formats to DataFrames that standardization takes.

Text formats are read with a plain form of the declared schema, whose leaves are strings, so that no value is lost before it is
judged; lines that don't parse stay in a corrupt-record column. Parquet and copybook data keep their own types.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import copybook

FORMATS = ("parquet", "csv", "json", "xml", "fixed-width", "cobol")
CORRUPT = "_corrupt_record"


def character(text: str) -> str:
    """A single-character option: itself, ``none`` for no character, or its code as ``U+00A1``, ``u00a1``, ``\\u00a1`` or ``00A1``."""
    if text.lower() == "none":
        return ""
    code = text.lower().removeprefix("\\").removeprefix("u").removeprefix("+")
    if len(text) > 1 and len(code) == 4 and all(c in "0123456789abcdef" for c in code):
        return chr(int(code, 16))
    return text


def plain(kind: T.DataType) -> T.DataType:
    """The type with strings for all primitives."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.metadata.get("sourcecolumn", f.name), plain(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain(kind.elementType), True)
    return T.StringType()


def corrupt_name(schema: T.StructType) -> str:
    """A name for the corrupt-record column that the schema doesn't use."""
    names, name, k = {f.name.lower() for f in schema.fields}, CORRUPT, 0
    while name.lower() in names:
        k += 1
        name = f"{CORRUPT}_{k}"
    return name


def read(spark: SparkSession, kind: str, path: str | list[str], schema: T.StructType, **options: Any) -> tuple[DataFrame, str | None]:
    """The raw frame, and the name of its corrupt-record column if the format has one."""
    if kind not in FORMATS:
        raise ValueError(f"formats are {', '.join(FORMATS)}, not {kind}")
    if kind == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path)), None
    if kind == "fixed-width":
        return fixed_width(spark, path, schema, **options), None
    if kind == "cobol":
        return copybook.read(spark, path, **options), None
    corrupt = corrupt_name(schema)
    wanted = T.StructType([*plain(schema).fields, T.StructField(corrupt, T.StringType(), True)])
    strict = options.pop("strict", False)
    reader = spark.read.schema(wanted).option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    for name, value in _options(kind, options).items():
        reader = reader.option(name, value)
    if kind == "xml":
        spark.conf.set("spark.sql.legacy.useLegacyXMLParser", "true")  # files hold several root elements
    return reader.format(kind).load(path), corrupt


#: Our options to those of Spark's readers.
_CSV = {"delimiter": "sep", "quote": "quote", "escape": "escape", "header": "header", "charset": "encoding", "null_value": "nullValue", "ignore_leading_white_space": "ignoreLeadingWhiteSpace", "ignore_trailing_white_space": "ignoreTrailingWhiteSpace", "multi_line": "multiLine"}
_JSON = {"charset": "encoding", "multi_line": "multiLine"}
_XML = {"row_tag": "rowTag", "charset": "charset", "null_value": "nullValue"}


def _options(kind: str, given: dict[str, Any]) -> dict[str, Any]:
    known = {"csv": _CSV, "json": _JSON, "xml": _XML}[kind]
    if unknown := set(given) - set(known):
        raise ValueError(f"{kind} has no options {', '.join(sorted(unknown))}")
    if kind == "xml" and not given.get("row_tag"):
        raise ValueError("xml needs row_tag")
    out = {known[k]: character(v) if k in ("delimiter", "quote", "escape") else v for k, v in given.items() if v is not None}
    return {k: str(v).lower() if isinstance(v, bool) else v for k, v in out.items()}


def fixed_width(spark: SparkSession, path: str | list[str], schema: T.StructType, trim: bool = False, empty_as_null: bool = False, null_value: str | None = None, charset: str = "UTF-8") -> DataFrame:
    """Lines cut by the ``width`` of each field; columns are strings."""
    line, columns, at = F.col("value"), [], 1
    if charset.upper().replace("-", "") != "UTF8":
        raw = spark.read.option("encoding", charset).option("sep", "\0").option("quote", "").schema("value string").csv(path)
    else:
        raw = spark.read.text(path)
    for f in schema.fields:
        if "width" not in f.metadata:
            raise ValueError(f"column '{f.name}' has no width")
        width = int(f.metadata["width"])
        value = F.substring(line, at, width)
        value = F.trim(value) if trim else value
        if empty_as_null:
            value = F.when(F.trim(value) != "", value)
        if null_value is not None:
            value = F.when(F.trim(value) != null_value, value)
        columns.append(value.alias(f.metadata.get("sourcecolumn", f.name)))
        at += width
    return raw.select(*columns)


def spread(df: DataFrame, paths: Iterator[str] | list[str], partitions: int | None = None) -> DataFrame:
    """``df`` dealt over more tasks if any of its files can't be split (gzip is read by one task to its end)."""
    if any(p.lower().endswith(".gz") for p in paths):
        return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
    return df
