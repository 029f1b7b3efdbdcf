"""The error functions for SQL: rules written in SQL text call them by name.

They are SQL functions of the session, which the optimizer puts into the plan as the expressions that they are: nothing of them runs in Python.
Spark doesn't take them within lambdas of higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import errors

_MAPPINGS = errors.ERROR["mappings"].dataType.simpleString()
_ERROR, _LIST = errors.ERROR.simpleString(), errors.ERROR_LIST.simpleString()


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _made(kind: tuple[str, str, str], raw: str, mappings: str) -> str:
    of, code, message = map(_quoted, kind)
    return f"CAST(named_struct('errType', {of}, 'errCode', {code}, 'errMsg', {message}, 'errCol', errCol, 'rawValues', {raw}, 'mappings', {mappings}) AS {_ERROR})"


def _single(kind: tuple[str, str, str]) -> tuple[str, str, str]:
    return "errCol STRING, rawValue STRING", _ERROR, _made(kind, "array(rawValue)", f"CAST(array() AS {_MAPPINGS})")


#: Parameters, result and body by name; the names are fixed.
FUNCTIONS = {
    "confMappingErr": (f"errCol STRING, rawValues ARRAY<STRING>, mappings {_MAPPINGS}", _ERROR, _made(errors.CONF_MAP, "rawValues", "mappings")),
    "confCastErr": _single(errors.CONF_CAST),
    "confNegErr": _single(errors.CONF_NEG),
    "confLitErr": _single(errors.CONF_LIT),
    "arrayDistinctErrors": (f"arr {_LIST}", _LIST, f"CAST(coalesce(array_distinct(array_compact(arr)), array()) AS {_LIST})"),
    "errorColumnAppend": (f"arr {_LIST}, err {_ERROR}", _LIST, "array_append(arr, err)"),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to a session, again if need be."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
