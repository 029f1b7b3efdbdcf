"""The same rules on a stream: a stateless transformation with report date and version from the data or from settings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import paths
from millrace.operators.mapping import Table
from millrace.operators.rules import Rule
from millrace.plans.conform import Options, conform
from millrace.session import lenient_casts

MANDATORY = ("dataset.name", "dataset.version")
CREDENTIALS = ("credentials.file", "auth.keytab")
DEFAULT_PATTERN = "yyyy-MM-dd'T'HH:mm'Z'"


@dataclass
class Settings:
    """The first of date, date column and the time of processing gives the date; of version, version column and 1 the version."""

    date: str | None = None
    date_column: str | None = None
    date_pattern: str = DEFAULT_PATTERN
    version: int | None = None
    version_column: str | None = None
    prefix: str = "info"


def check_settings(conf: Mapping[str, str]) -> Settings:
    """Settings from flat keys; mandatory ones must be there, and exactly one kind of credentials."""
    if missing := [k for k in MANDATORY if not conf.get(k)]:
        raise ValueError(f"missing settings: {', '.join(missing)}")
    if len([k for k in CREDENTIALS if conf.get(k)]) != 1:
        raise ValueError(f"give exactly one of {' and '.join(CREDENTIALS)}")
    version = conf.get("report.version")
    return Settings(conf.get("report.date"), conf.get("event.timestamp.column"), conf.get("event.timestamp.pattern", DEFAULT_PATTERN), int(version) if version else None, conf.get("info.version.column"), conf.get("info.prefix", "info"))


def report_date(schema: T.StructType, settings: Settings) -> Column:
    if settings.date:
        return F.to_date(F.lit(settings.date), "yyyy-MM-dd")
    if not settings.date_column:
        return F.current_date()
    kind, column = paths.type_at(schema, settings.date_column), F.col(settings.date_column)
    if kind is None:
        raise ValueError(f"there is no column '{settings.date_column}'")
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return column.cast("date")
    if isinstance(kind, T.StringType):
        return F.to_date(F.to_timestamp(column, settings.date_pattern))
    raise ValueError(f"'{settings.date_column}' is {kind.simpleString()}, not a timestamp, date or string")


def report_version(schema: T.StructType, settings: Settings) -> Column:
    if settings.version is not None:
        return F.lit(settings.version)
    if settings.version_column:
        if paths.type_at(schema, settings.version_column) is None:
            raise ValueError(f"there is no column '{settings.version_column}'")
        return F.col(settings.version_column).cast("int")
    return F.lit(1)


def conformed(stream: DataFrame, rules: Sequence[Rule], tables: Mapping[str, Table] | None = None, settings: Settings | None = None, options: Options | None = None) -> DataFrame:
    """The conformed stream (or frame) with report date, its text and version.

    A missing date is the day of processing, and its text is empty.
    """
    settings = settings or Settings()
    out = conform(stream, rules, tables, options)
    with lenient_casts(stream.sparkSession):
        date, version = report_date(out.schema, settings), report_version(out.schema, settings)
        text = F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit(""))
        p = settings.prefix
        return out.withColumns({f"{p}_date": F.coalesce(date, F.current_date()), f"{p}_date_string": text, f"{p}_version": version})
