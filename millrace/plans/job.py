"""Jobs: read raw data, standardize it, conform it, write and measure, run after one another or together."""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json
import time
import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import rules as R
from millrace.operators.mapping import Table
from millrace.session import prepare, settings
from millrace.sources import layout, publish, readers

from . import conform as C
from . import measures as M
from . import sizing
from . import standardize as S
from .lifecycle import Run, RunLog, counts

PostProcessor = Callable[[DataFrame, Mapping[str, Any]], DataFrame | None]


@dataclass
class Job:
    """What a run is about and where its data is."""

    dataset: str
    version: int
    date: dt.date
    schema: T.StructType
    raw_path: str
    standardized_path: str
    published_path: str
    report_version: int | None = None
    rules: Sequence[R.Rule] = ()
    tables: Mapping[str, Table] = field(default_factory=dict)
    format: str = "parquet"
    format_options: Mapping[str, Any] = field(default_factory=dict)
    prefix: str | None = None
    record_id: str = "none"
    controls: tuple[M.Control, ...] = (M.Control("recordCount", "count"),)
    count_validation: str = "none"
    partition_bytes: int | None = None
    #: How the size of what is written is told (a name of ``sizing``), the window of bytes of a partition, and the rows of a sample.
    partition_strategy: str | None = None
    partition_least: int | None = None
    partition_most: int | None = None
    partition_sample: int = 10_000
    clean_standardized: bool = False
    fail_fast: bool = False
    strict_conformance: bool = True
    checkpoint_listeners: Sequence[Callable[[M.Measures], None]] = ()
    post_processors: Sequence[PostProcessor] = ()
    on_status: Callable[[str, str], None] | None = None
    #: Folder of the run log, and how a conformed frame is kept while it is written and measured (a name of Spark's storage levels).
    run_log: str | None = None
    persist: str | None = None
    #: File that gets the seconds, records and bytes of the last stage.
    performance_file: str | None = None
    #: Folder of the raw data, instead of that of the date below ``raw_path``.
    raw_folder: str | None = None


def _measures(spark: SparkSession, job: Job, folder: str) -> M.Measures:
    if layout.exists(spark, f"{folder.rstrip('/')}/{M.INFO_FILE}"):
        found = M.Measures.read(spark, folder, controls=job.controls)
    else:
        found = M.Measures(controls=job.controls)
    found.listeners = list(job.checkpoint_listeners)
    return found


def write_sized(df: DataFrame, path: str, partition_bytes: int | None) -> None:
    """Write ``df`` where nothing is yet, in files of about a size, which the optimizer deals out when it has seen the data."""
    if partition_bytes is None:
        layout.write_new(df, path)
        return
    with settings(df.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes)}):
        layout.write_new(df.hint("rebalance"), path)


def write_out(df: DataFrame, path: str, job: Job) -> None:
    """Write what a stage made in files of the sizes that the job asks for."""
    if job.partition_strategy:
        df = sizing.resized(df, job.partition_strategy, job.partition_least, job.partition_most, job.partition_sample)
    write_sized(df, path, job.partition_bytes)


class _Stage:
    """One stage of a job: tells listeners and the run log how it goes."""

    def __init__(self, spark: SparkSession, job: Job, name: str, run: Run | None, last: str):
        self.spark, self.job, self.name, self.run, self.last, self.started = spark, job, name, run, last, time.time()
        self.log = RunLog(spark, job.run_log) if job.run_log else None

    def __enter__(self) -> _Stage:
        if self.log and self.run is None:
            self.run = self.log.start(self.job.dataset, self.job.version, self.job.date, self.job.report_version)
        self.tell("running")
        return self

    def tell(self, status: str) -> None:
        if self.job.on_status:
            try:
                self.job.on_status(self.name, status)
            except Exception as e:  # noqa: BLE001 a listener must not end the job
                warnings.warn(f"a status listener failed: {e}", stacklevel=2)

    def log_status(self, status: str, measures: M.Measures | None = None, report_version: int | None = None) -> None:
        if self.log:
            about = {**measures.metadata, **counts(measures.checkpoints), "checkpoints": measures.checkpoints} if measures else None
            self.log.add(self.run, time.time_ns(), status, about, report_version)

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            self.log_status("failed")
        self.tell("failed" if kind is not None else self.last)

    def finish(self, measures: M.Measures, out: DataFrame, path: str, read_bytes: int, publication: publish.Publication | None = None) -> DataFrame:
        """Checkpoint, statistics and metadata of what was written, in one pass over it; then it is published, and post-processors get it as it is read again."""
        spark, job = self.spark, self.job
        written = spark.read.parquet(path)
        stats = measures.finish(f"{self.name} - End", written, out)
        made = layout.size(spark, path)
        about = {"elapsed_seconds": round(time.time() - self.started, 1), "columns": len(written.columns), "input_bytes": read_bytes, "output_bytes": made, "size_ratio": round(made / read_bytes, 4) if read_bytes else None, "executors": max(1, spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1)}
        measures.metadata |= {f"{self.name.lower()}_{k}": v for k, v in {**stats, **about}.items()} | {"dataset": job.dataset, "dataset_version": job.version, "records": stats["records"], "errors": stats["errors"]}
        measures.write(spark, path)
        if publication is not None:
            written = spark.read.parquet(publication.commit())
        if job.performance_file:
            layout.write_text(spark, job.performance_file, "".join(f"{k}={v}\n" for k, v in {"stage": self.name, **stats, **about}.items()))
        for process in job.post_processors:
            out = process(written, {"dataset": job.dataset, "version": job.version, "stage": self.name, "date": job.date, "run": self.run})
            written = out if isinstance(out, DataFrame) else written
        self.log_status(self.last, measures, publication.version if publication else None)
        return written


def standardize(spark: SparkSession, job: Job, run: Run | None = None) -> DataFrame:
    """Raw data to the standardized path."""
    prepare(spark)
    with _Stage(spark, job, "Standardization", run, "stageSucceeded") as stage:
        folder = job.raw_folder or layout.raw_path(job.raw_path, job.date, job.report_version or 1, job.prefix)
        measures = _measures(spark, job, folder)
        raw, corrupt = readers.read(spark, job.format, folder, job.schema, **job.format_options)
        raw = readers.spread(raw, layout.children(spark, folder))
        M.check_counts(measures, job.count_validation)
        out = S.standardize(raw, job.schema, S.Options(fail_fast=job.fail_fast, record_id=job.record_id, corrupt_column=corrupt))
        write_out(out, job.standardized_path, job)
        return stage.finish(measures, out, job.standardized_path, layout.size(spark, folder))


def conform(spark: SparkSession, job: Job, run: Run | None = None) -> DataFrame:
    """Standardized data to the published path, report date and version among its columns."""
    prepare(spark)
    with _Stage(spark, job, "Conformance", run, "allSucceeded") as stage:
        publication = publish.begin(spark, job.published_path, job.date, job.report_version, job.prefix)
        try:
            source, measures = spark.read.parquet(job.standardized_path), _measures(spark, job, job.standardized_path)
            out = C.conform(source, job.rules, job.tables, C.Options(on_checkpoint=measures.observe))
            out = C.with_info(S.with_record_id(out, job.record_id), F.lit(job.date), F.lit(publication.version))
            kept = out.persist(getattr(StorageLevel, job.persist)) if job.persist else None
            write_out(out, publication.staged, job)
            if kept is not None:
                kept.unpersist()
            written = stage.finish(measures, out, publication.staged, layout.size(spark, job.standardized_path), publication)
        except BaseException:
            publication.abort()
            raise
        if job.clean_standardized:
            layout.delete(spark, job.standardized_path)
        return written


def both(spark: SparkSession, job: Job) -> DataFrame:
    """Both stages as one run."""
    run = RunLog(spark, job.run_log).start(job.dataset, job.version, job.date, job.report_version) if job.run_log else None
    standardize(spark, job, run)
    return conform(spark, job, run)


def plugins(conf: Mapping[str, str], key: str) -> list[Any]:
    """Objects named ``module:attribute`` by ``key.1``, ``key.2`` and so on, up to the first gap."""
    found, n = [], 1
    while name := conf.get(f"{key}.{n}"):
        module, _, attribute = name.partition(":")
        found.append(getattr(importlib.import_module(module), attribute))
        n += 1
    return found


def _positive(text: str) -> int:
    if not text.isdigit() or int(text) == 0:
        raise argparse.ArgumentTypeError(f"{text} is not a number above 0")
    return int(text)


def _truth(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise argparse.ArgumentTypeError(f"{text} is neither true nor false")
    return text.lower() == "true"


#: Options of raw formats on the command line: the formats that have them, their names in the library, and how they are read.
FORMAT_OPTIONS: dict[str, tuple[tuple[str, ...], str, Callable[[str], Any]]] = {
    "charset": (("csv", "json", "xml", "cobol", "fixed-width"), "charset", str),
    "delimiter": (("csv",), "delimiter", str),
    "header": (("csv",), "header", _truth),
    "csv-quote": (("csv",), "quote", str),
    "csv-escape": (("csv",), "escape", str),
    "null-value": (("csv", "xml", "fixed-width"), "null_value", str),
    "row-tag": (("xml",), "row_tag", str),
    "trim-values": (("fixed-width",), "trim", _truth),
    "empty-values-as-nulls": (("fixed-width",), "empty_as_null", _truth),
    "copybook": (("cobol",), "copybook", str),
    "cobol-encoding": (("cobol",), "encoding", str),
    "cobol-is-text": (("cobol",), "is_text", _truth),
    "cobol-trimming-policy": (("cobol",), "trimming", str),
    "is-xcom": (("cobol",), "xcom", _truth),
    "strict-schema-check": (("csv", "json", "xml"), "strict", _truth),
}


def _format_options(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    """Options of the raw format; those of other formats are refused. A copybook is given by its path."""
    out: dict[str, Any] = {k: {"true": True, "false": False}.get(v.lower(), v) for k, v in (o.split("=", 1) for o in args.option)}
    for flag, (formats, name, _) in FORMAT_OPTIONS.items():
        value = getattr(args, flag.replace("-", "_"))
        if value is None:
            continue
        if args.raw_format not in formats:
            raise ValueError(f"--{flag} is an option of {', '.join(formats)}, not of {args.raw_format}")
        out[name] = layout.read_text(spark, value) if flag == "copybook" else value
    return out


def _dated(pattern: str) -> str:
    """A pattern of year, month and day for ``layout.mapping_table``."""
    return pattern.replace("{0}", "{0:%Y}").replace("{1}", "{0:%m}").replace("{2}", "{0:%d}")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="millrace", description="Standardize and conform a dataset.")
    out.add_argument("stage", choices=("standardize", "conform", "both"))
    out.add_argument("--dataset-file", required=True, help="JSON with name, version, schema, conformance and paths")
    out.add_argument("--report-date", required=True, type=dt.date.fromisoformat)
    out.add_argument("--dataset-name", help="refuse a document of another name")
    out.add_argument("--dataset-version", type=_positive, help="refuse a document of another version")
    out.add_argument("--report-version", type=_positive)
    login = out.add_mutually_exclusive_group()
    login.add_argument("--credentials-file", help="file with a user's name and password for the catalog's service")
    login.add_argument("--auth-keytab", help="keytab for the catalog's service")
    out.add_argument("--raw-format", default="parquet", choices=readers.FORMATS)
    out.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="an option of the raw format by its name in the library")
    for flag, (formats, _, kind) in FORMAT_OPTIONS.items():
        out.add_argument(f"--{flag}", type=kind, help=f"of {', '.join(formats)}")
    out.add_argument("--standardized-path", help="where standardized data goes; {0} name, {1} version, {2} report date, {3} report version")
    out.add_argument("--debug-set-raw-path", help="folder of the raw data, instead of that of the date")
    out.add_argument("--mapping-table-pattern", default="reportDate={0}-{1}-{2}", help="folder of a mapping table's date: {0} year, {1} month, {2} day; nothing for no folder")
    out.add_argument("--folder-prefix")
    out.add_argument("--record-id", default="none", choices=S.RECORD_IDS)
    out.add_argument("--count-validation", default="none", choices=("strict", "warning", "none"))
    out.add_argument("--partition-bytes", type=_positive)
    out.add_argument("--partition-strategy", choices=sizing.STRATEGIES, help="what tells how much is written")
    out.add_argument("--partition-least", type=_positive, help="bytes of a partition at least")
    out.add_argument("--partition-most", type=_positive, help="bytes of a partition at most")
    out.add_argument("--partition-sample", type=_positive, default=10_000, help="rows of a sample")
    out.add_argument("--auto-clean", action="store_true")
    out.add_argument("--strict", action="store_true", help="fail where a shape doesn't fit")
    out.add_argument("--run-log", help="folder of the run log")
    out.add_argument("--performance-file", help="file that gets seconds, records and bytes")
    out.add_argument("--persist", help="storage level of the conformed data while it is written, as MEMORY_AND_DISK")
    return out


def from_arguments(spark: SparkSession, argv: Sequence[str]) -> tuple[str, Job]:
    args = parser().parse_args(argv)
    doc = json.loads("\n".join(r.value for r in spark.read.text(args.dataset_file).collect()))
    for name, given in (("name", args.dataset_name), ("version", args.dataset_version)):
        if given is not None and given != doc[name]:
            raise ValueError(f"{args.dataset_file} has the {name} {doc[name]}, not {given}")
    reference = layout.MappingTables(spark, args.report_date)
    pattern = _dated(args.mapping_table_pattern)
    tables = {t["name"]: Table(reference.get(t["path"], pattern), {d["columnName"]: d["value"] for d in t.get("defaultMappingValue", [])}, R.filters.from_json(t.get("filter"))) for t in doc.get("mappingTables", [])}
    standardized = (args.standardized_path or doc["standardizedPath"]).format(doc["name"], doc["version"], args.report_date, args.report_version or 1)
    options = _format_options(spark, args)
    return args.stage, Job(
        doc["name"], doc["version"], args.report_date, T.StructType.fromJson(doc["schema"]), doc["rawPath"], standardized, doc["publishedPath"],
        args.report_version, [R.from_json(r) for r in doc.get("conformance", [])], tables, args.raw_format, options, args.folder_prefix, args.record_id,
        count_validation=args.count_validation, partition_bytes=args.partition_bytes, clean_standardized=args.auto_clean, fail_fast=args.strict,
        checkpoint_listeners=plugins(doc, "checkpointPlugin"), post_processors=plugins(doc, "postProcessor"),
        run_log=args.run_log, persist=args.persist, performance_file=args.performance_file,
        partition_strategy=args.partition_strategy, partition_least=args.partition_least, partition_most=args.partition_most, partition_sample=args.partition_sample,
        raw_folder=args.debug_set_raw_path,
    )


def main(argv: Sequence[str]) -> None:
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    stage, job = from_arguments(spark, argv)
    {"standardize": standardize, "conform": conform, "both": both}[stage](spark, job)
