"""Session settings that the conformance plans rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

#: Read when a query runs, so it can't be set for the building of a plan only.
RUNTIME = {"spark.sql.legacy.timeParserPolicy": "LEGACY", "spark.sql.session.timeZone": "UTC"}


def prepare(spark: SparkSession) -> SparkSession:
    """Lenient date patterns and UTC, as declared schemas expect; Python workers find this package wherever they are started."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings that hold inside; what was set before is set again."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def lenient_casts(spark: SparkSession) -> Iterator[None]:
    """Casts built inside give null instead of failing; plans keep what they were built with."""
    with settings(spark, {"spark.sql.ansi.enabled": "false"}):
        yield


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the folder that driver and executors share, ``spark.checkpoint.dir``; in local mode one is made if need be."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = folder or f"file://{tempfile.mkdtemp(prefix='spark-')}"
    return f"{folder.rstrip('/')}/{what}-{uuid.uuid4().hex}"
