"""Publishing a version of a report so that readers see all of it or nothing.

A job claims its version by a file that only one writer can make, writes below ``_staging``, which readers don't look into, and at the end moves the whole
folder to its place with one rename. Of jobs that run at once each gets a version of its own; one that is killed leaves its claim and what it staged, which
``recover`` clears away once they are old. Names that begin with an underscore are hidden from Spark's readers.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from . import layout

STAGING, CLAIMS = "_staging", "_claims"


class Taken(FileExistsError):
    """A version that is published, or that another job is about to publish."""


@dataclass
class Publication:
    """A claimed version: ``staged`` is where it is written, ``path`` where it will be."""

    spark: SparkSession
    base: str
    version: int
    claim: str
    staged: str
    path: str

    def commit(self) -> str:
        """Let readers see what was staged."""
        layout.move(self.spark, self.staged, self.path)
        layout.delete(self.spark, self.claim)
        return self.path

    def abort(self) -> None:
        """Leave nothing, and the version to others."""
        layout.delete(self.spark, self.staged)
        layout.delete(self.spark, self.claim)


def _folder(base: str, prefix: str | None) -> str:
    return "/".join([base.rstrip("/"), *([prefix.strip("/")] if prefix else [])])


def _claims(spark: SparkSession, base: str, date: dt.date, prefix: str | None, info: str) -> str:
    return f"{_folder(base, prefix)}/{CLAIMS}/{info}_date={date:%Y-%m-%d}"


def begin(spark: SparkSession, base: str, date: dt.date, version: int | None = None, prefix: str | None = None, info: str = "info") -> Publication:
    """Claim a version: the given one, or the next after all that are published or claimed."""
    if version is not None and version <= 0:
        raise ValueError(f"report versions begin with 1, not {version}")
    claims = _claims(spark, base, date, prefix, info)
    wanted = version
    while True:
        if version is None:
            held = [int(n) for n in layout.children(spark, claims) if n.isdigit()]
            wanted = max([layout.next_version(spark, base, date, prefix, info), *(n + 1 for n in held)])
        claim, path = f"{claims}/{wanted}", layout.publish_path(base, date, wanted, prefix, info)
        free = layout.claim(spark, claim)
        if free and layout.exists(spark, path):  # published since, or before claims were made
            layout.delete(spark, claim)
            free = False
            if version is None:
                continue
        if free:
            staged = f"{_folder(base, prefix)}/{STAGING}/{date:%Y-%m-%d}-{wanted}-{uuid.uuid4().hex}"
            return Publication(spark, base, wanted, claim, staged, path)
        if version is not None:
            raise Taken(f"{path} already exists or is being published")


def recover(spark: SparkSession, base: str, older_than: dt.timedelta, prefix: str | None = None, info: str = "info") -> list[str]:
    """Clear away what jobs left that didn't come to their end: claims and staged folders that nothing has been written to for a while."""
    gone, before = [], (time.time() - older_than.total_seconds()) * 1000
    files, staging = layout._hadoop(spark, f"{_folder(base, prefix)}/{STAGING}")
    for status in files.listStatus(staging) if files.exists(staging) else ():
        at = status.getPath()
        if _last_change(files, at) < before:
            files.delete(at, True)
            gone.append(at.getName())
    files, claims = layout._hadoop(spark, f"{_folder(base, prefix)}/{CLAIMS}")
    live = {n.rsplit("-", 1)[0] for n in layout.children(spark, f"{_folder(base, prefix)}/{STAGING}")}
    for date in files.listStatus(claims) if files.exists(claims) else ():
        for status in files.listStatus(date.getPath()):
            day, number = re.sub(r"^.*=", "", date.getPath().getName()), status.getPath().getName()
            if status.getModificationTime() < before and f"{day}-{number}" not in live:
                files.delete(status.getPath(), False)
                gone.append(f"{day} {number}")
    return sorted(gone)


def _last_change(files, at) -> int:
    """The latest change below a path; its files are few beside what they hold."""
    status, latest = files.getFileStatus(at), 0
    latest = status.getModificationTime()
    if status.isDirectory():
        for inner in files.listStatus(at):
            latest = max(latest, _last_change(files, inner.getPath()))
    return latest
