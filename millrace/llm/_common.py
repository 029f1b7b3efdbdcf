"""What the training-data operators share: session settings, shared folders, skew-safe joins."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch: bounds a Python worker's memory whatever the length of the texts.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Environment of Python workers: one thread for each task, and memory of batches that are done with goes back to the system.
LEAN = {"TOKENIZERS_PARALLELISM": "false", "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576"}
#: A group is heavy from this share of all rows on; there can be no more than HEAVY such groups, so they may be broadcast.
HEAVY = 1000


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and let Python workers started from another folder import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    for name, value in LEAN.items():
        env.setdefault(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or in local mode a temporary one."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def work_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file in any store that Spark reaches; None if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in any store that Spark reaches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def cut(df: DataFrame) -> DataFrame:
    """Compute once, into the shared folder: what follows survives lost executors and doesn't repeat the work above."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to one row per group, whatever share of the rows a group holds.

    ``size`` is the number of ``rows`` in a group and ``total`` their sum, so at most HEAVY groups
    can reach total / HEAVY rows: those few are broadcast, the others are small and meet in a shuffle.
    """
    limit = max(2, total // HEAVY + 1)
    heavy, light = groups.where(F.col(size) >= limit), groups.where(F.col(size) < limit)
    hot_keys = F.broadcast(heavy.select(key))
    return rows.join(F.broadcast(heavy), key).unionByName(rows.join(hot_keys, key, "left_anti").join(light, key))


def words_of(text) -> F.Column:
    """Number of maximal runs without space, tab, line or page breaks; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def spans_text(spans) -> F.Column:
    """``kind:start:end``, comma-joined, of an array of structs that is already in order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def free(docs: DataFrame, name: str) -> str:
    """``name``, or with underscores before it as many as it takes that no column of ``docs`` is called so."""
    known = {c.lower() for c in docs.columns}
    while name.lower() in known:
        name = f"_{name}"
    return name


#: Steps of a plan that keep a row of a file one row.
_ONE_TO_ONE = {"LogicalRelation", "Relation", "Filter", "Project", "SubqueryAlias"}


def _rows_of_files(docs: DataFrame) -> bool:
    """Whether each row is one of a file, chosen and projected but not repeated or put together."""
    nodes = [docs._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() not in _ONE_TO_ONE:
            return False
        below = node.children()
        nodes += [below.apply(i) for i in range(below.size())]
    return True


def numbered(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with a column that tells each row from all others, the same however often it is read.

    For rows of Parquet files, if the plan only chooses and projects them, that is the file (by hash of its path) and the place in it. Others are written
    once, with a number.
    """
    if "_metadata" not in docs.columns and _rows_of_files(docs):
        try:
            return docs.withColumn(out, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")))
        except AnalysisException:
            pass  # files that have no places
    docs.withColumn(out, F.monotonically_increasing_id()).write.parquet(at := work_path(docs.sparkSession, "numbered"))
    return docs.sparkSession.read.parquet(at)


def without(docs: DataFrame, ids: DataFrame, key: str = "doc_id", most: int = 8 << 20) -> DataFrame:
    """``docs`` without the rows of some ``ids``: broadcast when these take no more than ``most`` bytes, else joined in a shuffle."""
    ids = cut(ids.select(key).distinct())
    size = ids.agg(F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 16), F.lit(0))).first()[0]
    return docs.join(F.broadcast(ids) if size <= most else ids.hint("merge"), key, "left_anti")


def octave(n: str) -> F.Column:
    """Quarter octaves of a count."""
    return F.floor(F.log2(n) * 4)


def frequent(counts: DataFrame, n: str, most: int) -> F.Column:
    """A condition on ``n`` that the most frequent rows of ``counts`` meet, no more than ``most`` of them."""
    least, reached = None, 0
    for step, rows in sorted(counts.groupBy(octave(n).alias("step")).count().collect(), reverse=True):
        reached += rows
        if reached > most:
            break
        least = step
    return F.lit(False) if least is None else octave(n) >= least
