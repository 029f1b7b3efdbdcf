"""From raw documents to training shards: each stage's result is written as Parquet and read again as the next one's input.

All stages walk long texts whole, give an empty table for an empty one, and keep all columns of their input, whatever their names: what a stage needs for itself
gets names that the input doesn't have.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, language_id, mixing, simhash, token_output
from millrace.llm._common import free, numbered, prepare, remove, table, without, work_path

#: Copies of a text that the mix may take.
REPEATS = 2
#: Number of a row within a stage, if no column is named so: what is decided about a row is joined back by it, as ids may repeat or be missing.
ROW = "_row"


def _named(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those that no language explains go. Each row is judged by itself, whatever its id."""
    rows = numbered(docs, row := free(docs, ROW))
    judged = language_id.fuse(language_id.document_evidence(rows, key=row), language_id.fit(rows))
    return without(rows, judged.where(~F.col("accepted")).select(F.col("id").alias(row)), row).select(*_named(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row: that with the smallest id, without one only if none has an id, and of equal ids the first."""
    rows = numbered(docs, row := free(docs, ROW))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(row).alias("row"))
    found = simhash.components(rows.select(place.alias("doc_id"), "text"))
    return without(rows, found.where("doc_id.row != component_id.row").select(F.col("doc_id.row").alias(row)), row).select(*_named(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    judged = decontamination.annotate(docs, table(spark, sf_dir, "benchmark"), out=(overlap := free(docs, "overlap")))
    return judged.where(~F.col(overlap)["contaminated"]).select(*_named(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; rows are shuffled by their number, so those that share an id or have none are taken one by one."""
    rows = numbered(docs, row := free(docs, ROW))
    mixed, times = mixing.mix(rows, key=row, repeats=REPEATS), free(docs, "_copies")
    taken = mixed.select(F.col("doc_id").alias(row), mixing.copies(mixed).alias(times)).where(F.col(times) > 0)
    return rows.join(taken, row).select(*_named(docs), F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).drop(times)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Binary shards in training order; a row for each sequence."""
    written = token_output.write(docs, work_path(spark, "shards"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return written.withColumnRenamed("docs", "doc_ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]
#: Language models and fingerprints can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    prepare(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(at := work_path(spark, name))
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(at), at
    return docs
