"""Records for message sinks: errors and control information as key and value, in JSON or Avro.

The values are written with ``format("kafka")`` where its connector is installed; the records are the same without it.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import errors

from . import avro


def error_values(df: DataFrame, source_system: str, dataset: str, info_date: Column, info_version: Column, dataset_version: int = 1, unique_run_id: str = "", run_id: int = 0, run_url: str = "", record_id: str = "record_id", output_path: str | None = None, ingestion: int | None = None) -> DataFrame:
    """One record per error of the frame, with a struct as value; its fields are fixed by the format of error messages."""
    rows = errors.exploded(df.withColumn("__id", F.coalesce(F.col(record_id).cast("string"), F.lit(""))), "__id")
    stage = F.when(F.col("errType").startswith("std"), "standardization").otherwise("conformance")
    none = F.lit(None)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))  # noqa: E731 values of the map are never null
    more = {"datasetName": F.lit(dataset), "reportDate": text(info_date), "reportVersion": text(info_version), "datasetVersion": F.lit(str(dataset_version)), "uniqueRunId": F.lit(unique_run_id), "runId": F.lit(str(run_id)), "runUrl": F.lit(run_url), "errCol": text(F.col("errCol")), "rawValues": text(F.array_join("rawValues", ","))}
    value = F.struct(
        F.lit(source_system).alias("sourceSystem"), none.cast("string").alias("sourceSystemId"), F.lit(dataset).alias("dataset"), F.lit(ingestion).cast("long").alias("ingestionNumber"),
        F.unix_millis(F.current_timestamp()).alias("processingTimestamp"), F.unix_date(info_date).alias("informationDate"), F.lit(output_path).cast("string").alias("outputFileName"),
        F.col("__id").alias("recordId"), stage.alias("errorSourceId"), text(F.col("errType")).alias("errorType"), text(F.col("errCode")).alias("errorCode"), text(F.col("errMsg")).alias("errorDescription"),
        F.create_map(*(c for k, v in more.items() for c in (F.lit(k), v))).alias("additionalInfo"),
    )
    return rows.select(F.col("__id").alias("key"), value.alias("value"))


def error_records(df: DataFrame, source_system: str, dataset: str, info_date: Column, info_version: Column, **more: Any) -> DataFrame:
    """The same with values in JSON."""
    return error_values(df, source_system, dataset, info_date, info_version, **more).select("key", F.to_json("value").alias("value"))


def in_avro(records: DataFrame, schema: str | dict, schema_id: int | None = None) -> DataFrame:
    """Records with a struct as value, the value in Avro."""
    return records.select("key", avro.encode(F.col("value"), schema, schema_id).alias("value"))


def control_record(spark: SparkSession, key: str, measure: dict[str, Any]) -> DataFrame:
    return spark.createDataFrame([(key, json.dumps(measure, sort_keys=True))], "key string, value string")


def control_values(spark: SparkSession, key: str, measure: dict[str, Any], schema: str | dict) -> DataFrame:
    """The same with a struct as value, as an Avro schema has it."""
    kind = avro.Schema(schema).type()[0]
    return control_record(spark, key, measure).select("key", F.from_json("value", kind).alias("value"))


def send(records: DataFrame, brokers: str, topic: str, **security: str) -> None:
    """Write records to a Kafka topic; needs Spark's Kafka connector."""
    options = {f"kafka.{k.replace('_', '.')}": v for k, v in security.items()}
    records.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).options(**options).save()
