"""How many bytes values, rows and frames take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import shared_path


def of_value(column: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in memory."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, T.StructType):
        return sum((of_value(column.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, T.ArrayType | T.MapType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column.alias("x")))), F.lit(0)) + 8
    return F.lit(16)


def of_row(schema: T.StructType) -> Column:
    return sum((of_value(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields), F.lit(0))


def by_plan(df: DataFrame) -> int:
    """What the optimizer expects, from the sizes of files and what it knows about columns, without looking at the data."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def by_rows(df: DataFrame) -> int:
    """The rows' bytes in memory, in a pass over them."""
    return int(df.agg(F.coalesce(F.sum(of_row(df.schema).cast("long")), F.lit(0))).first()[0])


def by_sample(df: DataFrame, rows: int) -> int:
    """Bytes of the frame as Parquet: those of about so many rows that are written, times the number of all rows, which is counted in a pass."""
    spark, count = df.sparkSession, df.count()
    if not count or rows <= 0:
        return 0
    part = df if count <= rows else df.where(F.rand(7) < min(1.0, rows / count))
    part.coalesce(1).write.parquet(at := shared_path(spark, "sample"))
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    taken, written = spark.read.parquet(at).count(), files.getContentSummary(path).getLength()
    files.delete(path, True)
    return written * count // max(1, taken)
