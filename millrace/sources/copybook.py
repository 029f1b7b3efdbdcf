"""Mainframe records described by a copybook: fields of fixed width in ASCII or EBCDIC.

Lines and records of fixed length come from Spark's readers as binary values, which any number of tasks read. In a file whose records have lengths of
their own (four bytes before each), a record's place is known only after all before it: one pass over each file reads the headers and cuts
it into ranges of about ``RANGE`` bytes, which are then dealt out and read by any number of tasks, however large the file is. Ranges are read with
Arrow's file systems (local and network folders, HDFS, S3, Google's store).

What can't be read as the number that its picture says is null and an entry in the error column, with the raw value (binary ones in
hexadecimal). Arrow batches are decoded column by column.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.functions import errors

from .copybook_items import Item, length_of, parse, record, schema  # noqa: F401 what users need
from .copybook_values import Decoder, Notes, code, matrix

TRIMMING = ("none", "left", "right", "both")
FLOATS = ("ibm", "ieee")
#: Bytes of a file with record headers that a task reads, and that are in memory at once.
RANGE, BLOCK = 32 << 20, 2 << 20
#: Tasks at most that index files or read ranges.
PARTITIONS = 50_000
HEADER = 4


def read(spark: SparkSession, path: str | list[str], copybook: str, encoding: str = "ebcdic", trimming: str = "both", is_text: bool = False, xcom: bool = False, charset: str | None = None, floats: str = "ibm", big_endian: bool = False) -> DataFrame:
    """Records of a copybook and their error column: lines if ``is_text``, with headers if ``xcom``, else of the copybook's length.

    Headers hold the record's length in their last two bytes, the lower one first, or in the first two, the higher one first, if ``big_endian``.
    """
    for name, value, known in (("trimming", trimming, TRIMMING), ("encoding", encoding, ("ascii", "ebcdic")), ("floats", floats, FLOATS)):
        if value not in known:
            raise ValueError(f"{name} is one of {', '.join(known)}, not {value}")
    page, layout = code(encoding, charset), record(copybook)
    kinds = T.StructType([*schema(layout.items).fields, T.StructField(errors.ERRORS, errors.ERROR_LIST)])
    decoder, width = Decoder(page, trimming, floats), length_of(layout.items)
    of, number, message = errors.STD_CAST

    def decoded(records: pa.Array) -> pa.RecordBatch:
        rows, lengths = matrix(records, width, page.blank)
        notes = Notes()
        columns = list(decoder.columns(layout.items, rows, lengths, notes))
        found = notes.by_row(len(records)) if notes.rows else [[]] * len(records)
        entries = [[{"errType": of, "errCode": number, "errMsg": message, "errCol": p, "rawValues": [raw], "mappings": []} for p, raw in row] for row in found]
        columns.append(pa.array(entries, to_arrow_type(errors.ERROR_LIST)))
        return pa.RecordBatch.from_arrays(columns, [f.name for f in kinds.fields])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield decoded(batch.column(0))

    def decode_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for records in _records(at, start, size, big_endian):
                    yield decoded(records)

    if xcom:
        return ranges(spark, path, big_endian).mapInArrow(decode_ranges, kinds)
    if is_text:
        raw = spark.read.text(path).select(F.col("value").cast("binary"))  # the bytes of a line, whatever their encoding
    else:
        raw = fixed(spark, path, layout.length)
    return raw.mapInArrow(decode, kinds)


def fixed(spark: SparkSession, path: str | list[str], length: int) -> DataFrame:
    """Records of one length as binary values, read by Hadoop's splittable format without Python."""
    at = path if isinstance(path, str) else ",".join(path)
    records = spark._jsc.sc().binaryRecords(at, length, spark._jsc.hadoopConfiguration())
    return DataFrame(spark._jsparkSession.createDataset(records, spark._jvm.org.apache.spark.sql.Encoders.BINARY()).toDF(), spark)


def ranges(spark: SparkSession, path: str | list[str], big_endian: bool = False, size: int | None = None) -> DataFrame:
    """Whole records of files with record headers: path, first byte and bytes of each range, dealt out evenly."""
    size = size or RANGE
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # without their content
    schema = "path string, start long, size long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(_cuts(at, length, size, big_endian))
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(found)), pa.array([a for a, _ in found], pa.int64()), pa.array([b - a for a, b in found], pa.int64())], ["path", "start", "size"])

    total = files.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    dealt = files.repartition(min(PARTITIONS, max(1, total[1]))).mapInArrow(cut, schema)  # one file, one task
    return dealt.repartition(min(PARTITIONS, max(1, -(-total[0] // size))))


def _open(path: str) -> pa.NativeFile:
    local = urlparse(path).scheme in ("", "file")
    system, at = (fs.LocalFileSystem(), urlparse(path).path) if local else fs.FileSystem.from_uri(path)
    return system.open_input_file(at)


def _length(header: bytes, at: int, path: str, big_endian: bool) -> int:
    length, rest = (header[0] << 8 | header[1], header[2:4]) if big_endian else (header[3] << 8 | header[2], header[:2])
    if len(header) < HEADER or any(rest) or not length:
        raise ValueError(f"no record header at byte {at} of {path}: {header.hex()}")
    return length


def _cuts(path: str, length: int, size: int, big_endian: bool) -> Iterator[tuple[int, int]]:
    """Beginnings and ends of ranges of whole records; headers are read from blocks, records between them are only stepped over."""
    with _open(path) as file:
        begin = at = base = 0
        block = b""
        while at < length:
            if not base <= at <= base + len(block) - HEADER:
                block, base = file.read_at(BLOCK, at), at
            at += HEADER + _length(block[at - base : at - base + HEADER], at, path, big_endian)
            if at > length:
                raise ValueError(f"the last record of {path} is cut off")
            if at - begin >= size:
                yield begin, at
                begin = at
        if begin < length:
            yield begin, length


def _records(path: str, start: int, size: int, big_endian: bool) -> Iterator[pa.Array]:
    """The records of a range, some at a time."""
    with _open(path) as file:
        at, rest = start, b""
        while at < start + size or rest:
            block = rest + file.read_at(min(BLOCK, start + size - at), at)
            at += len(block) - len(rest)
            found, k = [], 0
            while k + HEADER <= len(block) and (end := k + HEADER + _length(block[k : k + HEADER], at, path, big_endian)) <= len(block):
                found.append(block[k + HEADER : end])
                k = end
            rest = block[k:]
            yield pa.array(found, pa.large_binary())
