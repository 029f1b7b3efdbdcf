"""Queries that write mainframe files from the benchmark tables and read them back, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.standardize import standardize
from millrace.registry import query, read
from millrace.registry_io import codes, first_raw
from millrace.session import shared_path
from millrace.sources import readers, schemas


def _ebcdic(text: Column) -> Column:
    """Bytes of printable ASCII in EBCDIC, in hexadecimal."""
    known = F.create_map(*(F.lit(x) for c in map(chr, range(32, 127)) for x in (c, c.encode("cp037").hex())))
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(known, c), F.lit(""))), "")


def _digits(number: Column, width: int) -> Column:
    return F.lpad(F.abs(number).cast("string"), width, "0")


def _zoned(number: Column, width: int, signed: bool = True) -> Column:
    """A digit in each byte, the sign in the upper half of the last one."""
    last = F.when(number < 0, "D").otherwise("C") if signed else F.lit("F")
    return F.concat(F.regexp_replace(F.substring(_digits(number, width), 1, width - 1), "(.)", "F$1"), last, F.substring(_digits(number, width), width, 1))


def _packed(number: Column, digits: int) -> Column:
    return F.concat(_digits(number, digits), F.when(number < 0, "D").otherwise("C"))


def _binary(number: Column, size: int) -> Column:
    return F.substring(F.lpad(F.hex(number.cast("long").bitwiseAND((1 << 8 * size) - 1)), 2 * size, "0"), 1, 2 * size)


def _records(df: DataFrame, record: Column, what: str) -> str:
    """A folder of files of records given in hexadecimal. Spark writes texts as the bytes that they are, with a line feed behind each."""
    at = shared_path(df.sparkSession, what)
    df.select(F.unhex(record).cast("string").alias("value")).write.text(at)
    return at


_PART = """
       01  PART.
           05  KEY    PIC 9(9).
           05  NAME   PIC X(40).
           05  NUM    PIC S9(5).
           05  CODE   PIC 9(4) COMP.
           05  PRICE  PIC S9(7)V99 COMP-3.
           05  LOOSE  PIC 9(3).
           05  N      PIC 9.
           05  PARTS  OCCURS 0 TO 3 TIMES DEPENDING ON N.
               10  W    PIC S9(4) COMP.
               10  TAG  PIC X(2).
           05  FILLER PIC X.
"""


@query("""
SELECT p_partkey, p_name, 20 - p_size AS num, CAST(p_partkey * 7919 % 65536 AS INT) AS code, CASE WHEN p_size % 2 = 1 THEN -1 ELSE 1 END * CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
  CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS loose, array_to_string(list_transform(range(1, p_size % 4 + 1), lambda k: (p_size - 30 * k) || left(p_brand, 2)), '/') AS parts,
  CASE WHEN p_partkey % 5 = 0 THEN 'E00000' ELSE '' END AS codes, CASE WHEN p_partkey % 5 = 0 THEN 'n/a' END AS raw
FROM part
""")
def src_copybook_ebcdic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed records in EBCDIC with signs in the last digit, binary and packed numbers, a repeated group as long as a number says, and numbers that are none."""
    part, n = read(spark, sf_dir, "part"), F.col("p_size") % 4
    cents = F.when(F.col("p_size") % 2 == 1, -1).otherwise(1) * F.round(F.col("p_retailprice") * 100).cast("long")
    loose = F.when(F.col("p_partkey") % 5 == 0, _ebcdic(F.lit("n/a"))).otherwise(_zoned(F.col("p_size"), 3, False))
    parts = [F.concat(_binary(F.col("p_size") - 30 * k, 2), _ebcdic(F.substring("p_brand", 1, 2))) for k in (1, 2, 3)]
    record = F.concat(_zoned(F.col("p_partkey"), 9, False), _ebcdic(F.rpad("p_name", 40, " ")), _zoned(20 - F.col("p_size"), 5), _binary(F.col("p_partkey") * 7919, 2), _packed(cents, 9), loose, _zoned(n, 1, False), *parts)
    at = _records(part, record, "ebcdic")
    schema = schemas.parse(_PART, "copybook")
    raw, _ = readers.read(spark, "cobol", at, schema, copybook=_PART)
    out = standardize(raw, schema)
    spelt = F.array_join(F.transform("PARTS", lambda p: F.concat(p["W"].cast("string"), p["TAG"])), "/").alias("parts")
    return out.select(F.col("KEY").cast("long").alias("p_partkey"), F.col("NAME").alias("p_name"), F.col("NUM").alias("num"), F.col("CODE").alias("code"), (F.col("PRICE") * 100).cast("long").alias("cents"), F.col("LOOSE").alias("loose"), spelt, codes(), first_raw())


_SHORT = """
       01  CUSTOMER.
           05  KEY    PIC 9(9).
           05  BAL    PIC S9(9)V99 COMP-3.
           05  NAME   PIC X(60).
"""


@query("SELECT c_custkey, c_name, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer")
def src_copybook_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with their lengths in headers, read by ranges of each file."""
    customer = read(spark, sf_dir, "customer")
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    body = F.concat(_zoned(F.col("c_custkey"), 9, False), _packed(cents, 11), _ebcdic(F.col("c_name")), F.lit("40"))
    length = (F.length(body) / 2 + 1).cast("int")  # with the line feed behind it
    header = F.concat(F.lit("0000"), _binary(length % 256, 1), _binary(F.floor(length / 256), 1))
    at = _records(customer, F.concat(header, body), "lengths")
    schema = schemas.parse(_SHORT, "copybook")
    raw, _ = readers.read(spark, "cobol", at, schema, copybook=_SHORT, xcom=True)
    return standardize(raw, schema).where(F.size("errCol") == 0).select(F.col("KEY").cast("long").alias("c_custkey"), F.col("NAME").alias("c_name"), (F.col("BAL") * 100).cast("long").alias("cents"))
