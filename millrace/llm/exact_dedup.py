"""Exact deduplication against a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table of SHA-256 digests (binary), the id that stays for each, and the batch that brought it. Its files are
bucketed and sorted by digest, so both sides of the anti-join that finds unseen digests, and of the joins that follow, meet
without moving the index. A batch is deduplicated within itself (per digest the row with the largest id stays) and
against the index (digests already there keep the row that came first), and what is new is appended. The number of buckets is kept
beside the data; opening the index with another one is refused. A batch that is ingested again under its name adds nothing and gives the same rows.

Grouped sizes and ids are aggregated before they are shuffled. Groups of a thousandth of all rows or more are joined by
broadcast, of which there can be a thousand at most, so a text that fills a third of the rows loads no single task.

Defined results: a null text counts as empty; empty texts are equal to each other; of equal ids with equal texts (repeated
rows) one row has ``kept`` true; a null id sorts before every other id; ids are of any type that can be sorted, the same one in all batches of an index; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut, join_groups, read_text, write_text


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, row), the last a number that tells repeated rows apart."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return docs.select(F.col(key).alias("doc_id"), digest.alias("digest"), F.monotonically_increasing_id().alias("row"))


class DigestIndex:
    """A bucketed, sorted digest table below ``path``; opened again from the same path in any later session."""

    LAYOUT, BUCKETS = "_index.json", 64

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        known = json.loads(read_text(spark, f"{path}/{self.LAYOUT}") or "{}")
        there = known.get("buckets")
        if there and buckets not in (None, there):
            raise ValueError(f"the index in {path} has {there} buckets, not {buckets}")
        self.spark, self.path, self.buckets, self.id_type = spark, path, there or buckets or self.BUCKETS, known.get("id")
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        if not there:
            self._describe()
        if self.id_type:
            self._create()

    def _describe(self) -> None:
        write_text(self.spark, f"{self.path}/{self.LAYOUT}", json.dumps({"buckets": self.buckets, "id": self.id_type}))

    def _create(self) -> None:
        columns = f"digest BINARY, keep_id {self.id_type}, batch STRING"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def open(self, id_type: str) -> None:
        """Take ids of a type: that of the first batch, which all later ones must have."""
        if self.id_type not in (None, id_type):
            raise ValueError(f"the index in {self.path} holds ids of type {self.id_type}, not {id_type}")
        if not self.id_type:
            self.id_type = id_type
            self._describe()
            self._create()

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame, batch: str) -> DataFrame:
        """Add the digests that the index doesn't hold and return it as it is then.

        ``groups`` has one row per digest. An append that was lost half-way leaves no committed files, so it can be repeated.
        """
        new = groups.select("digest", "keep_id").hint("merge").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new.withColumn("batch", F.lit(batch)).write.insertInto(self.table)  # the join leaves them dealt out as the buckets are
        self.spark.catalog.refreshTable(self.table)
        return self.rows()


def _groups(rows: DataFrame) -> DataFrame:
    """For each digest the id and the row that stay, and the number of rows."""
    best = F.max(F.struct("doc_id", F.negate("row").alias("row")))
    return rows.groupBy("digest").agg(best["doc_id"].alias("keep_id"), (-best["row"]).alias("keep_row"), F.count("*").alias("group_size"))


def ingest(docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text", batch: str | None = None, bounds: Sequence = ()) -> DataFrame:
    """Deduplicate documents against themselves and the index, and append their new digests.

    One row per document: the id that stays for its text, the size of its group, whether this row is the one that stays, and the digest.

    With ``bounds``, ids in falling order, the documents come in batches, the largest ids first: each bound is the least id of its batch, and the
    last batch has all others and rows without id. Each batch is deduplicated against what the ones before left in the index.
    """
    batch = batch or uuid.uuid4().hex
    index.open(docs.schema[key].dataType.simpleString())
    rows, left = cut(digests(docs, key, text)), F.lit(True)
    for n, bound in enumerate([*bounds, None]):
        own = F.lit(True) if bound is None else F.coalesce(F.col("doc_id") >= F.lit(bound), F.lit(False))
        index.append(_groups(rows.where(left & own)), f"{batch}-{n}")
        left = left & ~own
    ours = F.col("batch").isin([f"{batch}-{n}" for n in range(len(bounds) + 1)])
    found = _groups(rows).select("digest", "keep_row", "group_size").hint("merge").join(index.rows().hint("merge"), "digest")
    held = cut(found.select("digest", "keep_id", "group_size", F.when(ours, F.col("keep_row")).alias("keep_row")))
    each = join_groups(rows, held, "digest", "group_size", rows.count())
    return each.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
