"""SimHash near-duplicates with BK-trees.

A text's fingerprint has a bit where more than half of the XXH64 hashes of its word shingles have it; fingerprints of
texts that differ little differ in few bits. Fingerprints within ``RADIUS`` bits are linked, and links make components.

Fingerprints are cut into four 16-bit blocks. Two within two bits agree in at least two whole blocks, so each pair of blocks
with its value names a shard, and linked fingerprints share one. A shard of more than ``CAP`` distinct fingerprints (very many near
copies of one text) is cut again by the same rule: the bits that its members don't share make four blocks, and pairs of these with
their value name smaller shards. At the third cut eight bits are left, so no shard has more than the larger of ``CAP`` and 256 members.

A shard's fingerprints stream, sorted, into the task that holds its BK-tree, whose children are keyed by their integer Hamming
distance to the parent: a search follows only the edges within the radius, and ends when it has met every component of the shard. Each fingerprint
is searched and then added, and of the links found, those are given out that join sets not joined before in the shard, so fewer
than the shard has members. The trees are small, but together they hold the corpus' fingerprints several times, so a broadcast of them would
have no bound: they go to the tasks with the shuffle.

Defined results: null texts and texts without words have fingerprint zero, which links like any other; equal fingerprints are
linked; the component of a row with a null id is the smallest id that is not null, or null if there is none; repeated rows
repeat their result; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, join_groups
from .components import roots

RADIUS, BLOCKS, CAP = 2, 4, 1024
ALL = (1 << 64) - 1
#: Shingles whose bits are counted at once; bounds the memory of long texts.
AT_ONCE = 1 << 16


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of word shingles; words end at white space of ASCII, A-Z count as a-z."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    digest, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), AT_ONCE):
        part = zip(starts[k : k + AT_ONCE].tolist(), ends[k : k + AT_ONCE].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in part), np.uint64)
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(starts), bitorder="little").view("<u8")[0])


class BKTree:
    """Distinct fingerprints; a node is [fingerprint, {distance: node}]."""

    def __init__(self):
        self.root = None

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Members within the radius, closest branches first."""
        todo = [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            distance = (own ^ value).bit_count()
            if distance <= radius:
                yield own
            for d in range(distance + radius, max(0, distance - radius - 1), -1):
                if d in children:
                    todo.append(children[d])

    def add(self, value: int) -> None:
        node = self.root
        if node is None:
            self.root = [value, {}]
            return
        while distance := (node[0] ^ value).bit_count():
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = [value, {}]
                return
            node = child


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", width: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with the fingerprint as a signed long of the same bits."""
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(np.array([fingerprint(t or "", width, seed) for t in texts.to_pylist()], np.uint64).view(np.int64))

    return docs.withColumn(out, F.arrow_udf(found, "long")(F.col(text)))


def _shards(rows: DataFrame, bits: int) -> DataFrame:
    """(shard, fp, rest) of rows (shard, fp, rest): each becomes a row for every pair of blocks of its ``bits`` in ``rest``.

    The new shard is a hash of the one before, the pair's number and its value (different shards of one hash only make a tree larger), the new rest holds the two other blocks.
    """
    width = bits // BLOCKS
    block = [F.shiftrightunsigned("rest", width * k).bitwiseAND((1 << width) - 1) for k in range(BLOCKS)]
    cuts = []
    for n, (a, b) in enumerate(combinations(range(BLOCKS), 2)):
        c, d = (k for k in range(BLOCKS) if k not in (a, b))
        cuts.append(F.struct(F.xxhash64("shard", F.lit(n), block[a], block[b]).alias("shard"), (F.shiftleft(block[c], width) + block[d]).alias("rest")))
    return rows.select("fp", F.explode(F.array(*cuts)).alias("cut")).select("cut.shard", "fp", "cut.rest")


def _tree_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of shards whose rows follow each other."""
    shard, tree, parent, parts = None, BKTree(), {}, 0

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        links = []
        for key, signed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != shard:
                shard, tree, parent, parts = key, BKTree(), {}, 0
            value = signed & ALL
            if value in parent:
                continue
            parent[value] = value
            left = parts  # components that the value isn't linked to yet
            parts += 1
            for other in tree.near(value, RADIUS):
                if (a := top(value)) != (b := top(other)):
                    parent[a] = b
                    links.append((value, other))
                    left, parts = left - 1, parts - 1
                    if not left:
                        break
            tree.add(value)
        a, b = (pa.array(np.array([x[i] for x in links], np.uint64).view(np.int64)) for i in range(2))
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def links(prints: DataFrame, cap: int = CAP) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fp`` within RADIUS bits of each other."""
    rows, bits, treed = prints.select(F.lit(0).cast("long").alias("shard"), "fp", F.col("fp").alias("rest")), 64, []
    while True:
        shards = cut(_shards(rows, bits))
        sizes = cut(shards.groupBy("shard").agg(F.count("*").alias("members")).where("members > 1"))
        shared = cut(join_groups(shards, sizes, "shard", "members", shards.count()))
        bits //= 2
        last = bits <= 2 * BLOCKS or sizes.where(F.col("members") > cap).isEmpty()
        treed.append((shared if last else shared.where(F.col("members") <= cap)).select("shard", "fp"))
        if last:
            break
        rows = shared.where(F.col("members") > cap).select("shard", "fp", "rest")
    whole = treed[0]
    for more in treed[1:]:
        whole = whole.unionByName(more)
    return whole.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(_tree_links, "a long, b long")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42, cap: int = CAP) -> DataFrame:
    """One row per document: its fingerprint (signed long) and the smallest id that links lead to."""
    rows = cut(with_fingerprint(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", "fp", width, seed).select("doc_id", "fp"))
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    found = roots(links(prints.select("fp"), cap)).withColumnRenamed("node", "fp")
    rooted = cut(prints.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    whole = cut(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members")))
    labelled = cut(join_groups(rooted, whole, "root", "members", rooted.count()).select("fp", "copies", "component_id"))
    return join_groups(rows, labelled, "fp", "copies", rows.count()).select("doc_id", "fp", "component_id")
