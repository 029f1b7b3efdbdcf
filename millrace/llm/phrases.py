"""Phrase collocation mining with counting quotient filters.

Texts are cut into pieces and words; everything is counted per language. A phrase is frequent from ``least`` occurrences on, and every part of a
frequent phrase is frequent, so counting goes up by length: words first, which get ids; then each longer length counts only those
n-grams both of whose parts of one word less may be frequent. What may be frequent is told by the bits of the quotients that occur among the frequent
ones: a bitmap of ``ROOM`` bits for each of them, no more than 2 ** ``MARKS`` (64 MB) whatever the size of the corpus. A false mark costs an exact counter that is then dropped, nothing
is lost; where frequent ones crowd the largest bitmap, more is counted.

Each task counts its n-grams in a filter of ``quotient_filter`` (packed word ids under an invertible permutation, quotient and full remainder, so
counts are exact) and cuts it into shards when it is large; filters of a shard are merged in sorted order, and what is frequent is read back from
its place. The number of shards grows with the corpus; a phrase that is everywhere is one counter of each task.

The score of a phrase is that of its worst cut: 1000 times a * n / (l * r), rounded down, in exact decimals (sound up to 10^15 words a language).

Ids reach the texts in two ways: the ``HEAD`` most frequent words by broadcast, the others (whose share of all words is below 1 / HEAD each) by a
join of each text's distinct remaining words, which a second bitmap thins out before.

Defined results: a null text is empty, a null language is ``und`` (an empty one isn't); texts without words and empty tables have no phrases; long
texts are walked whole; repeated rows count again; equal scores go by count and then by the phrase's bytes, so ranks have no ties; other columns
of the input, whatever their names, take no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import frequent, remove, work_path
from .quotient_filter import Filter, Layout

LEAST, WORDS, TOP = 100, 5, 2000
#: Words that are broadcast with their ids; bits of a bitmap for each of what may be frequent, and the smallest and largest power of two of bits.
HEAD, ROOM, FEWEST_MARKS, MARKS = 1 << 17, 16, 20, 29
#: Distinct words, new n-grams and counters that a task holds; n-grams of a shard.
HELD_WORDS, HELD_NEW, HELD_COUNTERS, SHARD = 200_000, 1 << 20, 1 << 21, 1 << 21

#: Bytes of UTF-8: A-Z to lower case, what ends a piece to a line feed. All of them are ASCII, so no longer character is touched.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Languages and folded texts; within a line only blanks and tabs divide words, and that is what ``split`` finds there."""
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
        yield "und" if lang is None else lang, (text or b"").translate(_FOLD)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, words in counts.items():
            if words:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(words.values(), pa.int64())], ["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in _texts(batch):
            counts.setdefault(lang, Counter()).update(text.split())
        if sum(map(len, counts.values())) >= HELD_WORDS:
            yield from rows()
    yield from rows()


def _key(lang: str, word: bytes) -> int:
    return zlib.crc32(lang.encode() + b"\x00" + word)


@dataclass
class Marks:
    """A bitmap of 2 ** ``bits`` of the first bits of numbers of 32 bits."""

    bits: int
    data: np.ndarray

    @staticmethod
    def of(numbers: DataFrame) -> Marks:
        """Of the only column, ``mark``."""
        bits = min(MARKS, max(FEWEST_MARKS, (ROOM * numbers.count()).bit_length()))
        place = F.shiftright("mark", 32 - bits)
        data = np.zeros(((1 << bits) // 32768, 4096), np.uint8)
        grouped = numbers.groupBy(F.floor(place / 32768).cast("int").alias("bucket")).agg(F.bitmap_construct_agg(F.pmod(place, F.lit(32768))).alias("bits"))
        for row in grouped.toLocalIterator():
            data[row.bucket] = np.frombuffer(row.bits, np.uint8)
        return Marks(bits, data.reshape(-1))

    def have(self, numbers: np.ndarray) -> np.ndarray:
        at = (numbers >> np.uint64(32 - self.bits)).astype(np.int64)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def has(self, number: int) -> bool:
        at = number >> (32 - self.bits)
        return bool(self.data[at >> 3] >> (at & 7) & 1)


def _dense(words: DataFrame) -> DataFrame:
    """``words`` with ids from 1 in a row, the most frequent first, by way of a sorted table."""
    spark = words.sparkSession
    words.orderBy(F.desc("n"), "lang", "word").withColumn("place", F.monotonically_increasing_id()).write.parquet(at := work_path(spark, "phrase-words"))
    placed = spark.read.parquet(at).withColumn("part", F.shiftright("place", 33))
    starts, total = [], 0
    for part, rows in sorted(placed.groupBy("part").count().collect()):
        starts.append((part, total))
        total += rows
    offsets = spark.createDataFrame(starts, "part long, start long")
    return placed.join(F.broadcast(offsets), "part").select("lang", "word", "n", (F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).alias("id"))


def _runs(ids: np.ndarray) -> np.ndarray:
    """The runs of at least two words, each followed by one zero."""
    word = ids != 0
    before, after = np.append(False, word[:-1]), np.append(word[1:], False)
    word &= before | after
    keep = word | np.append(False, word[:-1])
    return np.where(word, ids, 0)[keep]


def _encoded(docs: DataFrame, known: dict[str, dict[bytes, int]], marks: Marks | None) -> DataFrame:
    """Each text as runs of ids of frequent words; words that may be frequent but aren't broadcast are places in ``others``, counted from -1."""
    sent = docs.sparkSession.sparkContext.broadcast((known, marks))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("others", T.ArrayType(T.StringType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, rest = sent.value
        for batch in batches:
            langs, runs, others = [], [], []
            for lang, text in _texts(batch):
                head, own, ids = heads.get(lang, {}), {}, []

                def other(word: bytes, lang: str = lang, own: dict = own) -> int:
                    return -own.setdefault(word, len(own) + 1) if rest.has(_key(lang, word)) else 0

                for piece in text.split(b"\n"):
                    if words := piece.split():
                        ids += [head.get(w, 0) for w in words] if rest is None else [head.get(w) or other(w) for w in words]
                        ids.append(0)
                found = _runs(np.array(ids, np.int64))
                if len(found):
                    langs.append(lang)
                    runs.append(found)
                    others.append(list(own))
            ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(runs) if runs else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), ids, pa.array(others, pa.list_(pa.binary())).cast(pa.list_(pa.string()))], ["lang", "ids", "others"])

    return docs.select("lang", "text").mapInArrow(encode, schema)


def _written(df: DataFrame, what: str, paths: list[str] | None = None) -> DataFrame:
    """Computed once, into the shared folder; ``paths`` gets the place of what isn't read to the end."""
    df.write.option("compression", "zstd").parquet(at := work_path(df.sparkSession, what))
    if paths is not None:
        paths.append(at)
    return df.sparkSession.read.parquet(at)


def _with_others(encoded: DataFrame, words: DataFrame) -> DataFrame:
    """``encoded`` with the ids of its ``others`` by a join; those that turn out not to be frequent end a run."""
    pairs = encoded.where(F.size("others") > 0).select("row", "lang", F.posexplode("others").alias("at", "word"))
    own = pairs.join(words, ["lang", "word"]).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct(-F.col("at") - 1, "id"))).alias("own"))
    known = encoded.join(own, "row", "left")
    found = F.transform("ids", lambda i: F.when(i >= 0, i).otherwise(F.coalesce(F.try_element_at("own", i.cast("int")), F.lit(0))))
    return known.select(found.alias("ids"))


def _windows(ids: np.ndarray, layout: Layout, marks: Marks | None) -> list[np.ndarray]:
    """Permuted n-grams of the runs, without those that have a part that can't be frequent."""
    n = layout.words
    size = len(ids) - n + 1
    if size <= 0:
        return [np.zeros(0, np.uint64) for _ in layout.limbs]
    there = ids != 0
    whole = np.logical_and.reduce([there[k : k + size] for k in range(n)])
    if marks is not None:
        part = Layout(n - 1, layout.bits)
        at = np.flatnonzero(np.logical_and.reduce([there[k : k + size + 1] for k in range(n - 1)]))
        may = np.zeros(size + 1, bool)
        may[at] = marks.have(part.head(part.permuted(part.packed([ids[at + k] for k in range(n - 1)]))))
        whole &= may[:-1] & may[1:]
    at = np.flatnonzero(whole)
    return layout.permuted(layout.packed([ids[at + k] for k in range(n)]))


def _partial(encoded: DataFrame, layout: Layout, marks: Marks | None, bits: int) -> DataFrame:
    """Filters of each task's n-grams, cut into 2 ** ``bits`` shards."""
    sent = encoded.sparkSession.sparkContext.broadcast(marks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Filter] = []
        new: list[list[np.ndarray]] = []

        def settle() -> None:
            if new:
                fresh = Filter.of(layout, [np.concatenate(x) for x in zip(*new, strict=True)])
                held[:] = [Filter.merged([*held, fresh])]
                new.clear()

        def out() -> pa.RecordBatch:
            shards = [part for f in held for part in f.shards(bits)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in shards], pa.int32()), pa.array([w for _, w in shards], pa.binary())], ["shard", "filter"])

        for batch in batches:
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            new.append(_windows(ids, layout, sent.value))
            if sum(len(x[0]) for x in new) >= HELD_NEW:
                settle()
                if len(held[0]) >= HELD_COUNTERS:
                    yield out()
        settle()
        yield out()

    return encoded.select("ids").mapInArrow(count, "shard int, filter binary")


def _frequent(partial: DataFrame, layout: Layout, bits: int, least: int) -> DataFrame:
    """The n-grams of at least ``least`` occurrences over all filters."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        whole = Filter.merged([Filter.from_wire(layout, shard, bits, w) for w in table.column("filter").to_pylist()])
        whole = whole.where(whole.counts >= least)
        ids = np.stack([column.astype(np.int64) for column in whole.ids()], axis=1).reshape(-1)
        ends = np.arange(0, len(ids) + 1, layout.words, dtype=np.int32)
        marks = pa.array(layout.head(whole.limbs).astype(np.int64))
        return pa.Table.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), pa.array(whole.counts), marks], ["ids", "f", "mark"])

    return partial.groupBy("shard").applyInArrow(merge, "ids array<long>, f long, mark long")


def _scored(found: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates that no longer one makes needless, with their worst cut."""
    phrases = found.where(F.size("ids") > 1)
    parts = phrases.where(F.size("ids") > 2).select("f", F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"))
    # what a longer candidate makes needless has its count, and so has all that lies between them: one word more is enough
    needless = parts.groupBy("ids").agg(F.max("f").alias("longer"))
    kept = phrases.join(needless, "ids", "left").where("longer IS NULL OR longer < f").select("ids", F.col("f").alias("a"))
    cuts = kept.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("slice(ids, 1, k)"), "rest": F.expr("slice(ids, k + 1, size(ids) - k)")})
    left, right = found.select(F.col("ids").alias("first"), F.col("f").alias("l")), found.select(F.col("ids").alias("rest"), F.col("f").alias("r"))
    langs = words.select(F.array("id").alias("head"), "lang").join(totals, "lang")
    cuts = cuts.join(left, "first").join(right, "rest").withColumn("head", F.expr("slice(ids, 1, 1)")).join(langs, "head")
    score = F.expr("(CAST(1000 * a AS DECIMAL(19, 0)) * CAST(total AS DECIMAL(18, 0))) div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))")
    cuts = cuts.withColumn("score", score)
    worst = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("ids", "a", "lang", "total").agg(worst).select("ids", "a", "lang", F.col("total").alias("n"), "cut.l", "cut.r", "cut.score")


def _best(scored: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first of each language. Each task first leaves out what has ``top`` better ones of its own part of the language."""
    spark = scored.sparkSession
    deals = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = "score DESC, a DESC"
    dealt = scored.withColumn("deal", F.pmod(F.xxhash64("ids"), F.lit(deals))).withColumn("above", F.expr(f"rank() OVER (PARTITION BY lang, deal ORDER BY {order})")).where(F.col("above") <= top)
    each = dealt.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelt = each.groupBy("ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = dealt.drop("above").join(spelt, "ids")
    for by in ("lang, deal", "lang"):
        named = named.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {by} ORDER BY {order}, phrase)").cast("long")).where(F.col("rank") <= top)
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, least: int = LEAST, words: int = WORDS, top: int = TOP, head: int = HEAD) -> DataFrame:
    """The best phrases of each language by rank, with their counts."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select("lang", "text")
    counts = _written(texts.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = _dense(counts.where(F.col("n") >= least))
    first = known.where(frequent(known, "n", head))
    sent: dict[str, dict[bytes, int]] = {}
    for row in first.collect():
        sent.setdefault(row.lang, {})[row.word.encode()] = row.id
    size = known.count()
    rest, done = None, []
    if size > sum(map(len, sent.values())):
        rest = known.join(F.broadcast(first.select("id")), "id", "left_anti")
    mark = F.crc32(F.concat("lang", F.lit("\0"), "word")).alias("mark")
    encoded = _encoded(texts, sent, None if rest is None else Marks.of(rest.select(mark)))
    if rest is not None:
        encoded = _with_others(_written(encoded.withColumn("row", F.monotonically_increasing_id()), "phrase-texts", done), rest)
    encoded = _written(encoded.select("ids"), "phrase-ids", done)
    length = encoded.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    shards = min(16, max(0, (length // SHARD).bit_length()))
    found, marks = known.select(F.array("id").alias("ids"), F.col("n").alias("f")), None
    for n in range(2, words + 1):
        layout = Layout(n, max(1, size.bit_length()))
        level = _written(_frequent(_partial(encoded, layout, marks, shards), layout, shards, least), f"phrase-{n}")
        found = found.unionByName(level.select("ids", "f"))
        marks = Marks.of(level.select("mark"))
        if not marks.data.any():
            break
    for at in done:
        remove(spark, at)
    return _best(_scored(found, known, totals), known, top)
