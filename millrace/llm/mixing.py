"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a keyed shuffle, whole passes over the source following each other. A copy's virtual
start and finish are the source's words before and up to it, divided by the source's target. The queues of all sources are merged by a
global range-sort on virtual finish, and a running sum of words over the merged queue finds its cut: the virtual time at which
the copies that are done reach the total budget. Copies that finish by then are taken whole, the one copy of a source that is being
served at the cut gives the words that it has been served by then, later ones give none.

Targets are the weighted shares of ``share`` times all words; none exceeds ``repeats`` times its source's words, and
what it would have had goes to the others by weight. A running sum over sources in order of saturation finds the level
at which this holds for all (one row per source, sorted in one task, which holds for some tens of millions of sources; documents never meet in one task). All sources are served in proportion to their
targets, so each gets its target times the virtual time of the cut: 1, and as much more as the copies in service take of the budget.

Cumulative words come from running sums over prefixes of the shuffle key, a few digits at a time, each within the prefix before, so
a source that holds most documents is spread over many tasks and no task sees more than a few thousand prefixes. The shuffle key is a
hash of the id and the text, so rows that share an id or have none are spread as well; rows that are equal in both and many (``CROWD`` and a thousandth of all rows
at least, found by a sketch of the keys' counts) get a key of their own each, from their place in the table that the sizes are kept in.

Defined results: null and empty texts have size 0 and take nothing; a null source is a source of its own, after all others;
repeated rows each have a place in the queue; a null doc_id counts as an empty one in the key; rows equal in all of (source, doc_id,
text) are interchangeable; long texts are counted whole; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import HEAVY, cut, words_of

WEIGHTS = (5, 2, 1)
#: Digits of the shuffle key that are summed over at once.
STEP = 3
#: Equal rows that are spread, at least, and what the sketch keeps track of.
CROWD, TRACKED = 1000, 10_000


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """``source_size`` per ``source`` to its ``target`` in words. Sources take the weights in turn, in code point order, null last.

    The level is the first in order of saturation at which the words and weights that are left give no one more than its limit.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*map(F.lit, weights))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    limits = weighed.withColumn("limit", F.col("source_size") * repeats).withColumn("full_at", F.col("limit").cast("double") / F.col("weight").cast("double"))
    left = limits.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0)).cast("double")).alias("words_left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double").alias("weight_left"),
    )
    fits = left.withColumn("level", F.col("words_left") / F.col("weight_left"))
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level"))).over(everything)["level"]
    poured = F.when(level.isNull() | (F.col("full_at") <= level), F.col("limit").cast("double")).otherwise(F.col("weight").cast("double") * level)
    return fits.select("source", "source_size", poured.alias("target"))


def _running(sized: DataFrame, digits: int) -> DataFrame:
    """(s, bin, bin_start, source_size): words of a source before each prefix of ``digits`` digits of the shuffle key, and all its words."""
    bins = cut(sized.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")))
    found, done = None, 0
    while done < digits or found is None:
        before, done = done, min(done + STEP, digits)
        here = bins.groupBy("source", F.substring("bin", 1, done).alias("b")).agg(F.sum("bin_size").alias("words"))
        within = Window.partitionBy("source", F.substring("b", 1, before)).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        here = here.withColumn("offset", F.coalesce(F.sum("words").over(within), F.lit(0)))
        if found is None:
            found = here.select(F.col("source").alias("s"), "b", F.col("offset").alias("bin_start"))
        else:
            wider = found.withColumnsRenamed({"b": "wide", "bin_start": "wide_start"})
            both = here.join(wider, F.col("source").eqNullSafe(F.col("s")) & (F.substring("b", 1, before) == F.col("wide")))
            found = both.select("s", "b", (F.col("wide_start") + F.col("offset")).alias("bin_start"))
    whole = bins.groupBy(F.col("source").alias("source")).agg(F.sum("bin_size").alias("source_size"))
    return found.join(whole, F.col("s").eqNullSafe(F.col("source"))).select("s", "b", "bin_start", "source_size")


def queue(queued: DataFrame, repeats: int = 2) -> DataFrame:
    """The merged queue: every copy (n from 0) of documents with words, range-sorted by virtual finish, with its place ``at`` (partition) in the sort."""
    copies = queued.where("size > 0 AND target > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("n"))
    timed = copies.select(((F.col("n") * F.col("source_size") + F.col("finish")) / F.col("target")).alias("copy_finish"), "source", "place", "doc_id", "n", "size")
    order = ["copy_finish", "source", "place", "doc_id", "n"]
    return timed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.spark_partition_id())


def cut_time(merged: DataFrame, budget: float) -> float | None:
    """Virtual finish of the copy at which the words of the merged queue reach the budget; None if they never do.

    Words before a partition of the range-sort are sums of one number for each partition.
    """
    merged = cut(merged)
    sums = merged.groupBy("at").agg(F.sum("size").alias("words"))
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("at", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("at").orderBy("copy_finish", "source", "place", "doc_id", "n").rowsBetween(Window.unboundedPreceding, 0)
    reached = merged.withColumn("words", F.sum("size").over(within)).join(F.broadcast(starts), "at").where(F.col("start") + F.col("words") >= F.lit(budget))
    return reached.agg(F.min("copy_finish")).first()[0]


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", digits: int | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """One row per document: its words, its source's words and target, the words taken and the virtual finish of its first copy.

    The running sums are taken in 16 ** ``digits`` groups of each source, by default enough for groups of a few thousand
    documents even if all come from one source; the result doesn't depend on it.
    """
    digits = digits or max(1, math.ceil(math.log(max(docs.count(), 1) / 2000, 16)))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    sized = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), words_of(F.col(text)).alias("size"), order.alias("place"))
    sized = _spread(cut(sized)).withColumn("bin", F.substring("place", 1, digits))
    starts = cut(_running(sized, digits))
    sources = starts.groupBy(F.col("s").alias("source")).agg(F.max("source_size").alias("source_size"))
    goals = targets(sources, weights, share, repeats).select(F.col("source").alias("gs"), "target")
    placed = starts.join(goals, F.col("s").eqNullSafe(F.col("gs"))).drop("gs")
    within = Window.partitionBy("source", "bin").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    running = sized.withColumn("within", F.sum("size").over(within)).join(placed, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    queued = cut(running.select("doc_id", "source", "place", "size", "source_size", "target", (F.col("bin_start") + F.col("within")).alias("finish")))
    words = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    until = cut_time(queue(queued, repeats), share * words)
    finish, size, total = F.col("finish"), F.col("size"), F.col("source_size")
    given = total * repeats if until is None else F.floor(F.col("target") * F.lit(until))
    taken = sum((F.greatest(F.lit(0), F.least(size, given - (total * n + finish - size))) for n in range(repeats)), F.lit(0))
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), F.when(F.col("target") > 0, finish / F.col("target")).alias("virtual_finish"))


def _spread(sized: DataFrame) -> DataFrame:
    """Sizes with a shuffle key of its own for each row of a crowd of equal ones. ``sized`` is a table that is kept, so a row's number stays."""
    of = F.xxhash64("place")
    seen = sized.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(xxhash64(place), {HEAVY}, {TRACKED})").alias("top")).first()
    crowds = [t["item"] for t in seen["top"] or () if t["count"] >= max(CROWD, seen["rows"] // HEAVY)]
    if not crowds:
        return sized
    own = F.md5(F.concat("place", F.lit(":"), F.monotonically_increasing_id().cast("string")))
    return sized.withColumn("place", F.when(of.isin(crowds), own).otherwise(F.col("place")))


def copies(mixed: DataFrame) -> F.Column:
    """How often a document is emitted: whole copies, and the one that the budget cuts where it keeps at least half of it."""
    return F.when(F.col("size") > 0, F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2))).otherwise(F.lit(0)).cast("int")
