"""How many partitions a frame is written from, so that each takes a number of bytes within a window.

The size of the whole is told by the optimizer (``plan``, no pass), by the rows in memory (``dataframe``, one pass) or by a sample that is written as it
will be (``sample``, a count and a small write). Partitions within the window stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from millrace.functions import sizes

STRATEGIES = ("plan", "dataframe", "sample")


def wanted(size: int, now: int, least: int | None, most: int | None) -> int:
    """Partitions of a frame of a size that has ``now``: as few more as keep within ``most``, as many fewer as reach ``least``.

    Where both can't be, ``most`` holds. Without a bound to a side there is no change to that side.
    """
    if least is not None and most is not None and least > most:
        raise ValueError(f"partitions can't take at least {least} and at most {most} bytes")
    each = size / max(1, now)
    if most is not None and each > most:
        return max(1, math.ceil(size / (most if least is None else (least + most) / 2)))
    if least is not None and each < least:
        fewer = max(1, int(size // (least if most is None else (least + most) / 2)))
        return min(now, fewer if most is None else max(fewer, math.ceil(size / most)))
    return max(1, now)


def partitions(df: DataFrame) -> int:
    """Partitions of a frame, without running its shuffles: before they ran, those that are planned."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() != "AdaptiveSparkPlanExec":
        return df.rdd.getNumPartitions()
    return plan.inputPlan().outputPartitioning().numPartitions() or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def resized(df: DataFrame, strategy: str, least: int | None = None, most: int | None = None, sample: int = 10_000) -> DataFrame:
    """``df`` in partitions within the window of bytes."""
    if strategy not in STRATEGIES:
        raise ValueError(f"sizes are told by {', '.join(STRATEGIES)}, not {strategy}")
    if least is None and most is None:
        return df
    size = sizes.by_plan(df) if strategy == "plan" else sizes.by_rows(df) if strategy == "dataframe" else sizes.by_sample(df, sample)
    now = partitions(df)
    n = wanted(size, now, least, most)
    return df if n == now else df.repartition(n)
