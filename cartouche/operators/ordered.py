"""Order-dependent operators: keep-first, last-wins, runs of failures, backfill stop, top-k.

Spark has no list order, so every operator takes an explicit total order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartouche.constants import (
    BACKFILL_DAYS,
    EARLIEST_DAY,
    MAX_CONSECUTIVE_FAILURES,
    METHOD_ORDER,
    STOP_AFTER_FOUND_DAYS,
    VIEW_ORDER,
)


def pick_first(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key.

    The rank filter is pushed below the shuffle (window group limit), so each map
    task sends at most one row per key: a key holding a third of all rows stays cheap.
    """
    ranked = frame.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def rank_in(c: Column, values: list) -> Column:
    """Position of a value in a list, unknown ones last."""
    chain = reduce(lambda acc, iv: acc.when(c == iv[1], iv[0]), list(enumerate(values))[1:], F.when(c == values[0], 0))
    return chain.otherwise(len(values))


def dedup_keep_first(frame: DataFrame, key: str = "filing_id", tie_breakers: list[Column] | None = None) -> DataFrame:
    """One row per id in landing order: method 1, 2, 3, 0, then detail before certificate, then sequence."""
    order = [
        rank_in(F.col("receipt_method"), METHOD_ORDER),
        rank_in(F.col("view"), VIEW_ORDER),
        F.col("sequence"),
        *(tie_breakers or []),
    ]
    return pick_first(frame, [key], order)


def latest_per_view(frame: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Last row per (id, view)."""
    return pick_first(frame, ["filing_id", "view"], order or [F.col("sequence").desc()])


def failure_cutoffs(
    log: DataFrame,
    groups: list[str],
    max_failures: int = MAX_CONSECUTIVE_FAILURES,
    block: int = 1_000_000,
) -> DataFrame:
    """Where each group first completes ``max_failures`` failures in a row.

    ``log`` has the group columns, ``sequence`` (unique inside a group) and
    ``success``. Returns one row per group: ``cutoff`` (null when the run never
    completes).

    Two levels keep a hot group off a single task. Windows run inside fixed
    sequence blocks of at most ``block`` rows; each block is summed up as one row
    and only those rows are ordered per group, carrying the open run of failures
    from block to block.
    """
    n = max_failures
    blocked = log.select(*groups, "sequence", F.coalesce(F.col("success"), F.lit(False)).alias("ok")).withColumn(
        "block", F.floor(F.col("sequence") / block)
    )
    inside = Window.partitionBy(*groups, "block").orderBy("sequence").rowsBetween(Window.unboundedPreceding, 0)
    at = F.row_number().over(Window.partitionBy(*groups, "block").orderBy("sequence"))
    runs = (
        blocked.withColumn("at", at)
        .withColumn("last_ok", F.max(F.when(F.col("ok"), F.col("at"))).over(inside))
        .withColumn("run", F.col("at") - F.coalesce(F.col("last_ok"), F.lit(0)))
    )
    opening = F.col("last_ok").isNull()
    # the opening failures matter only up to n: the array is bounded by the threshold
    summary = runs.groupBy(*groups, "block").agg(
        F.count("*").alias("rows"),
        F.max("last_ok").alias("last_ok"),
        F.min(F.when(~opening & (F.col("run") == n), F.col("sequence"))).alias("inner_cut"),
        F.sort_array(F.collect_list(F.when(opening & (F.col("at") <= n), F.col("sequence")))).alias("opening"),
    )
    per_group = Window.partitionBy(*groups).orderBy("block")
    so_far = per_group.rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        summary.withColumn("tail", F.col("rows") - F.coalesce(F.col("last_ok"), F.lit(0)))
        .withColumn("island", F.sum(F.when(F.col("last_ok").isNotNull(), 1).otherwise(0)).over(so_far))
        .withColumn(
            "open",
            F.sum("tail").over(
                Window.partitionBy(*groups, "island").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
            ),
        )
        .withColumn("carry", F.coalesce(F.lag("open").over(per_group), F.lit(0)))
    )
    needed = (F.lit(n) - F.col("carry")).cast("int")
    opening_cut = F.when(needed.between(1, n) & (F.size("opening") >= needed), F.get("opening", needed - 1))
    first = F.coalesce(opening_cut, F.col("inner_cut"))
    return carried.groupBy(*groups).agg(F.min(first).alias("cutoff"))


def keep_until_failures(
    log: DataFrame,
    groups: list[str],
    max_failures: int = MAX_CONSECUTIVE_FAILURES,
    block: int = 1_000_000,
) -> DataFrame:
    """Attempts up to and including the one completing the first run of failures.

    The cutoff table has one row per group; it is joined without a hint, so Spark
    broadcasts it only while it is small and otherwise splits hot groups (AQE).
    """
    cuts = failure_cutoffs(log, groups, max_failures, block)
    return (
        log.join(cuts, groups, "left")
        .where(F.col("cutoff").isNull() | (F.col("sequence") <= F.col("cutoff")))
        .drop("cutoff")
    )


def expected_partitions(days: DataFrame, methods: list[int]) -> DataFrame:
    """Every (partition_date, receipt_method) the days should have."""
    grid = F.explode(F.array(*[F.lit(m) for m in methods]))
    return days.select("partition_date").distinct().withColumn("receipt_method", grid)


def missing_partitions(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected (day, method) pairs without landed data."""
    keys = ["partition_date", "receipt_method"]
    return expected.join(landed.select(*keys).distinct(), keys, "left_anti")


def present_partitions(expected: DataFrame, landed: DataFrame) -> DataFrame:
    keys = ["partition_date", "receipt_method"]
    return expected.join(landed.select(*keys).distinct(), keys, "left_semi")


def backfill_days(
    expected: DataFrame, landed: DataFrame, stop_after: int = STOP_AFTER_FOUND_DAYS
) -> DataFrame:
    """Days to visit walking backward until ``stop_after`` complete days in a row.

    Returns ``partition_date, complete, found_run, stops``; the stopping day is
    included. The window orders one row per calendar day (a few thousand at
    most), after the landed data has been reduced to that grain.
    """
    keys = ["partition_date", "receipt_method"]
    seen = landed.select(*keys).distinct().withColumn("found", F.lit(True))
    days = (
        expected.join(seen, keys, "left")
        .groupBy("partition_date")
        .agg(F.bool_and(F.coalesce(F.col("found"), F.lit(False))).alias("complete"))
    )
    back = Window.orderBy(F.col("partition_date").desc())
    so_far = back.rowsBetween(Window.unboundedPreceding, 0)
    runs = (
        days.withColumn("at", F.row_number().over(back))
        .withColumn("last_gap", F.max(F.when(~F.col("complete"), F.col("at"))).over(so_far))
        .withColumn("found_run", F.col("at") - F.coalesce(F.col("last_gap"), F.lit(0)))
        .withColumn("stops", F.col("found_run") >= stop_after)
    )
    stopped_before = F.coalesce(
        F.max(F.col("stops").cast("int")).over(back.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        runs.withColumn("stopped_before", stopped_before)
        .where(F.col("stopped_before") == 0)
        .select("partition_date", "complete", "found_run", "stops")
    )


def backfill_range(today: Column, max_days: int = BACKFILL_DAYS) -> tuple[Column, Column]:
    """First and last day of a backward backfill: today-2 down to the floor."""
    floor = F.greatest(F.date_sub(today, max_days), F.lit(EARLIEST_DAY).cast("date"))
    return F.date_sub(today, 2), floor


def top_k(frame: DataFrame, measure: str, tie_breaker: str, k: int = 5) -> DataFrame:
    """The k largest rows; ties by name. Runs as per-task heaps, not a full sort."""
    return frame.orderBy(F.col(measure).desc(), F.col(tie_breaker).asc()).limit(k)


def head_sample(frame: DataFrame, key: str, k: int) -> DataFrame:
    """First k rows by key, for reports."""
    return frame.orderBy(F.col(key).asc()).limit(k)
