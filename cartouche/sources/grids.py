"""Generated rows: date spines, candidate ids, work grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.constants import METHOD_ORDER, VIEW_ORDER
from cartouche.functions.ids import build_filing_id

MAX_SEQUENCE = 999_999


def date_spine(bounds: DataFrame, start: str, end: str, backward: bool = False, name: str = "date") -> DataFrame:
    """Every day between two date columns, inclusive, ascending or descending."""
    step = F.expr("INTERVAL '-1' DAY" if backward else "INTERVAL '1' DAY")
    first, last = (F.col(end), F.col(start)) if backward else (F.col(start), F.col(end))
    return bounds.where(F.col(start) <= F.col(end)).select(F.explode(F.sequence(first, last, step)).alias(name))


def year_bounds(frame: DataFrame, day: Column) -> DataFrame:
    """First day of the first year and last day of the last year seen in a date column."""
    return frame.agg(
        F.make_date(F.year(F.min(day)), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.year(F.max(day)), F.lit(12), F.lit(31)).alias("last_day"),
    )


def candidate_ids(
    days: DataFrame, methods: list[int] | None = None, start: Column | int = 1, end: Column | int = MAX_SEQUENCE
) -> DataFrame:
    """Every possible filing id of the days (column ``date``) for the methods and a sequence range.

    Sequences are generated in blocks of 1,000, so one (day, method) spreads over
    many rows before ids are formed and no array exceeds a block. A sequence of
    more than six digits gives a longer id, which ``is_filing_id`` rejects.
    """
    lo, hi = (c if isinstance(c, Column) else F.lit(c) for c in (start, end))
    order = F.array(*[F.lit(m) for m in (methods or METHOD_ORDER)])
    grid = days.select("date", lo.cast("long").alias("lo"), hi.cast("long").alias("hi")).where(F.col("lo") <= F.col("hi"))
    blocks = grid.select("date", "hi", F.explode(order).alias("receipt_method"),
                         "lo").select("date", "hi", "receipt_method", F.explode(
                             F.sequence(F.col("lo"), F.col("hi"), F.lit(1000))).alias("at"))
    rows = blocks.select(
        "date", "receipt_method",
        F.explode(F.sequence(F.col("at"), F.least(F.col("at") + 999, F.col("hi")))).alias("sequence"),
    ).withColumn("sequence", F.col("sequence").cast("int"))
    fid = build_filing_id(F.year("date"), F.dayofyear("date"), F.col("receipt_method"), F.col("sequence"))
    return rows.withColumn("filing_id", fid)


def split_list(c: Column) -> Column:
    """Trimmed items of a comma list."""
    return F.transform(F.split(c, ","), lambda item: F.trim(item))


def work_grid(days: DataFrame, methods: str = "001,002,003,000", views: str = ",".join(VIEW_ORDER)) -> DataFrame:
    """Days x (receipt method, view) from comma lists; ``work_key`` is ``RRR-view``."""
    return (
        days.select("date", F.explode(split_list(F.lit(methods))).alias("method"))
        .select("date", "method", F.explode(split_list(F.lit(views))).alias("view"))
        .withColumn("work_key", F.concat_ws("-", "method", "view"))
        .withColumn("receipt_method", F.col("method").cast("int"))
        .drop("method")
    )
