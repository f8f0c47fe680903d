"""Date columns.

Formats are given strptime-style. Each one is guarded by a regex, so a row is
parsed by at most one formatter and bad text never raises inside the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartouche.constants import DATE_FORMATS, HOLIDAYS, LEGACY_DATE_FORMATS
from cartouche.functions.text import clean_text, none_if_empty, text

# strptime token -> (regex, Spark pattern letter)
TOKENS = {
    "%Y": ("[0-9]{4}", "yyyy"),
    "%y": ("[0-9]{2}", "yyyy"),
    "%m": ("[0-9]{1,2}", "M"),
    "%d": ("[0-9]{1,2}", "d"),
    "%B": ("[A-Za-z]{3,}", "MMMM"),
    "%b": ("[A-Za-z]{3}", "MMM"),
    "%H": ("[0-9]{1,2}", "H"),
    "%M": ("[0-9]{1,2}", "m"),
    "%S": ("[0-9]{1,2}", "s"),
}


def _translate(fmt: str) -> tuple[str, str]:
    guard, pattern = "", ""
    for piece in re.split(r"(%[A-Za-z])", fmt):
        if piece in TOKENS:
            guard += TOKENS[piece][0]
            pattern += TOKENS[piece][1]
        else:
            guard += re.escape(piece).replace("\\ ", " ")
            pattern += piece
    return f"^{guard}$", pattern


def parse_with(s: Column, formats: Sequence[str]) -> Column:
    """First format that fits the whole string; null when none does."""
    branches = []
    for fmt in formats:
        guard, pattern = _translate(fmt)
        value = s
        if "%y" in fmt:
            # two-digit year is always last in the supported formats
            value = F.when(
                F.regexp_extract(s, "([0-9]{2})$", 1) >= "69", F.regexp_replace(s, "([0-9]{2})$", "19$1")
            ).otherwise(F.regexp_replace(s, "([0-9]{2})$", "20$1"))
        stamped = any(t in fmt for t in ("%H", "%M", "%S"))
        parsed = F.try_to_timestamp(value, F.lit(pattern)).cast("date") if stamped else F.try_to_date(value, pattern)
        branches.append(F.when(s.rlike(guard), parsed))
    return F.coalesce(*branches)


def parse_clean_date(s: Column, formats: Sequence[str] | None = None) -> Column:
    """Date of text that is clean already."""
    return parse_with(s, formats or DATE_FORMATS)


def parse_flexible_date(c: Column, formats: Sequence[str] | None = None) -> Column:
    return parse_clean_date(clean_text(c), formats)


def parse_legacy_date(c: Column) -> Column:
    """Older parser: three formats, no cleaning first."""
    return parse_with(text(c), LEGACY_DATE_FORMATS)


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def format_date_iso(c: Column) -> Column:
    return iso(parse_flexible_date(c))


def iso_date(c: Column) -> Column:
    """Strict ISO day, optionally followed by a time part."""
    s = none_if_empty(c)
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"), F.substring(s, 1, 10).try_cast("date"))


def date_id(d: Column) -> Column:
    """YYYYMMDD of a date column."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def day_of_year(d: Column) -> Column:
    return F.dayofyear(d)


def from_day_of_year(year: Column, day: Column) -> Column:
    """Null when the day does not exist in that year."""
    d = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - 1).cast("int"))
    return F.when((day >= 1) & (F.year(d) == year), d)


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def is_holiday(d: Column) -> Column:
    return F.date_format(d, "MM-dd").isin(*HOLIDAYS)


def fiscal_year(d: Column) -> Column:
    """Calendar year from October on, the year before until September (kept as published)."""
    return F.when(F.month(d) >= 10, F.year(d)).otherwise(F.year(d) - 1)


def fiscal_quarter(d: Column) -> Column:
    """1 for Oct-Dec and again for Jan-Mar, then 2 and 3 (kept as published)."""
    m = F.month(d)
    return F.when(m >= 10, F.lit(1)).otherwise(F.floor((m + 2) / 3).cast("int"))


def calendar_columns(d: Column) -> list[Column]:
    """All attributes of the date dimension for one date column."""
    quarter = F.quarter(d)
    weekday = F.weekday(d) + 1
    return [
        date_id(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        quarter.alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        weekday.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        fiscal_year(d).alias("fiscal_year"),
        fiscal_quarter(d).alias("fiscal_quarter"),
        (weekday >= 6).alias("is_weekend"),
        is_holiday(d).alias("is_holiday"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
        season(F.month(d)).alias("season"),
        F.unix_date(d).alias("days_from_epoch"),
    ]


def age_days(ts: Column, now: Column) -> Column:
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(ts)) / 86400).cast("int")
