"""Decimal, percentage, currency, alcohol and container columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartouche.constants import ALCOHOL_PATTERNS, CONTAINER_GENERIC, CONTAINER_PATTERNS
from cartouche.functions.text import none_if_empty, strip, text


def parse_decimal(c: Column, precision: int = 2) -> Column:
    """Keep digits, dot and minus; half-even to ``precision`` places; null when not a number."""
    kept = F.regexp_replace(text(c), r"[^0-9.-]", "")
    number = F.when(kept.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"), kept).try_cast("decimal(38,12)")
    return F.bround(number, precision).try_cast(f"decimal({18 + precision - 2},{precision})")


def parse_percentage(c: Column) -> Column:
    """Values up to 1 are fractions and scaled by 100, after rounding to two places."""
    number = parse_decimal(strip(F.replace(text(c), F.lit("%"), F.lit(""))))
    return F.when(number <= 1, number * 100).otherwise(number).cast("decimal(20,2)")


def clean_currency(c: Column) -> Column:
    return parse_decimal(F.regexp_replace(text(c), r"[$,]", ""))


def extract_alcohol_content(c: Column) -> Column:
    s = F.lower(text(c))
    return F.coalesce(*[none_if_empty(F.regexp_extract(s, p, 1)).try_cast("decimal(18,4)") for p in ALCOHOL_PATTERNS])


def standardize_container_size(c: Column) -> Column:
    """First fixed size found (unanchored, so 1750 ml reads as 750ml), else amount + unit."""
    s = F.lower(text(c))
    first_pattern, first_size = CONTAINER_PATTERNS[0]
    sizes = reduce(
        lambda acc, pair: acc.when(s.rlike(pair[0]), F.lit(pair[1])),
        CONTAINER_PATTERNS[1:],
        F.when(s.rlike(first_pattern), F.lit(first_size)),
    )
    generic = F.concat(F.regexp_extract(s, CONTAINER_GENERIC, 1), F.regexp_extract(s, CONTAINER_GENERIC, 2))
    return sizes.otherwise(none_if_empty(generic))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 for an empty whole."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))
