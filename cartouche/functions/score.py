"""Completeness and quality scores.

Scores add in hundredths as whole numbers and divide once at the end, so no
floating-point drift decides a threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartouche.constants import (
    COMPLETENESS_BASE,
    COMPLETENESS_DETAIL,
    CRITICAL_FIELDS,
    LEGACY_COMPLETENESS,
    LEGACY_CRITICAL,
    LEGACY_IMPORTANT,
    LEGACY_OPTIONAL,
    QUALITY_TIERS,
)
from cartouche.functions.text import filled, text


def points(condition: Column, n: int) -> Column:
    return F.when(condition, F.lit(n)).otherwise(F.lit(0))


def total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def count_filled(columns: list[Column]) -> Column:
    return total([points(filled(c), 1) for c in columns])


def completeness(has_detail: Column) -> Column:
    """Share of three base fields, or of six when a detail view is there."""
    base = count_filled([F.col(c) for c in COMPLETENESS_BASE])
    extra = count_filled([F.col(c) for c in COMPLETENESS_DETAIL])
    return F.when(has_detail, (base + extra) / 6.0).otherwise(base / 3.0)


def legacy_completeness() -> Column:
    return count_filled([F.col(c) for c in LEGACY_COMPLETENESS]) / float(len(LEGACY_COMPLETENESS))


def final_quality(transform_columns: int = 0) -> Column:
    """0.4 x completeness + source bonus + transform bonus + 0.1 x critical share."""
    both = F.col("has_detail") & F.col("has_certificate")
    one = F.col("has_detail") | F.col("has_certificate")
    source = F.when(both, 0.3).when(one, 0.15).otherwise(0.0)
    transform = min(transform_columns / 10, 0.2)
    critical = count_filled([F.col(c) for c in CRITICAL_FIELDS]) / float(len(CRITICAL_FIELDS)) * 0.1
    return F.coalesce(F.col("data_completeness_score"), F.lit(0.0)) * 0.4 + source + F.lit(transform) + critical


def company_quality(name: Column, address: Column, phone: Column, email: Column) -> Column:
    raw = total([
        points(filled(name), 30),
        points(filled(name) & (F.length(name) > 5), 10),
        points(filled(address), 30),
        points(filled(address) & address.contains(","), 10),
        points(filled(phone), 15),
        points(filled(email), 15),
    ])
    return F.least(raw, F.lit(100)) / 100.0


def product_quality(
    brand: Column, class_code: Column, origin: Column, description: Column, alcohol: Column, contents: Column
) -> Column:
    weighted = [(brand, 25), (class_code, 20), (origin, 15), (description, 20), (contents, 10)]
    raw = total([points(filled(c), n) for c, n in weighted])
    # a zero strength counts as missing
    strong = F.coalesce(alcohol.try_cast("double") != 0, F.lit(False))
    return F.least(raw + points(strong, 10), F.lit(100)) / 100.0


def legacy_quality() -> Column:
    """Critical fields count double; a blank string still counts as present."""
    present = lambda names: total([points(F.col(n).isNotNull(), 1) for n in names])
    top = len(LEGACY_CRITICAL) * 2 + len(LEGACY_IMPORTANT) + len(LEGACY_OPTIONAL)
    return (present(LEGACY_CRITICAL) * 2 + present(LEGACY_IMPORTANT) + present(LEGACY_OPTIONAL)) / float(top)


def _meets(tier: dict) -> Column:
    fields = [filled(text(F.col(f))) for f in tier["required_fields"]]
    flags = [F.coalesce(F.col(f), F.lit(False)) for f in tier["required_flags"]]
    return reduce(lambda a, b: a & b, fields + flags)


def quality_tier(score: Column) -> Column:
    """Premium, standard or basic; unmet requirements cost exactly one tier."""
    premium, standard = QUALITY_TIERS["premium"], QUALITY_TIERS["standard"]
    return (
        F.when(score >= premium["min_score"], F.when(_meets(premium), "premium").otherwise("standard"))
        .when(score >= standard["min_score"], F.when(_meets(standard), "standard").otherwise("basic"))
        .otherwise("basic")
    )
