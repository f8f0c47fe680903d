"""Beverage classes, product categories and origin attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartouche.constants import BEVERAGE_WORDS, CATEGORY_WORDS, DOMESTIC_MARKS, FLAG_WORDS, TYPE_WORDS
from cartouche.functions.text import contains_any, filled, none_if_empty, text


def _first_class(s: Column, classes: list[tuple[str, list[str]]], other: str) -> Column:
    """Ordered classes by plain substrings; null text gives null."""
    chain = reduce(
        lambda acc, pair: acc.when(contains_any(s, pair[1]), F.lit(pair[0])),
        classes,
        F.when(s.isNull(), F.lit(None).cast("string")),
    )
    return chain.otherwise(F.lit(other))


def beverage_type(c: Column) -> Column:
    return _first_class(F.lower(none_if_empty(c)), BEVERAGE_WORDS, "UNKNOWN")


def product_category(c: Column) -> Column:
    return _first_class(F.lower(none_if_empty(c)), CATEGORY_WORDS, "OTHER")


def product_flags(c: Column) -> dict[str, Column]:
    s = F.lower(text(c))
    return {name: contains_any(s, words) for name, words in FLAG_WORDS.items()}


def category_pair(description: Column) -> Column:
    """STRUCT<category, subcategory> of a class description."""
    s = F.lower(F.coalesce(text(description), F.lit("none")))
    wine, beer, spirits = (contains_any(s, TYPE_WORDS[k]) for k in ("Wine", "Beer", "Spirits"))
    category = F.when(wine, "Wine").when(beer, "Beer").when(spirits, "Spirits").otherwise("Other")
    subcategory = (
        F.when(wine, F.when(s.contains("table"), "Table Wine").otherwise("Specialty Wine"))
        .when(beer, F.when(s.contains("beer"), "Standard Beer").otherwise("Specialty Beer"))
        .when(spirits, "Distilled Spirits")
        .otherwise("Specialty Product")
    )
    return F.struct(category.alias("category"), subcategory.alias("subcategory"))


def origin_columns(description: Column) -> dict[str, Column]:
    """State, country, region and domestic flag; marks are plain substrings, so CANADA is domestic."""
    state = none_if_empty(F.regexp_extract(text(description), r"(?U)\b([A-Z]{2})\b", 1))
    domestic = contains_any(text(description), DOMESTIC_MARKS)
    return {
        "state": state,
        "country": F.when(domestic, "USA").otherwise("Other"),
        "region": state,
        "is_domestic": domestic,
    }


def complete_applicant(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [filled(c) for c in columns])


def is_approved(status: Column) -> Column:
    return F.coalesce(F.upper(text(status)).contains("APPROVED"), F.lit(False))
