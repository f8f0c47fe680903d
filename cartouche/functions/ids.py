"""Filing ids and hash keys.

A filing id is ``YY JJJ RRR SSSSSS``: year, day of year, receipt method, sequence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartouche.constants import RECEIPT_METHODS
from cartouche.functions.text import match_key, strip, text


def is_filing_id(c: Column) -> Column:
    return F.coalesce(strip(c).rlike("^[0-9]{14}$"), F.lit(False))


def build_filing_id(year: Column, day: Column, method: Column, sequence: Column) -> Column:
    """Zero-padded parts, written as one number where each part fits its width; a wider part is not cut."""
    yy, day, method, sequence = (c.cast("bigint") for c in (year % 100, day, method, sequence))
    fits = day.between(0, 999) & method.between(0, 999) & sequence.between(0, 999_999)
    number = ((yy * 1000 + day) * 1000 + method) * 1_000_000 + sequence
    return F.when(fits, F.lpad(number.cast("string"), 14, "0")).otherwise(
        F.format_string("%02d%03d%03d%06d", yy, day, method, sequence)
    )


def parse_filing_id(c: Column) -> Column:
    """STRUCT<year, julian_day, receipt_method, sequence, error>; parts are null when invalid."""
    s = text(c)
    well_formed = F.coalesce(s.rlike("^[0-9]{14}$"), F.lit(False))
    yy, day = F.substring(s, 1, 2).try_cast("int"), F.substring(s, 3, 3).try_cast("int")
    method, sequence = F.substring(s, 6, 3).try_cast("int"), F.substring(s, 9, 6).try_cast("int")
    year = F.when(yy <= 30, yy + 2000).otherwise(yy + 1900)
    error = (
        F.when(~well_formed, "format")
        .when(~day.between(1, 366), "julian_day")
        .when(~method.isin(0, 1, 2, 3), "receipt_method")
        .when(sequence < 1, "sequence")
    )
    good = error.isNull()
    return F.struct(
        F.when(good, year).alias("year"),
        F.when(good, day).alias("julian_day"),
        F.when(good, method).alias("receipt_method"),
        F.when(good, sequence).alias("sequence"),
        error.alias("error"),
    )


def partition_key(c: Column) -> Column:
    """``YYYY-JJJ-RRR`` of a filing id; null when the id is invalid."""
    p = parse_filing_id(c)
    key = F.format_string("%d-%03d-%03d", p["year"], p["julian_day"], p["receipt_method"])
    return F.when(p["error"].isNull(), key)


def build_long_id(year: Column, day: Column, method: Column, sequence: Column) -> Column:
    """Older 17-digit form with a four-digit year."""
    return F.format_string("%d%03d%03d%06d", year.cast("int"), day.cast("int"), method.cast("int"),
                           sequence.cast("int"))


def parse_long_id(c: Column) -> Column:
    s = text(c)
    ok = F.length(s) == 17
    names = [("year", 1, 4), ("julian_day", 5, 3), ("receipt_method", 8, 3), ("sequence", 11, 7)]
    return F.struct(*[F.when(ok, F.substring(s, at, n).try_cast("int")).alias(name) for name, at, n in names])


def receipt_method_name(c: Column) -> Column:
    pairs = [F.lit(x) for pair in RECEIPT_METHODS.items() for x in pair]
    return F.element_at(F.create_map(*pairs), c.cast("int"))


def short_key(s: Column) -> Column:
    """First 32 bits of the md5 as a number."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def surrogate_id(*parts: Column) -> Column:
    """32-bit key over normalised parts; see ``dims.id_collisions`` for the audit."""
    return short_key(match_key(*parts))


def surrogate_key(*parts: Column) -> Column:
    """128-bit key over normalised parts; joins and groupings use this one."""
    return F.md5(match_key(*parts))


def fact_id(kind: str, filing_id: Column) -> Column:
    return short_key(F.concat(F.lit(kind + "_"), filing_id))


def legacy_company_hash(name: Column, address: Column) -> Column:
    """Older key over raw parts; a missing address hashes as the text None."""
    joined = F.concat(name, F.lit("|"), F.coalesce(address, F.lit("None")))
    return F.substring(F.md5(joined), 1, 16)


def legacy_company_id(name: Column, address: Column) -> Column:
    return short_key(F.concat(name, F.lit("|"), F.coalesce(address, F.lit("None"))))


def legacy_fact_id(filing_id: Column, kind: str) -> Column:
    return short_key(F.concat(filing_id, F.lit("_" + kind)))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)
