"""Text, phone and address columns.

Null and '' are both "empty" here: cleaners return '' for them, parsers return
null. ``(?U)`` makes ``\\s`` and ``\\b`` Unicode-aware, so a no-break space counts
as whitespace.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartouche.constants import ADDRESS_ABBREVIATIONS, EMAIL_PATTERN, STATE_CODES, URL_PATTERN, ZIP_PATTERN

NBSP = "\u00a0"


def text(c: Column) -> Column:
    return c.cast("string")


def filled(c: Column) -> Column:
    """Non-null and not ''; never null itself."""
    return F.coalesce(text(c) != "", F.lit(False))


def none_if_empty(c: Column) -> Column:
    return F.nullif(text(c), F.lit(""))


def strip(c: Column) -> Column:
    """Both-ends strip of any whitespace; trim() would only take plain spaces."""
    return F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of whitespace become one blank, none at the ends. Single blanks are left alone, so most text has no match."""
    return F.trim(F.regexp_replace(text(c), r"(?U)\s\s+|[\s&&[^ ]]", " "))


def strip_tags(c: Column, filler: str = "") -> Column:
    return F.regexp_replace(text(c), r"<[^>]+>", filler)


def clean_text(c: Column, strip_html: bool = True, normalize_spaces: bool = True) -> Column:
    s = F.coalesce(text(c), F.lit(""))
    if strip_html:
        s = strip_tags(s)
    if normalize_spaces:
        # no-break spaces and line ends are whitespace, so nothing is left to fix
        return squeeze(s)
    return F.regexp_replace(F.translate(s, NBSP, " "), r"\r\n?", "\n")


def normalize_whitespace(c: Column) -> Column:
    return squeeze(F.coalesce(text(c), F.lit("")))


def page_text(c: Column) -> Column:
    """Cleaner used while reading pages: squeeze, then the literal entity becomes a blank."""
    return F.replace(squeeze(F.coalesce(text(c), F.lit(""))), F.lit("&nbsp;"), F.lit(" "))


def extract_numbers(c: Column, include_decimals: bool = True) -> Column:
    pattern = r"[0-9]+\.?[0-9]*" if include_decimals else r"[0-9]+"
    return F.regexp_extract_all(F.coalesce(text(c), F.lit("")), F.lit(pattern), F.lit(0))


def clean_phone(c: Column) -> Column:
    """Ten digits as (AAA) EEE-NNNN, eleven with a leading 1 as 1-(AAA) EEE-NNNN, else the bare digits."""
    digits = F.regexp_replace(F.coalesce(text(c), F.lit("")), r"[^0-9]", "")
    local = F.regexp_replace(digits, "^([0-9]{3})([0-9]{3})([0-9]{4})$", "($1) $2-$3")
    return F.regexp_replace(local, "^1([0-9]{3})([0-9]{3})([0-9]{4})$", "1-($1) $2-$3")


def normalize_address(c: Column) -> Column:
    """Clean, abbreviate whole words in any case, upper-case."""
    shortened = reduce(
        lambda s, pair: F.regexp_replace(s, rf"(?iU)\b{pair[0]}\b", pair[1]),
        ADDRESS_ABBREVIATIONS,
        clean_text(c),
    )
    return F.upper(shortened)


def extract_zip_code(c: Column) -> Column:
    return none_if_empty(F.regexp_extract(text(c), ZIP_PATTERN, 1))


def normalize_state(c: Column) -> Column:
    s = F.upper(strip(none_if_empty(c)))
    known = reduce(
        lambda acc, pair: acc.when(s == pair[0], F.lit(pair[1])),
        list(STATE_CODES.items())[1:],
        F.when(s == next(iter(STATE_CODES)), F.lit(next(iter(STATE_CODES.values())))),
    )
    return known.otherwise(s)


def match_key(*parts: Column) -> Column:
    """Case- and padding-blind key: parts stripped, upper-cased, joined with '|'."""
    return F.concat_ws("|", *[F.upper(strip(F.coalesce(text(p), F.lit("")))) for p in parts])


def contains_any(c: Column, words: list[str]) -> Column:
    """True when any literal word occurs; false for null. Plain substring search, no regex."""
    return F.coalesce(reduce(lambda a, b: a | b, [c.contains(w) for w in words]), F.lit(False))


def is_email(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(EMAIL_PATTERN), F.lit(False))


def is_url(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(URL_PATTERN), F.lit(False))
