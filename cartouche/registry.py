"""Named transformations and rule sets.

A rule set is plain data: ``{field: [{"transform": name, **kwargs}, ...]}``. It is
compiled to one projection, so a whole rule set costs a single pass without
leaving generated code.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.constants import CERTIFICATE, DETAIL
from cartouche.functions import classify, dates, ids, numbers, text

Rules = Mapping[str, Sequence[Mapping[str, Any]]]


class TransformRegistry:
    """Column transformations by name; table transformations join a reference table."""

    def __init__(self) -> None:
        self._columns: dict[str, Callable[..., Column]] = {}
        self._prepare: dict[str, tuple[str, Callable[..., Column]]] = {}
        self._tables: dict[str, Callable[..., DataFrame]] = {}

    def register(self, name: str, fn: Callable[..., Column]) -> None:
        """``fn(column, **kwargs) -> Column``; a pandas UDF wrapped in such a function fits too."""
        self._columns[name] = fn

    def register_prepared(self, name: str, first: str, fn: Callable[..., Column]) -> None:
        """A transformation that is ``fn`` after the transformation ``first``.

        A rule set runs the two as separate steps, so ``fn`` may refer to its input
        many times without repeating ``first`` in the plan.
        """
        self._prepare[name] = (first, fn)
        self.register(name, lambda column, **options: fn(self.apply(first, column), **options))

    def register_table(self, name: str, fn: Callable[..., DataFrame]) -> None:
        """``fn(frame, field, **kwargs) -> DataFrame`` for transformations that need a join."""
        self._tables[name] = fn

    def available(self) -> list[str]:
        return sorted({*self._columns, *self._tables})

    def apply(self, name: str, column: Column, **kwargs: Any) -> Column:
        if name not in self._columns:
            raise KeyError(f"Unknown transformation: {name}")
        return self._columns[name](column, **kwargs)

    def apply_table(self, name: str, frame: DataFrame, field: str, **kwargs: Any) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"Unknown table transformation: {name}")
        return self._tables[name](frame, field, **kwargs)

    def _steps(self, rules: Sequence[Mapping[str, Any]]) -> list[Callable[[Column], Column]]:
        """Single steps of a rule list; a cleaner straight after itself is dropped."""
        named: list[tuple[str, dict[str, Any], Callable[..., Column]]] = []
        for rule in rules:
            name, options = rule["transform"], {k: v for k, v in rule.items() if k != "transform"}
            if name not in self._columns:
                raise KeyError(f"Unknown transformation: {name}")
            if name in self._prepare:
                first, fn = self._prepare[name]
                named += [(first, {}, self._columns[first]), (name, options, fn)]
            else:
                named.append((name, options, self._columns[name]))
        kept = [s for i, s in enumerate(named) if not (i and s[:2] == named[i - 1][:2] and s[0] in IDEMPOTENT)]
        return [lambda c, fn=fn, options=options: fn(c, **options) for _, options, fn in kept]

    def apply_rules(self, frame: DataFrame, rules: Rules) -> DataFrame:
        """Rewrite the fields that exist; fields the frame lacks are skipped.

        Runs step by step over all fields at once (the first rule of every field,
        then the second, ...): each step is a projection over plain columns, which
        Spark keeps apart where merging would repeat work.
        """
        steps = {f: self._steps(rules[f]) for f in rules if f in frame.columns}
        for depth in range(max(map(len, steps.values()), default=0)):
            frame = frame.withColumns({f: s[depth](F.col(f)) for f, s in steps.items() if depth < len(s)})
        return frame


IDEMPOTENT = {"clean_text", "normalize_whitespace"}

registry = TransformRegistry()
for _name, _fn in {
    "clean_text": text.clean_text,
    "normalize_whitespace": text.normalize_whitespace,
    "extract_numbers": text.extract_numbers,
    "clean_phone": text.clean_phone,
    "parse_decimal": numbers.parse_decimal,
    "parse_percentage": numbers.parse_percentage,
    "clean_currency": numbers.clean_currency,
    "validate_filing_id": ids.is_filing_id,
    "validate_email": text.is_email,
    "validate_url": text.is_url,
    "normalize_address": text.normalize_address,
    "extract_zip_code": text.extract_zip_code,
    "normalize_state": text.normalize_state,
    "classify_beverage_type": classify.beverage_type,
    "extract_alcohol_content": numbers.extract_alcohol_content,
    "standardize_container_size": numbers.standardize_container_size,
}.items():
    registry.register(_name, _fn)
registry.register_prepared("parse_date", "clean_text", dates.parse_clean_date)
registry.register_prepared("format_date_iso", "parse_date", dates.iso)


def _chain(*names: str) -> list[dict[str, Any]]:
    return [{"transform": n} for n in names]


RULES: dict[str, Rules] = {
    DETAIL: {
        "filing_date": _chain("clean_text", "parse_date"),
        "approval_date": _chain("clean_text", "parse_date"),
        "expiration_date": _chain("clean_text", "parse_date"),
        "brand_name": _chain("clean_text"),
        "fanciful_name": _chain("clean_text"),
        "product_description": _chain("clean_text"),
        "applicant_business_name": _chain("clean_text"),
        "applicant_mailing_address": _chain("clean_text", "normalize_address"),
        "applicant_phone": _chain("clean_phone"),
        "applicant_email": _chain("clean_text"),
        "alcohol_content": _chain("extract_alcohol_content"),
        "net_contents": _chain("standardize_container_size"),
    },
    CERTIFICATE: {
        "application_date": _chain("clean_text", "parse_date"),
        "approval_date": _chain("clean_text", "parse_date"),
        "certificate_status": _chain("clean_text"),
        "certificate_type": _chain("clean_text"),
        "applicant_business_name": _chain("clean_text"),
        "applicant_mailing_address": _chain("clean_text", "normalize_address"),
        "applicant_phone": _chain("clean_phone"),
        "applicant_email": _chain("clean_text"),
    },
}

LEGACY_RULES: dict[str, Rules] = {
    DETAIL: {
        "filing_date": _chain("clean_text", "parse_date", "format_date_iso"),
        "approval_date": _chain("clean_text", "parse_date", "format_date_iso"),
        "expiration_date": _chain("clean_text", "parse_date", "format_date_iso"),
        "brand_name": _chain("clean_text", "normalize_whitespace"),
        "applicant_business_name": _chain("clean_text", "normalize_whitespace"),
        "applicant_address": _chain("clean_text", "normalize_address"),
        "applicant_phone": _chain("clean_phone"),
        "applicant_email": _chain("clean_text", "normalize_whitespace"),
        "alcohol_content": _chain("extract_alcohol_content"),
        "net_contents": _chain("standardize_container_size"),
        "wine_appellation": _chain("clean_text", "normalize_whitespace"),
        "wine_vintage": [{"transform": "extract_numbers", "include_decimals": False}],
    },
    CERTIFICATE: {
        "effective_date": _chain("clean_text", "parse_date", "format_date_iso"),
        "expiration_date": _chain("clean_text", "parse_date", "format_date_iso"),
        "trade_name": _chain("clean_text", "normalize_whitespace"),
        "premises_address": _chain("clean_text", "normalize_address"),
        "mailing_address": _chain("clean_text", "normalize_address"),
        "phone": _chain("clean_phone"),
        "email": _chain("clean_text", "normalize_whitespace"),
    },
}


def rules_for(view: str, legacy: bool = False) -> Rules:
    """Rule set of a view; an unknown view has none."""
    return (LEGACY_RULES if legacy else RULES).get(view, {})


def legacy_classification(frame: DataFrame) -> DataFrame:
    """What the older rule run added for detail rows: beverage type and id validity.

    Brand, appellation and description are joined by blanks, absent ones as ''.
    """
    parts = [
        F.coalesce(text.text(F.col(c)), F.lit("")) if c in frame.columns else F.lit("")
        for c in ("brand_name", "wine_appellation", "product_description")
    ]
    valid = F.when(text.filled(F.col("filing_id")), ids.is_filing_id(F.col("filing_id")))
    return frame.withColumns(
        {"beverage_type": classify.beverage_type(F.concat_ws(" ", *parts)), "filing_id_valid": valid}
    )
