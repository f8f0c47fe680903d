"""Older flat consolidated table: source-prefixed projection, merge, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.constants import APPLICANT_FIELDS
from cartouche.functions import classify, dates, score
from cartouche.operators.merge import _CERT, _fallback, outer_pair

_DETAIL_TEXT = [
    "serial_number", "brand_name", "fanciful_name", "product_description", "net_contents", "alcohol_content",
    "product_class_type", "origin_code", "formula_number", "qualifications",
]
_DETAIL_DATES = ["filing_date", "approval_date", "expiration_date"]
_CERT_TEXT = [
    "certificate_number", "certificate_status", "certificate_type", "authorized_signature_url", "plant_registry_number",
]
_CERT_FLAGS = ["applicant_signature_present", "authorized_signature_present"]


def _maybe(frame: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name).cast(kind) if name in frame.columns else F.lit(None).cast(kind)


def _date(frame: DataFrame, name: str) -> Column:
    if name not in frame.columns:
        return F.lit(None).cast("date")
    return F.col(name) if dict(frame.dtypes)[name] == "date" else dates.parse_legacy_date(F.col(name))


def _common(frame: DataFrame) -> list[Column]:
    return [
        F.col("filing_id"),
        _maybe(frame, "partition_date", "date").alias("partition_date"),
        _maybe(frame, "receipt_method", "int").alias("receipt_method"),
        *[_maybe(frame, c).alias(c) for c in APPLICANT_FIELDS],
        F.coalesce(_maybe(frame, "filing_id_valid", "boolean"), F.lit(False)).alias("filing_id_valid"),
    ]


def flat_detail(frame: DataFrame) -> DataFrame:
    """Detail rows under ``cola_*`` names; validations come as STRUCT columns when present."""
    checks = []
    for kind in ("product_class", "origin_code"):
        source = f"{kind}_validation"
        known = source in frame.columns
        checks += [
            (F.coalesce(F.col(source)["is_valid"], F.lit(False)) if known else F.lit(False)).alias(f"{source}_is_valid"),
            (F.col(source)["validated_code"] if known else F.lit(None).cast("string")).alias(f"{source}_code"),
            (F.col(source)["description"] if known else F.lit(None).cast("string")).alias(f"{source}_description"),
        ]
    return frame.select(
        *_common(frame),
        *[_maybe(frame, c).alias(f"cola_{c}") for c in _DETAIL_TEXT],
        *[_date(frame, c).alias(f"cola_{c}") for c in _DETAIL_DATES],
        F.coalesce(_maybe(frame, "label_images_count", "int"), F.lit(0)).alias("cola_label_images_count"),
        _maybe(frame, "source_file").alias("cola_source_file"),
        *checks,
    )


def flat_certificate(frame: DataFrame) -> DataFrame:
    return frame.select(
        *_common(frame),
        *[_maybe(frame, c).alias(f"cert_{c}") for c in _CERT_TEXT],
        *[_date(frame, c).alias(f"cert_{c}") for c in ("application_date", "approval_date")],
        *[F.coalesce(_maybe(frame, c, "boolean"), F.lit(False)).alias(f"cert_{c}") for c in _CERT_FLAGS],
        _maybe(frame, "source_file").alias("cert_source_file"),
    )


def merge_flat(detail: DataFrame, certificate: DataFrame) -> DataFrame:
    """Full outer merge of the flat views; only ``cert_*`` columns cross over, applicant fields fall back."""
    pair = outer_pair(detail, certificate)
    columns: dict[str, Column] = {}
    for name in detail.columns:
        if name == "filing_id":
            continue
        if name in APPLICANT_FIELDS:
            columns[name] = _fallback(name)
        elif name in certificate.columns:
            columns[name] = F.when(F.col("has_detail"), F.col(name)).otherwise(F.col(_CERT + name))
        else:
            columns[name] = F.col(name)
    for name in certificate.columns:
        if name.startswith("cert_"):
            columns[name] = F.col(_CERT + name)
    merged = pair.select(
        "filing_id", *[c.alias(n) for n, c in columns.items()], "has_detail", "has_certificate"
    )
    return with_flat_fields(merged)


def with_flat_fields(merged: DataFrame) -> DataFrame:
    applicant = [F.col(c) for c in APPLICANT_FIELDS if c != "applicant_fax"]
    return merged.withColumns({
        "data_completeness_score": score.legacy_completeness(),
        "days_to_approval": dates.days_between(F.col("cola_filing_date"), F.col("cola_approval_date")),
        **classify.product_flags(F.col("cola_product_class_type")),
        "has_complete_applicant_info": classify.complete_applicant(applicant),
    })


def with_tier(merged: DataFrame) -> DataFrame:
    return merged.withColumn("data_quality_tier", score.quality_tier(F.col("data_completeness_score")))
