"""Pair the two views of a filing by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.constants import APPLICANT_FIELDS, CERT_ONLY_COPIES, UNPREFIXED_FIELDS
from cartouche.functions import classify, dates, score
from cartouche.functions.text import filled

_CERT = "__cert__"


def outer_pair(detail: DataFrame, certificate: DataFrame) -> DataFrame:
    """Full outer join on ``filing_id``; certificate columns arrive under a private prefix.

    Both inputs must hold one row per id (see ``ordered.latest_per_view``), so no
    id can grow hot in the join.
    """
    left = detail.withColumn("__has_detail", F.lit(True))
    right = certificate.select(
        "filing_id", *[F.col(c).alias(_CERT + c) for c in certificate.columns if c != "filing_id"]
    ).withColumn("__has_certificate", F.lit(True))
    joined = left.join(right, "filing_id", "full_outer")
    return joined.withColumns({
        "has_detail": F.coalesce(F.col("__has_detail"), F.lit(False)),
        "has_certificate": F.coalesce(F.col("__has_certificate"), F.lit(False)),
    }).drop("__has_detail", "__has_certificate")


def _fallback(field: str) -> Column:
    """Own value, or the certificate's when the own one is empty and the other is not."""
    own, other = F.col(field), F.col(_CERT + field)
    return F.when(~filled(own) & filled(other), other).otherwise(own)


def merge_views(detail: DataFrame, certificate: DataFrame) -> DataFrame:
    """Detail wins; certificate columns follow as ``cert_*``; applicant fields fall back.

    A certificate without a detail view keeps its fields under their plain names
    and copies six of them to ``cert_*`` as well.
    """
    mine = [c for c in detail.columns if c != "filing_id"]
    theirs = [c for c in certificate.columns if c != "filing_id"]
    pair = outer_pair(detail, certificate)
    has_detail, has_cert = F.col("has_detail"), F.col("has_certificate")
    alone = ~has_detail

    columns: dict[str, Column] = {}
    for name in mine:
        if name not in theirs:
            columns[name] = F.col(name)
        elif name in APPLICANT_FIELDS:
            columns[name] = _fallback(name)
        else:
            columns[name] = F.when(alone, F.col(_CERT + name)).otherwise(F.col(name))
    for name in theirs:
        if name not in columns:
            columns[name] = F.when(alone | F.lit(name.startswith("cert_")), F.col(_CERT + name))
    for name in theirs:
        prefixed = name if name.startswith("cert_") else f"cert_{name}"
        if name in UNPREFIXED_FIELDS or prefixed in columns:
            continue
        copied = has_cert if name in CERT_ONLY_COPIES else has_cert & has_detail
        columns[prefixed] = F.when(copied, F.col(_CERT + name))

    merged = pair.select(
        "filing_id", *[c.alias(name) for name, c in columns.items()], "has_detail", "has_certificate"
    )
    return with_merged_fields(merged)


def with_merged_fields(merged: DataFrame) -> DataFrame:
    """Completeness, days to approval and product category."""
    day = lambda c: F.col(c).cast("date")
    both_dates = F.col("has_detail") & F.col("filing_date").isNotNull() & F.col("approval_date").isNotNull()
    return merged.withColumns({
        "data_completeness_score": score.completeness(F.col("has_detail")),
        "days_to_approval": F.when(both_dates, dates.days_between(day("filing_date"), day("approval_date"))),
        "product_category": classify.product_category(F.col("product_description")),
    })


def cross_view_consistency(pair: DataFrame, id_pair: tuple[str, str], name_pair: tuple[str, str]) -> DataFrame:
    """Compare ids and applicant names of the two views row by row.

    Adds STRUCT ``consistency`` with ``is_consistent``, ``issues`` and
    ``checked_fields``; a field is checked only when both views have it.
    """
    checks = []
    for label, message, (a, b), norm in [
        ("filing_id", "Filing ID mismatch: detail=%s, cert=%s", id_pair, lambda c: c),
        ("applicant_name", "Applicant name mismatch: detail='%s', cert='%s'", name_pair,
         lambda c: F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))),
    ]:
        left, right = F.col(a), F.col(b)
        checked = filled(left) & filled(right)
        differs = checked & (norm(left) != norm(right))
        checks.append((
            F.when(checked, F.lit(label)),
            F.when(differs, F.format_string(message, left, right)),
        ))
    issues = F.array_compact(F.array(*[i for _, i in checks]))
    return pair.withColumn(
        "consistency",
        F.struct(
            (F.size(issues) == 0).alias("is_consistent"),
            issues.alias("issues"),
            F.array_compact(F.array(*[c for c, _ in checks])).alias("checked_fields"),
        ),
    )
