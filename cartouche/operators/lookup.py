"""Joins against reference codes and dimensions."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.functions.text import filled, none_if_empty, strip, text
from cartouche.registry import registry


def codes_of(reference: DataFrame, kind: str) -> DataFrame:
    """One (code, description) per code of a kind; of repeated codes the last extracted one."""
    return (
        reference.where(F.col("kind") == kind)
        .groupBy("code")
        .agg(F.max_by("description", F.struct("extracted_at", "description")).alias("description"))
    )


def codes_by_description(reference: DataFrame, kind: str) -> DataFrame:
    """Reverse view: of several codes with one description the last one wins."""
    return (
        reference.where(F.col("kind") == kind)
        .groupBy("description")
        .agg(F.max_by("code", F.struct("extracted_at", "code")).alias("code"))
    )


def validate_code(frame: DataFrame, field: str, codes: DataFrame, label: str, output: str | None = None) -> DataFrame:
    """Add STRUCT<is_valid, original_value, validated_code, description, validation_error>.

    ``codes`` holds one row per code, so rows are never multiplied. No join hint:
    code lists are small today, and Spark checks their size before broadcasting.
    """
    ref = codes.select(F.col("code").alias("__code"), F.col("description").alias("__description"))
    key = none_if_empty(strip(F.col(field)))
    joined = frame.withColumn("__key", key).join(ref, F.col("__key") == F.col("__code"), "left")
    hit = F.col("__code").isNotNull()
    error = F.when(~filled(F.col(field)), F.lit("Empty value")).when(
        ~hit, F.concat(F.lit(f"Unknown {label}: "), strip(F.col(field)))
    )
    result = F.struct(
        hit.alias("is_valid"),
        text(F.col(field)).alias("original_value"),
        F.col("__code").alias("validated_code"),
        F.col("__description").alias("description"),
        error.alias("validation_error"),
    )
    return joined.withColumn(output or f"{field}_validation", result).drop("__key", "__code", "__description")


def validate_product_class(frame: DataFrame, field: str, reference: DataFrame, **options) -> DataFrame:
    codes = codes_of(reference, "product_class_type")
    return validate_code(frame, field, codes, "product class type code", **options)


def validate_origin_code(frame: DataFrame, field: str, reference: DataFrame, **options) -> DataFrame:
    return validate_code(frame, field, codes_of(reference, "origin_code"), "origin code", **options)


registry.register_table("validate_product_class", validate_product_class)
registry.register_table("validate_origin_code", validate_origin_code)


def code_for_description(frame: DataFrame, field: str, reference: DataFrame, kind: str, output: str) -> DataFrame:
    by_text = codes_by_description(reference, kind)
    return frame.join(
        by_text.select(F.col("description").alias(field), F.col("code").alias(output)), field, "left"
    )


def foreign_key(frame: DataFrame, key: Column, dimension: DataFrame, dim_key: str, dim_id: str) -> DataFrame:
    """Left lookup of ``dim_key`` and ``dim_id`` by a full key; no match, or a null key, leaves both null.

    The dimension has one row per key. While it is under Spark's broadcast size the
    facts do not shuffle; beyond that the facts shuffle by key and AQE splits the
    partitions of hot keys (one small row on the other side).
    """
    dim = dimension.select(dim_key, dim_id)
    return frame.withColumn("__fact_key", key).join(dim, F.col("__fact_key") == dim[dim_key], "left").drop("__fact_key")


def orphans(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose non-null key is not in the dimension."""
    return facts.where(F.col(fact_key).isNotNull()).join(
        dimension.select(F.col(dim_key).alias(fact_key)), fact_key, "left_anti"
    )


def orphan_report(facts: DataFrame, checks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per foreign key: ``foreign_key, orphans``.

    The facts are read once: each dimension, which has one row per key, is looked up from the left and all foreign keys
    are counted together.
    """
    out = facts.select(*dict.fromkeys(fk for fk, _, _ in checks))
    for i, (fk, dim, pk) in enumerate(checks):
        keys = dim.select(F.col(pk).alias(f"__key{i}"), F.lit(True).alias(f"__hit{i}"))
        out = out.join(keys, F.col(fk) == F.col(f"__key{i}"), "left")
    missing = [F.count_if(F.col(fk).isNotNull() & F.col(f"__hit{i}").isNull()).alias(fk) for i, (fk, _, _) in enumerate(checks)]
    return out.agg(*missing).unpivot([], [fk for fk, _, _ in checks], "foreign_key", "orphans")


def with_dates(facts: DataFrame, dim_dates: DataFrame, roles: dict[str, str], columns: list[str]) -> DataFrame:
    """Role-playing date joins: ``{date_id column: prefix}``, dimension columns under the prefix.

    The calendar has one row per day between fixed years (about 366 per year), so
    broadcasting it is bounded whatever the facts hold.
    """
    out = facts
    for key, prefix in roles.items():
        side = dim_dates.select(F.col("date_id").alias(key), *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
        out = out.join(F.broadcast(side), key, "left")
    return out
