"""Statistics over landed, extracted, merged, fact and dimension tables.

Each is one aggregation with map-side combine; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.constants import COVERAGE_METADATA
from cartouche.functions import lenient
from cartouche.functions.numbers import percent
from cartouche.functions.text import filled, strip


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def extraction_stats(extracted: DataFrame, fields: Column, by: list[str] | None = None) -> DataFrame:
    """Totals, successes, failures, fields extracted and success rate, per view by default."""
    grouped = extracted.withColumn("__fields", fields).groupBy(*(["view"] if by is None else by))
    ok = F.coalesce(F.col("parsing_success"), F.lit(False))
    return grouped.agg(
        F.count("*").alias("total_files"),
        F.count_if(ok).alias("successful_parses"),
        F.count_if(~ok).alias("failed_parses"),
        F.coalesce(F.sum(F.when(ok, F.col("__fields"))), F.lit(0)).alias("total_fields_extracted"),
    ).withColumn("success_rate", ratio(F.col("successful_parses"), F.col("total_files")))


def cleaning_stats(merged: DataFrame, processed: Column, rejected: Column) -> DataFrame:
    """Merged pairs, per-view counts, errors and success rate.

    ``processed`` and ``rejected`` are aggregates over the merged rows or literals
    from an ``Observation`` on the input.
    """
    both = F.col("has_detail") & F.col("has_certificate")
    return merged.agg(
        F.count("*").alias("records_cleaned"),
        F.count_if(both).alias("duplicates_removed"),
        F.count_if(F.col("has_certificate")).alias("certificate_records"),
        F.count_if(F.col("has_detail")).alias("detail_records"),
        processed.alias("records_processed"),
        rejected.alias("validation_errors"),
    ).withColumn("success_rate", F.col("records_cleaned") / F.greatest(F.col("records_processed"), F.lit(1)))


def structuring_stats(structured: DataFrame) -> DataFrame:
    v = F.col("schema_validation")
    return structured.agg(
        F.count("*").alias("records_structured"),
        F.count_if(v["is_valid"]).alias("validation_passed"),
        F.count_if(~v["is_valid"]).alias("validation_failed"),
        F.coalesce(F.sum(F.size(v["errors"])), F.lit(0)).alias("schema_violations"),
        F.avg("final_quality_score").alias("average_quality_score"),
    )


def product_fact_stats(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("fact_records_created"),
        F.count_if(F.col("company_id").isNull()).alias("missing_company_keys"),
        F.count_if(F.col("product_id").isNull()).alias("missing_product_keys"),
        F.avg("final_quality_score").alias("average_quality_score"),
        F.avg("days_to_approval").alias("average_days_to_approval"),
    )


def certificate_fact_stats(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("fact_records_created"),
        F.count_if(F.col("company_id").isNull()).alias("missing_company_keys"),
        F.count_if("is_approved").alias("approved_certificates"),
        F.avg("final_quality_score").alias("average_quality_score"),
    ).withColumn("approval_rate", ratio(F.col("approved_certificates"), F.col("fact_records_created")))


def field_coverage(frame: DataFrame, skip: list[str] | None = None) -> DataFrame:
    """Non-empty count, share and band per field: one pass over the rows, then one row per field.

    Rows with a false ``parsing_success`` do not count.
    """
    skipped = set(COVERAGE_METADATA if skip is None else skip)
    names = [c for c in frame.columns if c not in skipped]
    rows = frame
    if "parsing_success" in frame.columns:
        rows = frame.where(F.coalesce(F.col("parsing_success"), F.lit(True)))
    counted = rows.agg(
        F.count("*").alias("__total"),
        *[F.count_if(lenient.non_empty(F.col(n), frame.schema[n].dataType)).alias(n) for n in names],
    )
    entries = F.array(*[
        F.struct(F.lit(n).alias("field"), F.col(n).alias("non_empty_count"), F.col("__total").alias("total_records"))
        for n in names
    ])
    share = percent(F.col("non_empty_count"), F.col("total_records"))
    return counted.select(F.inline(entries)).withColumn("coverage_percentage", share).withColumn(
        "band", coverage_band(F.col("coverage_percentage"))
    )


def coverage_band(share: Column) -> Column:
    return F.when(share > 80, "high").when(share >= 50, "medium").otherwise("low")


def schema_compliance(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Record-level compliance: ``total_records, valid_records, error_records, missing_fields, extra_fields``.

    A record is valid when no schema field is missing and no present value fails
    its lenient cast. Field sets are compared at plan time.
    """
    have = {f.name: f.dataType for f in frame.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    extra = sorted(set(have) - set(schema.fieldNames()))
    bad = [lenient.is_type_error(F.col(f.name), have[f.name], f.dataType) for f in schema.fields if f.name in have]
    any_bad = reduce(lambda a, b: a | b, bad, F.lit(bool(missing)))
    return frame.agg(
        F.count("*").alias("total_records"),
        F.count_if(~any_bad).alias("valid_records"),
        F.count_if(any_bad).alias("error_records"),
    ).withColumns({
        "missing_fields": F.array(*[F.lit(m) for m in sorted(missing)]).cast("array<string>"),
        "extra_fields": F.array(*[F.lit(e) for e in extra]).cast("array<string>"),
    })


def field_validation(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Per schema field present in the frame: non-null, null and type-error counts."""
    have = {f.name: f.dataType for f in frame.schema.fields}
    fields = [f for f in schema.fields if f.name in have]
    counted = frame.agg(*[
        F.struct(
            F.lit(f.name).alias("field"),
            F.count_if(lenient.lenient_cast(F.col(f.name), have[f.name], f.dataType).isNotNull()).alias("non_null_count"),
            F.count_if(lenient.lenient_cast(F.col(f.name), have[f.name], f.dataType).isNull()).alias("null_count"),
            F.count_if(lenient.is_type_error(F.col(f.name), have[f.name], f.dataType)).alias("type_errors"),
        ).alias(f"f{i}")
        for i, f in enumerate(fields)
    ])
    return counted.select(F.inline(F.array(*[F.col(f"f{i}") for i in range(len(fields))])))


def dataset_quality(compliance: DataFrame, validation: DataFrame) -> DataFrame:
    """Mean of the compliance rate and the mean field completeness. Both inputs are reports of a few rows."""
    fields = validation.agg(
        F.avg(ratio(F.col("non_null_count"), F.col("non_null_count") + F.col("null_count"))).alias("field_completeness")
    )
    records = compliance.select(ratio(F.col("valid_records"), F.col("total_records")).alias("compliance_rate"))
    both = records.withColumn("field_completeness", fields.scalar())
    return both.withColumn("data_quality_score", (F.col("compliance_rate") + F.col("field_completeness")) / 2)


def histogram(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count("*").alias("records"))


def mode(frame: DataFrame, column: str) -> DataFrame:
    """Most frequent value; ties go to the smaller one."""
    counted = histogram(frame, column)
    return counted.orderBy(F.col("records").desc(), F.col(column).asc()).limit(1)


def duplicate_names(companies: DataFrame) -> Column:
    """Rows minus distinct names, ignoring case and padding (an aggregate)."""
    return F.count("*") - F.count_distinct(F.upper(strip(F.coalesce("business_name", F.lit("")))))


def category_counts(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count("*").alias("unique_products"),
        *[
            F.count_if(F.col("product_category") == c).alias(f"{c.lower()}_products")
            for c in ("WINE", "BEER", "SPIRITS")
        ],
    )


def consolidation_ratio(landed: DataFrame, key: str = "filing_id") -> DataFrame:
    """Rows landed, rows that keep-first by ``key`` leaves (one per key, a null key included), and their ratio; one pass."""
    counted = landed.agg(
        F.count("*").alias("landed"), (F.count_distinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("kept"))
    return counted.withColumn("ratio", ratio(F.col("kept"), F.col("landed")))


def export_summary(tables: dict[str, DataFrame]) -> DataFrame:
    rows = [t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def reference_stats(reference: DataFrame, kinds: list[str]) -> DataFrame:
    """Codes per kind; a kind without rows is an extraction error."""
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in kinds]
    rows = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("records"), (F.col(k) == 0).alias("has_errors")) for k in kinds
    ])
    return reference.agg(*counts).select(F.inline(rows))


def fetch_stats(log: DataFrame, groups: list[str]) -> DataFrame:
    ok = F.coalesce(F.col("success"), F.lit(False))
    return log.groupBy(*groups).agg(
        F.count("*").alias("total_processed"),
        F.count_if(ok).alias("total_success"),
        F.count_if(~ok).alias("total_failures"),
    ).withColumn("success_rate", ratio(F.col("total_success"), F.col("total_processed")))


def completeness(columns: dict[str, Column]) -> list[Column]:
    """Percent of rows where each named value is non-empty (aggregates)."""
    return [percent(F.count_if(filled(c)), F.count("*")).alias(name) for name, c in columns.items()]
