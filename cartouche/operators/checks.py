"""Table-level quality checks.

Each check is one aggregation that yields one row: ``check, passed, severity,
description, issues`` and its metrics. A passing check has no severity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.constants import ESSENTIAL_FIELDS
from cartouche.functions import classify, dates
from cartouche.functions.numbers import percent
from cartouche.functions.text import filled, strip, text
from cartouche.operators import stats
from cartouche.operators.ordered import head_sample, top_k


@dataclass(frozen=True)
class Thresholds:
    """Acceptance limits; percentages unless a score or a count."""

    parsing_failure: float = 85.0
    parsing_warning: float = 95.0
    field_completeness: float = 70.0
    id_validity: float = 90.0
    transform_errors: float = 10.0
    compliance: float = 95.0
    compliance_errors: float = 5.0
    class_codes: int = 500
    origin_codes: int = 200
    foreign_keys: float = 95.0
    quality: float = 0.6
    fact_dates: float = 80.0
    low_quality: float = 20.0
    low_quality_score: float = 0.5
    addresses: float = 90.0
    short_descriptions: float = 5.0
    max_age_days: int = 7
    approval: float = 80.0
    certificate_fields: float = 90.0


LIMITS = Thresholds()


def one_decimal(c: Column) -> Column:
    return F.format_string("%.1f", F.bround(c, 1))


def two_decimals(c: Column) -> Column:
    return F.format_string("%.2f", F.bround(c, 2))


def issue(condition: Column, *parts) -> Column:
    message = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.when(condition, message)


def verdict(
    measured: DataFrame,
    name: str,
    rows: str,
    issues: list[Column],
    description: Column,
    empty_text: str,
    empty_severity: str = "WARN",
    severity: Column | None = None,
    passed: Column | None = None,
) -> DataFrame:
    """Turn one row of metrics into a check result; ``rows`` names the row-count metric."""
    metrics = measured.columns
    found = F.array_compact(F.array(*issues)) if issues else F.array().cast("array<string>")
    none = F.col(rows) == 0
    return (
        measured.withColumn("issues", F.when(none, F.array().cast("array<string>")).otherwise(found))
        .withColumn("passed", ~none & (passed if passed is not None else F.size("issues") == 0))
        .withColumn(
            "severity",
            F.when(none, empty_severity).otherwise(severity if severity is not None else F.when(~F.col("passed"), "WARN")),
        )
        .withColumn("description", F.when(none, empty_text).otherwise(description))
        .select(F.lit(name).alias("check"), "passed", "severity", "description", "issues", *metrics)
    )


def parsing_success(extracted: DataFrame, limits: Thresholds = LIMITS) -> DataFrame:
    ok = F.coalesce(F.col("parsing_success"), F.lit(False))
    measured = extracted.agg(
        F.count("*").alias("total_files"),
        F.count_if(ok).alias("successful_parses"),
        F.count_if(~ok).alias("failed_parses"),
        percent(F.count_if(ok), F.count("*")).alias("success_rate_percent"),
    )
    rate = F.col("success_rate_percent")
    low = rate < limits.parsing_failure
    return verdict(
        measured,
        "parsing_success_rate",
        "total_files",
        [
            issue(low, f"Below failure threshold of {limits.parsing_failure}%"),
            issue(~low & (rate < limits.parsing_warning), f"Below warning threshold of {limits.parsing_warning}%"),
        ],
        F.concat(F.lit("Parsing success rate: "), one_decimal(rate), F.lit("% ("), F.col("successful_parses").cast(
            "string"), F.lit("/"), F.col("total_files").cast("string"), F.lit(" files)")),
        "No files found to process",
        severity=F.when(low, "ERROR").when(rate < limits.parsing_warning, "WARN"),
        passed=~low,
    )


def extraction_completeness(extracted: DataFrame, view: str, limits: Thresholds = LIMITS) -> DataFrame:
    """Share of rows with each essential field of the view; blank text is empty."""
    fields = ESSENTIAL_FIELDS.get(view, ["filing_id"])
    value = lambda f: strip(text(F.col(f))) if f in extracted.columns else F.lit(None).cast("string")
    measured = extracted.agg(
        F.count("*").alias("total_records"),
        *[percent(F.count_if(filled(value(f))), F.count("*")).alias(f"{f}_percent") for f in fields],
    )
    shares = [F.col(f"{f}_percent") for f in fields]
    overall = sum(shares[1:], shares[0]) / len(shares)
    measured = measured.withColumn("overall_completeness_percent", overall)
    return verdict(
        measured,
        "field_extraction_completeness",
        "total_records",
        [issue(F.col(f"{f}_percent") < limits.field_completeness, f) for f in fields],
        F.concat(F.lit("Field extraction completeness: "), one_decimal(F.col("overall_completeness_percent")),
                 F.lit("% average")),
        "No parsed records found",
    )


def validation_rates(
    rows: DataFrame, id_valid: Column, class_valid: Column, origin_valid: Column, failed: Column,
    limits: Thresholds = LIMITS,
) -> DataFrame:
    n = F.count("*")
    share = lambda c: percent(F.count_if(F.coalesce(c, F.lit(False))), n)
    measured = rows.agg(
        n.alias("total_records"),
        F.count_if(F.coalesce(id_valid, F.lit(False))).alias("valid_ids"),
        F.count_if(F.coalesce(class_valid, F.lit(False))).alias("valid_product_classes"),
        F.count_if(F.coalesce(origin_valid, F.lit(False))).alias("valid_origin_codes"),
        share(id_valid).alias("id_validation_rate"),
        share(class_valid).alias("product_class_validation_rate"),
        share(origin_valid).alias("origin_code_validation_rate"),
        share(failed).alias("transformation_error_rate"),
    )
    low, high = F.col("id_validation_rate"), F.col("transformation_error_rate")
    return verdict(
        measured,
        "transformation_validation_rates",
        "total_records",
        [
            issue(low < limits.id_validity, "Low filing ID validation rate: ", one_decimal(low), "%"),
            issue(high > limits.transform_errors, "High transformation error rate: ", one_decimal(high), "%"),
        ],
        F.concat(
            F.lit("Validation rates - Filing ID: "), one_decimal(low),
            F.lit("%, Product Class: "), one_decimal(F.col("product_class_validation_rate")),
            F.lit("%, Origin: "), one_decimal(F.col("origin_code_validation_rate")), F.lit("%"),
        ),
        "No transformed records found",
    )


def schema_compliance(frame: DataFrame, schema: T.StructType, limits: Thresholds = LIMITS) -> DataFrame:
    counted = stats.schema_compliance(frame, schema)
    measured = counted.withColumns({
        "compliance_rate": percent(F.col("valid_records"), F.col("total_records")),
        "error_rate": percent(F.col("error_records"), F.col("total_records")),
    })
    good, bad = F.col("compliance_rate"), F.col("error_rate")
    return verdict(
        measured,
        "schema_compliance",
        "total_records",
        [
            issue(good < limits.compliance, "Low compliance rate: ", one_decimal(good), "%"),
            issue(bad > limits.compliance_errors, "Error rate: ", one_decimal(bad), "%"),
        ],
        F.concat(F.lit("Schema compliance: "), one_decimal(good), F.lit("%")),
        "No records found for schema validation",
    )


def reference_presence(reference: DataFrame, limits: Thresholds = LIMITS) -> DataFrame:
    measured = _code_counts(reference)
    return verdict(
        measured,
        "reference_data_freshness",
        "total_reference_records",
        _count_issues(limits),
        F.concat(F.lit("Reference data loaded: "), F.col("product_codes_count").cast("string"),
                 F.lit(" product codes, "), F.col("origin_codes_count").cast("string"), F.lit(" origin codes")),
        "Failed to load reference data",
        empty_severity="ERROR",
    )


def _kind(name: str) -> Column:
    return F.col("kind") == name


def _code_counts(reference: DataFrame, *more: Column) -> DataFrame:
    codes = lambda kind: F.count_distinct(F.when(_kind(kind), F.col("code")))
    return reference.agg(
        codes("product_class_type").alias("product_codes_count"),
        codes("origin_code").alias("origin_codes_count"),
        *more,
    ).withColumn("total_reference_records", F.col("product_codes_count") + F.col("origin_codes_count"))


def _count_issues(limits: Thresholds) -> list[Column]:
    return [
        issue(F.col("product_codes_count") < limits.class_codes, "Low product code count: ",
              F.col("product_codes_count"), f" (expected ≥ {limits.class_codes})"),
        issue(F.col("origin_codes_count") < limits.origin_codes, "Low origin code count: ",
              F.col("origin_codes_count"), f" (expected ≥ {limits.origin_codes})"),
    ]


def reference_samples(reference: DataFrame, kind: str, k: int = 10) -> DataFrame:
    """First codes of a kind, for the report."""
    return head_sample(reference.where(_kind(kind)).select("code").distinct(), "code", k)


def reference_coverage(reference: DataFrame, now: Column, limits: Thresholds = LIMITS) -> DataFrame:
    """Counts, short descriptions, missing kinds and age of the code lists.

    ``now`` is given so that a rerun gives the same answer.
    """
    short = lambda kind: F.count_distinct(
        F.when(_kind(kind) & (F.length(strip(F.coalesce("description", F.lit("")))) < 3), F.col("code"))
    )
    newest = lambda kind: F.max(F.when(_kind(kind), F.col("extracted_at")))
    measured = _code_counts(
        reference,
        short("product_class_type").alias("empty_product_descriptions"),
        short("origin_code").alias("empty_origin_descriptions"),
        dates.age_days(newest("product_class_type"), now).alias("product_age_days"),
        dates.age_days(newest("origin_code"), now).alias("origin_age_days"),
    ).withColumns({
        "product_empty_percentage": percent(F.col("empty_product_descriptions"), F.col("product_codes_count")),
        "origin_empty_percentage": percent(F.col("empty_origin_descriptions"), F.col("origin_codes_count")),
    })
    issues = _count_issues(limits)
    for label, count in (("Product class", "product_codes_count"), ("Origin code", "origin_codes_count")):
        issues.append(issue(F.col(count) == 0, f"{label} extraction errors detected"))
    for label in ("product", "origin"):
        share = F.col(f"{label}_empty_percentage")
        issues.append(issue(share > limits.short_descriptions, f"High percentage of empty {label} descriptions: ",
                            one_decimal(share), "%"))
    for label in ("product", "origin"):
        age = F.col(f"{label}_age_days")
        issues.append(issue(age > limits.max_age_days, f"{label.capitalize()} codes data is ", age, " days old"))
    return verdict(
        measured,
        "reference_data_coverage",
        "total_reference_records",
        issues,
        F.concat(F.lit("Reference data: "), F.col("product_codes_count").cast("string"), F.lit(" product codes, "),
                 F.col("origin_codes_count").cast("string"), F.lit(" origin codes")),
        "No reference data found",
    )


def fact_integrity(facts: DataFrame, limits: Thresholds = LIMITS) -> DataFrame:
    n = F.count("*")
    measured = facts.agg(
        n.alias("total_records"),
        F.count_if(F.col("company_id").isNull()).alias("missing_company_keys"),
        F.count_if(F.col("product_id").isNull()).alias("missing_product_keys"),
        percent(F.count("company_id"), n).alias("company_key_integrity_percent"),
        percent(F.count("product_id"), n).alias("product_key_integrity_percent"),
        F.avg(F.col("final_quality_score").cast("double")).alias("average_quality_score"),
        F.count_if(F.col("filing_date").isNotNull() & F.col("approval_date").isNotNull()).alias("records_with_dates"),
        percent(
            F.count_if(F.col("filing_date").isNotNull() & F.col("approval_date").isNotNull()), n
        ).alias("date_completeness_percent"),
        F.count_if("has_detail_data").alias("has_detail_count"),
        F.count_if("has_certificate_data").alias("has_certificate_count"),
        percent(F.count_if(classify.is_approved(F.col("status"))), n).alias("approval_rate"),
    )
    company, product = F.col("company_key_integrity_percent"), F.col("product_key_integrity_percent")
    quality, dated = F.coalesce("average_quality_score", F.lit(0.0)), F.col("date_completeness_percent")
    return verdict(
        measured,
        "fact_table_integrity",
        "total_records",
        [
            issue(company < limits.foreign_keys, "Low company foreign key integrity: ", one_decimal(company), "%"),
            issue(product < limits.foreign_keys, "Low product foreign key integrity: ", one_decimal(product), "%"),
            issue(quality < limits.quality, "Low average quality score: ", two_decimals(quality)),
            issue(dated < limits.fact_dates, "Low date completeness: ", one_decimal(dated), "%"),
        ],
        F.concat(F.lit("Fact table integrity: "), F.col("total_records").cast("string"), F.lit(" records, FK integrity "),
                 one_decimal(F.least(company, product)), F.lit("%, avg quality "), two_decimals(quality)),
        "No fact table records found",
        empty_severity="ERROR",
    )


def dimension_quality(companies: DataFrame, limits: Thresholds = LIMITS) -> DataFrame:
    n, score = F.count("*"), F.col("data_quality_score").cast("double")
    measured = companies.agg(
        n.alias("total_companies"),
        F.avg(score).alias("average_quality_score"),
        F.count_if(score < limits.low_quality_score).alias("low_quality_companies"),
        percent(F.count_if(score < limits.low_quality_score), n).alias("low_quality_percentage"),
        *stats.completeness({
            "phone_percent": F.col("phone"),
            "email_percent": F.col("email"),
            "address_percent": F.col("mailing_address"),
        }),
        stats.duplicate_names(companies).alias("potential_duplicates"),
        F.coalesce(F.sum("total_applications"), F.lit(0)).alias("total_applications"),
    ).withColumn("avg_applications_per_company", stats.ratio(F.col("total_applications"), F.col("total_companies")))
    quality, low = F.coalesce("average_quality_score", F.lit(0.0)), F.col("low_quality_percentage")
    return verdict(
        measured,
        "dimensional_data_quality",
        "total_companies",
        [
            issue(quality < limits.quality, "Low average quality score: ", two_decimals(quality)),
            issue(low > limits.low_quality, "High percentage of low-quality companies: ", one_decimal(low), "%"),
            issue(F.col("address_percent") < limits.addresses, "Low address completeness: ",
                  one_decimal(F.col("address_percent")), "%"),
            issue(F.col("potential_duplicates") > 0, "Potential duplicate companies detected: ",
                  F.col("potential_duplicates")),
        ],
        F.concat(F.lit("Company dimension: "), F.col("total_companies").cast("string"),
                 F.lit(" unique companies, avg quality "), two_decimals(quality), F.lit(", "),
                 one_decimal(F.col("avg_applications_per_company")), F.lit(" avg applications")),
        "No company dimension records found",
    )


def top_companies(companies: DataFrame, k: int = 5) -> DataFrame:
    return top_k(companies.select("business_name", "total_applications"), "total_applications", "business_name", k)


def certificate_compliance(facts: DataFrame, limits: Thresholds = LIMITS) -> DataFrame:
    n = F.count("*")
    dated = F.col("application_date").isNotNull() & F.col("approval_date").isNotNull()
    measured = facts.agg(
        n.alias("total_certificates"),
        F.count_if("is_approved").alias("approved_certificates"),
        percent(F.count_if("is_approved"), n).alias("approval_rate_percent"),
        F.avg(F.col("final_quality_score").cast("double")).alias("average_quality_score"),
        percent(F.count_if(filled(F.col("serial_number"))), n).alias("serial_number_percent"),
        percent(F.count_if(filled(F.col("plant_registry_number"))), n).alias("plant_registry_percent"),
        percent(F.count_if(dated), n).alias("dates_percent"),
    )
    quality = F.coalesce("average_quality_score", F.lit(0.0))
    low = lambda name, label, limit: issue(
        F.col(name) < limit, f"Low {label}: ", one_decimal(F.col(name)), "%"
    )
    return verdict(
        measured,
        "certificate_compliance_monitoring",
        "total_certificates",
        [
            low("approval_rate_percent", "approval rate", limits.approval),
            issue(quality < limits.quality, "Low average quality score: ", two_decimals(quality)),
            low("serial_number_percent", "serial number completeness", limits.certificate_fields),
            low("plant_registry_percent", "plant registry completeness", limits.certificate_fields),
            low("dates_percent", "date completeness", limits.certificate_fields),
        ],
        F.concat(F.lit("Certificate compliance: "), one_decimal(F.col("approval_rate_percent")),
                 F.lit("% approval rate"), F.lit(", avg quality "), two_decimals(quality)),
        "No certificate records found",
    )


def certificate_types(facts: DataFrame) -> DataFrame:
    return stats.histogram(
        facts.withColumn("certificate_type", F.coalesce("certificate_type", F.lit("Unknown"))), "certificate_type"
    )


def most_common_type(facts: DataFrame) -> DataFrame:
    return stats.mode(
        facts.withColumn("certificate_type", F.coalesce("certificate_type", F.lit("Unknown"))), "certificate_type"
    )


def failed(results: DataFrame) -> DataFrame:
    return results.where(~F.col("passed"))
