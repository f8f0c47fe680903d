"""Fact tables and the star read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.functions import classify, dates, ids, score
from cartouche.functions.text import none_if_empty, text
from cartouche.operators import dims
from cartouche.operators.lookup import foreign_key

LINEAGE_STAMPS = ["extraction_timestamp", "cleaning_timestamp", "structuring_timestamp"]


def _blank(frame: DataFrame, name: str) -> Column:
    return F.coalesce(text(F.col(name)), F.lit("")) if name in frame.columns else F.lit("")


def _value(frame: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in frame.columns else F.lit(None).cast(kind)


def _stamps(frame: DataFrame) -> list[Column]:
    return [F.col(c).alias(f"source_{c}") for c in LINEAGE_STAMPS if c in frame.columns]


def product_facts(structured: DataFrame, companies: DataFrame, products: DataFrame) -> DataFrame:
    """One row per filing with a detail view; unmatched dimension keys stay null."""
    rows = structured.where(F.col("has_detail"))
    keyed = foreign_key(rows, dims.company_key(), companies, "company_key", "company_id")
    keyed = foreign_key(keyed, dims.product_key(), products, "product_key", "product_id")
    day = lambda c: _value(rows, c, "date")
    return keyed.select(
        ids.fact_id("product", F.col("filing_id")).alias("product_fact_id"),
        "filing_id",
        "company_key",
        "company_id",
        "product_key",
        "product_id",
        dates.date_id(day("filing_date")).alias("filing_date_id"),
        dates.date_id(day("approval_date")).alias("approval_date_id"),
        dates.date_id(day("expiration_date")).alias("expiration_date_id"),
        F.coalesce("final_quality_score", F.lit(0.0)).cast("decimal(5,3)").alias("final_quality_score"),
        F.coalesce("data_completeness_score", F.lit(0.0)).cast("decimal(5,3)").alias("data_completeness_score"),
        F.col("days_to_approval").cast("int").alias("days_to_approval"),
        F.col("has_certificate").alias("has_certificate_data"),
        F.col("has_detail").alias("has_detail_data"),
        _blank(rows, "class_type_code").alias("class_type_code"),
        _blank(rows, "origin_code").alias("origin_code"),
        F.coalesce("product_category", F.lit("OTHER")).alias("product_category"),
        _blank(rows, "status").alias("status"),
        _value(rows, "serial_number", "string").alias("serial_number"),
        _value(rows, "vendor_code", "string").alias("vendor_code"),
        day("filing_date").alias("filing_date"),
        day("approval_date").alias("approval_date"),
        day("expiration_date").alias("expiration_date"),
        F.col("partition_date").cast("date").alias("partition_date"),
        *_stamps(rows),
    )


def certificate_facts(structured: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per filing with a certificate.

    ``cert_status`` exists only for paired filings, so a lone certificate falls back
    to its plain ``status``; the serial number falls back the same way.
    """
    rows = structured.where(F.col("has_certificate"))
    keyed = foreign_key(rows, dims.company_key(), companies, "company_key", "company_id")
    status = F.coalesce(none_if_empty(_value(rows, "cert_status", "string")),
                        F.when(~F.col("has_detail"), _value(rows, "status", "string")), F.lit(""))
    serial = F.coalesce(_value(rows, "cert_serial_number", "string"),
                        F.when(~F.col("has_detail"), _value(rows, "serial_number", "string")))
    return keyed.select(
        ids.fact_id("certificate", F.col("filing_id")).alias("certificate_fact_id"),
        "filing_id",
        "company_key",
        "company_id",
        dates.date_id(F.col("cert_application_date")).alias("application_date_id"),
        dates.date_id(F.col("cert_approval_date")).alias("approval_date_id"),
        F.coalesce("final_quality_score", F.lit(0.0)).cast("decimal(5,3)").alias("final_quality_score"),
        F.coalesce("data_completeness_score", F.lit(0.0)).cast("decimal(5,3)").alias("data_completeness_score"),
        classify.is_approved(status).alias("is_approved"),
        F.col("has_detail").alias("has_detail_data"),
        status.alias("certificate_status"),
        _blank(rows, "cert_certificate_type").alias("certificate_type"),
        serial.alias("serial_number"),
        _blank(rows, "cert_plant_registry_number").alias("plant_registry_number"),
        F.col("cert_application_date").alias("application_date"),
        F.col("cert_approval_date").alias("approval_date"),
        F.col("partition_date").cast("date").alias("partition_date"),
        *_stamps(rows),
    )


def legacy_product_facts(flat: DataFrame) -> DataFrame:
    """Older product facts: every key is a hash of the row itself, nothing is joined."""
    rows = flat.where(F.col("has_detail"))
    company = ids.legacy_company_id(F.col("applicant_business_name"), F.col("applicant_mailing_address"))
    return rows.select(
        ids.legacy_fact_id(F.col("filing_id"), "product").alias("product_id"),
        "filing_id",
        company.alias("company_id"),
        ids.short_key(F.col("cola_origin_code")).alias("location_id"),
        ids.short_key(F.col("cola_product_class_type")).alias("product_type_id"),
        *[dates.date_id(F.col(f"cola_{c}_date")).alias(f"{c}_date_id") for c in ("filing", "approval", "expiration")],
        *[F.col(f"cola_{c}").alias(c) for c in (
            "brand_name", "fanciful_name", "product_description", "net_contents", "alcohol_content",
            "formula_number", "serial_number", "label_images_count",
        )],
        dates.days_between(F.col("cola_filing_date"), F.col("cola_approval_date")).alias("days_to_approval"),
        score.legacy_quality().alias("data_quality_score"),
    )


def legacy_certificate_facts(flat: DataFrame) -> DataFrame:
    rows = flat.where(F.col("has_certificate"))
    company = ids.legacy_company_id(F.col("applicant_business_name"), F.col("applicant_mailing_address"))
    return rows.select(
        ids.legacy_fact_id(F.col("filing_id"), "certificate").alias("certificate_id"),
        "filing_id",
        company.alias("company_id"),
        *[dates.date_id(F.col(f"cert_{c}_date")).alias(f"{c}_date_id") for c in ("application", "approval")],
        *[F.col(f"cert_{c}").alias(c) for c in (
            "certificate_number", "certificate_status", "certificate_type", "plant_registry_number",
            "applicant_signature_present", "authorized_signature_present", "authorized_signature_url",
        )],
        dates.days_between(F.col("cert_application_date"), F.col("cert_approval_date")).alias("days_to_approval"),
    )


def star(facts: DataFrame, companies: DataFrame, products: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """Facts with their company, product and filing-date attributes, joined on the full keys (one dimension row each)."""
    company = companies.select("company_key", "business_name")
    product = products.select("product_key", "brand_name")
    days = dim_dates.select(F.col("date_id").alias("filing_date_id"), "year", "quarter", "season")
    return (
        facts.join(company, "company_key", "left")
        .join(product, "product_key", "left")
        .join(F.broadcast(days), "filing_date_id", "left")
    )
