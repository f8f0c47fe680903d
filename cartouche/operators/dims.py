"""Dimensions: companies, products, dates, and the older company/location/type forms.

Grouping is by the full normalised key. "First" means first by an explicit total
order, taken with ``min_by`` so that map tasks combine before the shuffle and a
company with a third of all filings still arrives as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.functions import classify, ids, score
from cartouche.functions.dates import calendar_columns
from cartouche.functions.text import filled

FIRST_SEEN_ORDER = ["partition_date", "filing_id"]


def _first(columns: list[Column], order: list[str]) -> Column:
    return F.min_by(F.struct(*columns), F.struct(*order))


def _first_filled(c: Column, order: list[str]) -> Column:
    """First non-empty value in order, '' when there is none."""
    return F.coalesce(F.min_by(c, F.when(filled(c), F.struct(*order))), F.lit(""))


def _or_blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def company_key() -> Column:
    """Null without a company name, so such filings skip the lookup."""
    name = F.col("applicant_business_name")
    return F.when(filled(name), ids.surrogate_key(name, F.col("applicant_mailing_address")))


def product_key() -> Column:
    return ids.surrogate_key(F.col("brand_name"), F.col("fanciful_name"))


def companies(structured: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per company; phone and e-mail are back-filled, the rest comes from the first filing."""
    order = order or FIRST_SEEN_ORDER
    named = structured.where(filled(F.col("applicant_business_name")))
    name, address = F.col("applicant_business_name"), F.col("applicant_mailing_address")
    quality = score.company_quality(name, address, F.col("applicant_phone"), F.col("applicant_email"))
    first = _first(
        [
            name.alias("business_name"),
            F.coalesce(address, F.lit("")).alias("mailing_address"),
            F.coalesce(F.col("applicant_fax"), F.lit("")).alias("fax"),
            quality.alias("score"),
        ],
        order,
    )
    return (
        named.withColumn("company_key", company_key())
        .groupBy("company_key")
        .agg(
            first.alias("first"),
            _first_filled(F.col("applicant_phone"), order).alias("phone"),
            _first_filled(F.col("applicant_email"), order).alias("email"),
            F.min("partition_date").alias("first_seen_date"),
            F.max("partition_date").alias("last_seen_date"),
            F.count("*").alias("total_applications"),
        )
        .select(
            "company_key",
            ids.surrogate_id(F.col("first.business_name"), F.col("first.mailing_address")).alias("company_id"),
            "first.business_name",
            "first.mailing_address",
            "phone",
            "email",
            "first.fax",
            "first_seen_date",
            "last_seen_date",
            "total_applications",
            F.col("first.score").cast("decimal(5,3)").alias("data_quality_score"),
        )
    )


def products(structured: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per (brand, fanciful name) of filings with a detail view."""
    order = order or FIRST_SEEN_ORDER
    rows = structured.where(F.col("has_detail") & filled(F.col("brand_name")))
    quality = score.product_quality(
        *[F.col(c) for c in (
            "brand_name", "class_type_code", "origin_code", "product_description", "alcohol_content", "net_contents"
        )]
    )
    appellation = F.col("cert_wine_appellation") if "cert_wine_appellation" in rows.columns else F.lit("")
    varietals = F.col("grape_varietals") if "grape_varietals" in rows.columns else F.lit("")
    first = _first(
        [
            F.col("brand_name"),
            _or_blank("fanciful_name"),
            _or_blank("product_description"),
            _or_blank("class_type_code"),
            _or_blank("origin_code"),
            F.coalesce(F.col("product_category"), F.lit("OTHER")).alias("product_category"),
            F.coalesce(varietals, F.lit("")).alias("grape_varietals"),
            F.coalesce(appellation, F.lit("")).alias("wine_appellation"),
            F.col("alcohol_content").try_cast("decimal(5,2)").alias("alcohol_content"),
            _or_blank("net_contents"),
            quality.alias("score"),
        ],
        order,
    )
    return (
        rows.withColumn("product_key", product_key())
        .groupBy("product_key")
        .agg(
            first.alias("first"),
            F.min("partition_date").alias("first_seen_date"),
            F.max("partition_date").alias("last_seen_date"),
            F.count("*").alias("total_labels"),
        )
        .select(
            "product_key",
            ids.surrogate_id(F.col("first.brand_name"), F.col("first.fanciful_name")).alias("product_id"),
            *[f"first.{c}" for c in (
                "brand_name", "fanciful_name", "product_description", "class_type_code", "origin_code",
                "product_category", "grape_varietals", "wine_appellation", "alcohol_content", "net_contents",
            )],
            "first_seen_date",
            "last_seen_date",
            "total_labels",
            F.col("first.score").cast("decimal(5,3)").alias("data_quality_score"),
        )
    )


def source_ids(rows: DataFrame, owner: Column) -> DataFrame:
    """Bridge table of owners and their filings, one row per pair: ``owner_key, filing_id``."""
    return rows.select(owner.alias("owner_key"), "filing_id").where(F.col("owner_key").isNotNull()).distinct()


def id_collisions(dimension: DataFrame, id_column: str, key_column: str) -> DataFrame:
    """32-bit ids shared by several full keys."""
    return dimension.groupBy(id_column).agg(F.count_distinct(key_column).alias("keys")).where(F.col("keys") > 1)


def date_dimension(days: DataFrame, column: str = "date") -> DataFrame:
    return days.select(*calendar_columns(F.col(column)))


# --- older forms ---------------------------------------------------------------


def legacy_companies(flat: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Raw-key company dimension: first non-null per column, earliest stamp."""
    order = order or FIRST_SEEN_ORDER
    name, address = F.col("applicant_business_name"), F.col("applicant_mailing_address")
    rows = flat.where(name.isNotNull()).withColumn("company_hash", ids.legacy_company_hash(name, address))

    def first(c: str) -> Column:
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order)))

    return (
        rows.groupBy("company_hash")
        .agg(
            first("applicant_business_name").alias("company_name"),
            first("applicant_mailing_address").alias("mailing_address"),
            first("applicant_phone").alias("phone"),
            first("applicant_email").alias("email"),
            first("applicant_fax").alias("fax"),
            first("cert_plant_registry_number").alias("plant_registry_number"),
            F.min("processing_timestamp").alias("created_date"),
            F.count("*").alias("filings"),
        )
        .withColumns({
            "company_id": ids.legacy_company_id(F.col("company_name"), F.col("mailing_address")),
            "modified_date": F.col("created_date"),
            "is_current": F.lit(True),
        })
    )


def legacy_locations(flat: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per origin code; attributes from the first description seen."""
    order = order or FIRST_SEEN_ORDER
    rows = flat.where(F.col("cola_origin_code").isNotNull())
    grouped = rows.groupBy(F.col("cola_origin_code").alias("origin_code")).agg(
        F.min_by(F.struct(F.col("origin_code_validation_description").alias("text")), F.struct(*order)).alias("first")
    )
    described = grouped.select(
        ids.short_key(F.col("origin_code")).alias("location_id"),
        "origin_code",
        F.col("first.text").alias("origin_description"),
    )
    return described.withColumns(classify.origin_columns(F.col("origin_description")))


def legacy_product_types(flat: DataFrame, order: list[str] | None = None) -> DataFrame:
    order = order or FIRST_SEEN_ORDER
    rows = flat.where(F.col("cola_product_class_type").isNotNull())
    grouped = rows.groupBy(F.col("cola_product_class_type").alias("product_class_code")).agg(
        F.min_by(F.struct(F.col("product_class_validation_description").alias("text")), F.struct(*order)).alias("first")
    )
    pair = classify.category_pair(F.col("first.text"))
    return grouped.select(
        ids.short_key(F.col("product_class_code")).alias("product_type_id"),
        "product_class_code",
        F.col("first.text").alias("product_class_description"),
        pair["category"].alias("category"),
        pair["subcategory"].alias("subcategory"),
        F.lit(True).alias("is_alcoholic"),
    )
