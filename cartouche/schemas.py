"""Registered table schemas (``StructType`` by name)."""

from __future__ import annotations

from pyspark.sql import types as T


class SchemaRegistry:
    def __init__(self) -> None:
        self._schemas: dict[str, T.StructType | str] = {}

    def register(self, name: str, schema: T.StructType | str) -> None:
        """A schema or its DDL text; text is parsed on first use, when a session is there."""
        self._schemas[name] = schema

    def get(self, name: str) -> T.StructType:
        if name not in self._schemas:
            raise KeyError(f"Unknown schema: {name}")
        schema = self._schemas[name]
        if isinstance(schema, str):
            schema = self._schemas[name] = T.StructType.fromDDL(schema)
        return schema

    def available(self) -> list[str]:
        return sorted(self._schemas)


schemas = SchemaRegistry()

_LINEAGE = """
    partition_date STRING, receipt_method BIGINT, view STRING, source_file STRING, source_file_size BIGINT,
    extraction_timestamp TIMESTAMP, transformation_applied BOOLEAN, transformation_timestamp TIMESTAMP,
    field_count BIGINT, parsing_success BOOLEAN
"""

schemas.register("landed_page", """
    filing_id STRING, sequence INT, html STRING, partition_date DATE, receipt_method INT, view STRING,
    fetched_at TIMESTAMP, url STRING, size_bytes BIGINT, status_code INT
""")

schemas.register("cola-detail", f"""
    filing_id STRING, filing_id_valid BOOLEAN, serial_number STRING, sequence_number BIGINT,
    filing_date DATE, approval_date DATE, expiration_date DATE,
    applicant_business_name STRING, applicant_mailing_address STRING, applicant_phone STRING,
    applicant_email STRING, applicant_fax STRING,
    brand_name STRING, fanciful_name STRING, formula_id STRING, product_description STRING, beverage_type STRING,
    wine_appellation STRING, wine_vintage STRING, wine_variety_blend STRING, wine_alcohol_content DOUBLE,
    wine_pH DOUBLE, net_contents STRING, container_type STRING,
    alcohol_content DOUBLE, alcohol_content_unit STRING,
    government_warning STRING, sulfite_declaration STRING, health_claim_statement STRING,
    label_images_count BIGINT, label_images_metadata STRING, {_LINEAGE}
""")

schemas.register("certificate", f"""
    filing_id STRING, filing_id_valid BOOLEAN, certificate_number STRING, effective_date DATE, expiration_date DATE,
    trade_name STRING, dba_name STRING, registry_id STRING,
    premises_address STRING, premises_city STRING, premises_state STRING, premises_zip STRING,
    mailing_address STRING, mailing_city STRING, mailing_state STRING, mailing_zip STRING,
    phone STRING, email STRING, fax STRING,
    permit_type STRING, permit_class STRING, basic_permit_number STRING, {_LINEAGE}
""")

schemas.register("consolidated", """
    filing_id STRING, partition_date DATE, receipt_method INT,
    has_detail BOOLEAN, has_certificate BOOLEAN, data_completeness_score FLOAT,
    cola_serial_number STRING, cola_filing_date DATE, cola_approval_date DATE, cola_expiration_date DATE,
    cola_brand_name STRING, cola_fanciful_name STRING, cola_product_description STRING, cola_net_contents STRING,
    cola_alcohol_content STRING, cola_product_class_type STRING, cola_origin_code STRING, cola_formula_number STRING,
    cola_label_images_count INT, cola_qualifications STRING,
    cert_certificate_number STRING, cert_application_date DATE, cert_approval_date DATE,
    cert_certificate_status STRING, cert_certificate_type STRING, cert_applicant_signature_present BOOLEAN,
    cert_authorized_signature_present BOOLEAN, cert_authorized_signature_url STRING, cert_plant_registry_number STRING,
    applicant_business_name STRING, applicant_mailing_address STRING, applicant_phone STRING, applicant_email STRING,
    applicant_fax STRING,
    filing_id_valid BOOLEAN, product_class_validation_is_valid BOOLEAN, product_class_validation_code STRING,
    product_class_validation_description STRING, origin_code_validation_is_valid BOOLEAN,
    origin_code_validation_code STRING, origin_code_validation_description STRING,
    cola_source_file STRING, cert_source_file STRING, processing_timestamp TIMESTAMP, extraction_success_rate FLOAT,
    validation_errors_count INT,
    days_to_approval INT, is_wine BOOLEAN, is_beer BOOLEAN, is_spirits BOOLEAN, has_complete_applicant_info BOOLEAN,
    data_quality_tier STRING
""")

schemas.register("reference_code", "code STRING, description STRING, kind STRING, extracted_at TIMESTAMP")

schemas.register("dim_dates", """
    date_id INT, date DATE, year INT, quarter INT, month INT, day INT, day_of_week INT, day_of_year INT,
    week_of_year INT, fiscal_year INT, fiscal_quarter INT, is_weekend BOOLEAN, is_holiday BOOLEAN, month_name STRING,
    day_name STRING, quarter_name STRING, season STRING, days_from_epoch INT
""")

schemas.register("dim_companies", """
    company_key STRING, company_id BIGINT, business_name STRING, mailing_address STRING, phone STRING, email STRING, fax STRING,
    first_seen_date DATE, last_seen_date DATE, total_applications BIGINT, data_quality_score DECIMAL(5,3),
    partition_date DATE
""")

schemas.register("dim_products", """
    product_key STRING, product_id BIGINT, brand_name STRING, fanciful_name STRING, product_description STRING, class_type_code STRING,
    origin_code STRING, product_category STRING, grape_varietals STRING, wine_appellation STRING,
    alcohol_content DECIMAL(5,2), net_contents STRING, first_seen_date DATE, last_seen_date DATE, total_labels BIGINT,
    data_quality_score DECIMAL(5,3), partition_date DATE
""")

schemas.register("certificate_images", "filing_id STRING, image_urls ARRAY<STRING>, partition_date DATE")

schemas.register("source_ids", "owner_key STRING, filing_id STRING")

schemas.register("fact_products", """
    product_fact_id BIGINT, filing_id STRING, company_key STRING, company_id BIGINT, product_key STRING,
    product_id BIGINT, filing_date_id INT, approval_date_id INT, expiration_date_id INT, final_quality_score DECIMAL(5,3),
    data_completeness_score DECIMAL(5,3), days_to_approval INT, has_certificate_data BOOLEAN,
    has_detail_data BOOLEAN, class_type_code STRING, origin_code STRING, product_category STRING, status STRING,
    serial_number STRING, vendor_code STRING, filing_date DATE, approval_date DATE, expiration_date DATE,
    partition_date DATE
""")

schemas.register("fact_certificates", """
    certificate_fact_id BIGINT, filing_id STRING, company_key STRING, company_id BIGINT, application_date_id INT, approval_date_id INT,
    final_quality_score DECIMAL(5,3), data_completeness_score DECIMAL(5,3), is_approved BOOLEAN,
    has_detail_data BOOLEAN, certificate_status STRING, certificate_type STRING, serial_number STRING,
    plant_registry_number STRING, application_date DATE, approval_date DATE, partition_date DATE
""")

schemas.register("dim_locations", """
    location_id BIGINT, origin_code STRING, origin_description STRING, state STRING, country STRING, region STRING,
    is_domestic BOOLEAN
""")

schemas.register("dim_product_types", """
    product_type_id BIGINT, product_class_code STRING, product_class_description STRING, category STRING,
    subcategory STRING, is_alcoholic BOOLEAN
""")
