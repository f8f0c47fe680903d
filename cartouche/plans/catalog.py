"""Runnable queries over the test tables, one per operator group.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole tables.
Results use plain types, so they compare with any other engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.constants import CERTIFICATE, CHECKBOXES, DETAIL
from cartouche.functions import classify, dates, ids, numbers, score, text
from cartouche.operators import (
    checks, clean, dims, extract, facts, images, lookup, merge, ordered, stats, structure, upsert,
)
from cartouche.plans.filings import Filings, from_pages, write_outcomes
from cartouche.registry import registry, rules_for, legacy_classification
from cartouche.schemas import schemas
from cartouche.sources import files, grids, published, scratch, tables
from cartouche.sources.tables import filing_id, table
from cartouche.streaming import ingest, monitor

PUBLISHED_BUCKETS = 8
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def modelled(fn: Callable[[Filings], DataFrame]) -> Query:
    """A query over dimensions and facts together: the structured table is written once and read by each."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(plan_of(spark, sf_dir).stored)

    QUERIES[fn.__name__] = run
    return run


def rounded(c: Column | str, places: int = 6) -> Column:
    return F.round(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), places)


@lru_cache(maxsize=4)
def plan_of(spark: SparkSession, sf_dir: str) -> Filings:
    """The lazy plan is built once per session and folder; it holds no data."""
    return Filings(spark, sf_dir)


def filings(fn: Callable[[Filings], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(plan_of(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


# --- merge and structure ---------------------------------------------------------


@filings
def merged_filings(f: Filings) -> DataFrame:
    return f.merged.select(
        "filing_id", "has_detail", "has_certificate", "status", "brand_name", "product_description",
        "applicant_business_name", "applicant_mailing_address", "applicant_phone", "applicant_email",
        "filing_date", "approval_date", "expiration_date", "net_contents",
        F.col("alcohol_content").cast("double").alias("alcohol_content"),
        "cert_status", "cert_certificate_type", "cert_application_date", "cert_approval_date",
        "cert_plant_registry_number", "cert_wine_appellation", "partition_date",
        rounded("data_completeness_score").alias("data_completeness_score"), "days_to_approval", "product_category",
    )


@filings
def filings_by_source(f: Filings) -> DataFrame:
    return f.merged.groupBy("has_detail", "has_certificate").agg(
        F.count("*").alias("filings"),
        rounded(F.avg("data_completeness_score")).alias("mean_completeness"),
        rounded(F.avg("days_to_approval")).alias("mean_days"),
    )


@filings
def merged_legacy(f: Filings) -> DataFrame:
    return f.flat.select(
        "filing_id", "has_detail", "has_certificate", "applicant_business_name", "applicant_phone", "cola_brand_name",
        "cola_filing_date", "cola_approval_date", "cola_origin_code", "cert_certificate_number",
        "cert_certificate_status", "cert_plant_registry_number", "cert_applicant_signature_present",
        rounded("data_completeness_score").alias("data_completeness_score"), "days_to_approval",
        "is_wine", "is_beer", "is_spirits", "has_complete_applicant_info",
    )


@filings
def quality_tiers(f: Filings) -> DataFrame:
    return f.flat.groupBy("data_quality_tier").agg(
        F.count("*").alias("filings"), rounded(F.avg(score.legacy_quality())).alias("mean_record_score")
    )


@filings
def consolidated_schema(f: Filings) -> DataFrame:
    """K2: filled to the flat schema; absent flags false, absent columns null."""
    filled = structure.fill_to_schema(f.flat.drop("is_wine"), schemas.get("consolidated"))
    return filled.select(
        "filing_id", "is_wine", "is_beer", "cola_formula_number", "validation_errors_count", "data_quality_tier",
        F.lit(len(filled.columns)).cast("bigint").alias("columns"),
    )


@filings
def structured(f: Filings) -> DataFrame:
    v = F.col("schema_validation")
    return f.structured.select(
        "filing_id", "filing_date", "cert_approval_date", "has_detail", "cert_applicant_signature_present", "brand_name",
        "cert_certificate_type", rounded("days_to_approval").alias("days_to_approval"),
        rounded("final_quality_score").alias("final_quality_score"),
        v["is_valid"].alias("is_valid"), F.array_join(v["errors"], "; ").alias("errors"),
        F.array_join(v["warnings"], "; ").alias("warnings"),
    )


@filings
def cross_view_consistency(f: Filings) -> DataFrame:
    """Ids and names of both views; certificates of one receipt method were filed under another id."""
    pair = f.merged.where(F.col("has_detail") & F.col("has_certificate"))
    moved = F.concat(F.lit("9"), F.substring("filing_id", 2, 13))
    pair = pair.withColumn("cert_filing_id", F.when(F.substring("filing_id", 6, 3) == "002", moved).otherwise(F.col("filing_id")))
    compared = merge.cross_view_consistency(
        pair, ("filing_id", "cert_filing_id"), ("applicant_business_name", "cert_applicant_business_name")
    )
    c = F.col("consistency")
    return compared.select(
        "filing_id", c["is_consistent"].alias("is_consistent"), F.array_join(c["issues"], "; ").alias("issues"),
        F.array_join(c["checked_fields"], ",").alias("checked_fields"),
    )


# --- dedup, union ----------------------------------------------------------------


def _line_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as repeated landings of their order's filing."""
    return table(spark, sf_dir, "lineitem").select(
        filing_id(F.col("l_orderkey")).alias("filing_id"),
        F.when(F.col("l_linestatus") == "F", DETAIL).otherwise(CERTIFICATE).alias("view"),
        (F.col("l_suppkey") % 4).cast("int").alias("receipt_method"),
        F.col("l_linenumber").alias("sequence"),
        "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price"),
    )


TIES = ["l_partkey", "l_suppkey", "price"]


@query
def latest_per_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("sequence").desc(), *[F.col(c).desc() for c in TIES]]
    return ordered.latest_per_view(_line_filings(spark, sf_dir), order)


@query
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.dedup_keep_first(_line_filings(spark, sf_dir), tie_breakers=[F.col(c) for c in TIES])


@query
def distinct_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-first over exact copies of a text, by content hash."""
    docs = table(spark, sf_dir, "documents").withColumn("content_hash", ids.content_hash(F.col("text")))
    return ordered.pick_first(docs, ["content_hash"], [F.col("doc_id")]).select("content_hash", "doc_id", "lang")


@query
def union_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both views in one table: rows and kept ids."""
    detail = clean.fetched_ok(tables.detail_raw(spark, sf_dir)).select("filing_id", "view", "sequence", "receipt_method", "status")
    certificate = tables.certificate_raw(spark, sf_dir).select(
        "filing_id", "view", "sequence", "receipt_method", "certificate_type"
    )
    landed = files.union_all(detail, certificate)
    return stats.consolidation_ratio(landed).select("landed", "kept", rounded("ratio").alias("ratio"))


# --- ids, grids, dates -----------------------------------------------------------


@query
def filing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    sequence = tables.id_parts(F.col("o_orderkey"))["sequence"]
    fid = ids.build_filing_id(F.year(day), F.dayofyear(day), F.col("o_orderkey") % 4, sequence)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fid.alias("filing_id"), ids.partition_key(fid).alias("partition_key"),
        ids.build_long_id(F.year(day), F.dayofyear(day), F.col("o_orderkey") % 4, sequence).alias("long_id"),
        dates.from_day_of_year(F.year(day), F.dayofyear(day)).alias("day_again"),
        ids.receipt_method_name(F.col("o_orderkey") % 4).alias("method_name"),
    )


@query
def filing_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed ids and ids broken in every way, by line."""
    fid = filing_id(F.col("l_orderkey"))
    bent = (
        F.when(F.col("l_returnflag") == "A", fid)
        .when(F.col("l_linestatus") == "O", F.concat(F.substring(fid, 1, 5), F.lit("009"), F.substring(fid, 9, 6)))
        .when(F.col("l_quantity") > 40, F.concat(F.lit("31367"), F.substring(fid, 6, 9)))
        .when(F.col("l_quantity") > 20, F.concat(F.lit("x"), fid))
        .otherwise(F.concat(F.substring(fid, 1, 8), F.lit("000000")))
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", bent.alias("raw_id"))
    raw, p, long = F.col("raw_id"), F.col("p"), F.col("long")
    parsed = rows.withColumns({"p": ids.parse_filing_id(raw), "long": ids.parse_long_id(F.concat(F.lit("202"), raw))})
    return parsed.select(
        "l_orderkey", "l_linenumber", "raw_id", p["year"].alias("year"), p["julian_day"].alias("julian_day"),
        p["receipt_method"].alias("receipt_method"), p["sequence"].alias("sequence"), p["error"].alias("error"),
        ids.is_filing_id(raw).alias("is_id"), long["year"].alias("long_year"), long["sequence"].alias("long_sequence"),
    )


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count("*").alias("orders")
    )


@query
def candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many candidate ids per day and method as the day had orders."""
    days = _order_days(spark, sf_dir)
    return grids.candidate_ids(days.select("date", "orders"), end=F.col("orders")).drop("date")


@query
def work_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.work_grid(_order_days(spark, sf_dir), "001, 002,003 ,000", "cola-detail, certificate")


@query
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days between first and last event, backward, with events per day."""
    day = F.col("ts").cast("date")
    events = table(spark, sf_dir, "events")
    bounds = events.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    spine = grids.date_spine(bounds, "a", "b", backward=True)
    seen = events.groupBy(day.alias("date")).agg(F.count("*").alias("events"))
    return spine.join(seen, "date", "left").select("date", F.coalesce("events", F.lit(0)).alias("events"))


@filings
def date_dim(f: Filings) -> DataFrame:
    return f.dates


# --- dimensions and facts --------------------------------------------------------


@filings
def company_dim(f: Filings) -> DataFrame:
    return f.companies


@filings
def company_source_ids(f: Filings) -> DataFrame:
    return dims.source_ids(f.structured, dims.company_key())


@filings
def product_dim(f: Filings) -> DataFrame:
    return f.products


@filings
def product_categories(f: Filings) -> DataFrame:
    return stats.category_counts(f.products)


@modelled
def id_collisions(f: Filings) -> DataFrame:
    """32-bit ids that several full keys share, per table; nothing is joined or merged on these ids."""
    audits = {
        "companies": (f.companies, "company_id", "company_key"), "products": (f.products, "product_id", "product_key"),
        "product_facts": (f.product_facts, "product_fact_id", "filing_id"),
        "certificate_facts": (f.certificate_facts, "certificate_fact_id", "filing_id"),
    }
    counted = [
        dims.id_collisions(rows, short, full).agg(F.count("*").alias("collided_ids")).select(F.lit(name).alias("audited"), "collided_ids")
        for name, (rows, short, full) in audits.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@filings
def company_dim_legacy(f: Filings) -> DataFrame:
    flat = f.flat.withColumn("processing_timestamp", F.col("partition_date"))
    return dims.legacy_companies(flat)


@filings
def location_dim(f: Filings) -> DataFrame:
    return dims.legacy_locations(f.flat)


@filings
def location_states(f: Filings) -> DataFrame:
    """Locations whose descriptions carry state marks."""
    number = F.split_part(F.col("cola_origin_code"), F.lit("_"), F.lit(2)).cast("int")
    text_ = F.concat(F.lit("Goods of nation "), number.cast("string"), tables.choose(number % 3, {0: ", NY", 1: " (CA WEST)"}, ""))
    return dims.legacy_locations(f.flat.withColumn("origin_code_validation_description", text_))


@filings
def product_type_dim(f: Filings) -> DataFrame:
    return dims.legacy_product_types(
        f.flat.withColumn("product_class_validation_description", F.col("cola_product_class_type"))
    )


@modelled
def fact_products(f: Filings) -> DataFrame:
    return f.product_facts


@modelled
def fact_certificates(f: Filings) -> DataFrame:
    return f.certificate_facts


@filings
def fact_products_legacy(f: Filings) -> DataFrame:
    return facts.legacy_product_facts(f.flat).select(
        "product_id", "filing_id", "company_id", "location_id", "product_type_id", "filing_date_id", "approval_date_id",
        "brand_name", "label_images_count", "days_to_approval", rounded("data_quality_score").alias("data_quality_score"),
    )


@filings
def fact_certificates_legacy(f: Filings) -> DataFrame:
    return facts.legacy_certificate_facts(f.flat).drop("authorized_signature_url")


@modelled
def star_rollup(f: Filings) -> DataFrame:
    return facts.star(f.product_facts, f.companies, f.products, f.dates).groupBy("year", "season", "brand_name").agg(
        F.count("*").alias("filings"),
        F.count_distinct("business_name").alias("companies"),
        rounded(F.avg("days_to_approval")).alias("mean_days"),
    )


@modelled
def fact_dates(f: Filings) -> DataFrame:
    roles = {"filing_date_id": "filed", "approval_date_id": "approved", "expiration_date_id": "expires"}
    joined = lookup.with_dates(f.product_facts, f.dates, roles, ["year", "quarter_name"])
    return joined.groupBy("filed_year", "approved_year", "expires_quarter_name").agg(F.count("*").alias("filings"))


@query
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    fetched = clean.fetched_ok(
        table(spark, sf_dir, "orders").withColumn(
            "status_code", F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 404).otherwise(200)
        )
    )
    return lookup.orphan_report(lines, [
        ("l_orderkey", fetched, "o_orderkey"),
        ("l_partkey", table(spark, sf_dir, "part"), "p_partkey"),
        ("l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey"),
    ])


# --- reference codes -------------------------------------------------------------


@query
def code_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn(
        "code",
        F.when(F.col("p_size") < 20, F.concat(F.lit(" "), F.col("p_type"), F.lit(" ")))
        .when(F.col("p_size") < 30, F.col("p_brand"))
        .when(F.col("p_size") < 40, F.lit("")),
    )
    checked = lookup.validate_product_class(part, "code", tables.reference_table(spark, sf_dir), output="v")
    return checked.select("p_partkey", "v.is_valid", "v.validated_code", "v.description", "v.validation_error")


@query
def code_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region descriptions repeat over nations: the last code wins."""
    regions = table(spark, sf_dir, "region").withColumn("goods", F.concat(F.lit("Goods of "), F.col("r_name")))
    return lookup.code_for_description(
        regions, "goods", tables.reference_table(spark, sf_dir), "origin_code", "code"
    ).select("r_name", "code")


# --- text ------------------------------------------------------------------------


@query
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    c = F.col("html")
    return pages.select(
        "page_id", F.md5(text.clean_text(c)).alias("cleaned"), F.md5(text.normalize_whitespace(c)).alias("squeezed"),
        F.md5(text.page_text(c)).alias("page_text"), F.length(text.clean_text(c, strip_html=False)).alias("kept_tags_length"),
    )


@query
def text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", F.array_join(text.extract_numbers(F.col("text")), ",").alias("numbers"),
        F.size(text.extract_numbers(F.col("text"), include_decimals=False)).cast("bigint").alias("whole_numbers"),
    )


@query
def email_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip per text, and e-mail validity of every word that holds an at-sign."""
    docs = table(spark, sf_dir, "documents")
    words = F.filter(F.split(text.squeeze(F.col("text")), " "), lambda w: w.contains("@"))
    count = lambda found: F.coalesce(F.size(found), F.lit(0)).cast("bigint")
    return docs.select(
        "doc_id", text.extract_zip_code(F.col("text")).alias("zip"), count(words).alias("words"),
        count(F.filter(words, text.is_email)).alias("emails"),
    )


@query
def url_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    bent = F.when(F.col("url").contains("#"), F.replace("url", F.lit("#"), F.lit(" "))).otherwise(F.upper("url"))
    return pages.select("page_id", text.is_url(F.col("url")).alias("is_url"), text.is_url(bent).alias("bent_is_url"))


@query
def phone_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = F.col("c_custkey")
    raw = (
        F.when(F.col("c_acctbal") < 0, F.format_string("1.%03d.555.%04d", cust % 900 + 100, cust % 10000))
        .when(F.col("c_acctbal") < 5000, F.format_string("(%03d) 555 %04d", cust % 900 + 100, cust % 10000))
        .otherwise(F.concat(F.lit("ext "), cust.cast("string")))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", text.clean_phone(raw).alias("phone"))


@query
def address_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.col("c_custkey").cast("string"), F.lit(" north <b>"), F.col("c_mktsegment"),
        F.lit("</b> Avenue,\u00a0Lower  Eastern Road\n"), F.col("c_name"), F.lit(" place Drive"),
    )
    address = text.normalize_address(raw)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", address.alias("address"), text.match_key(F.col("c_name"), raw).alias("match_key")
    )


@query
def state_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.choose(F.col("n_nationkey") % 5, {0: " california", 1: "New York", 2: "tx", 3: "Florida "}, "x1")
    joined = table(spark, sf_dir, "customer").join(
        F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select("c_custkey", text.normalize_state(raw).alias("state"))


@query
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in seven formats and two bad ones."""
    d, k = F.col("o_orderdate"), F.col("o_custkey") % 9
    forms = ["M/d/yyyy", "MM-dd-yyyy", "yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "MM/dd/yy", "M-d-yy"]
    raw = F.when(k == 7, F.concat(F.lit("13/45/"), F.year(d).cast("string")))
    for i, form in enumerate(forms):
        raw = raw.when(k == i, F.concat(F.lit(" "), F.date_format(d, form), F.lit(" ")))
    raw = raw.otherwise("soon")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.parse_flexible_date(raw).alias("parsed"), dates.format_date_iso(raw).alias("iso"),
        dates.parse_legacy_date(text.strip(raw)).alias("legacy"), dates.date_id(dates.parse_flexible_date(raw)).alias("date_id"),
        dates.parse_legacy_date(F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("legacy_stamp"),
    )


@query
def decimal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    price = F.format_string("USD $%,.2f", F.col("p_retailprice"))
    share = F.concat((F.col("p_size") / 8).cast("string"), F.lit(" %"))
    return part.select(
        "p_partkey", numbers.parse_decimal(price).cast("double").alias("plain"),
        numbers.clean_currency(price).cast("double").alias("currency"),
        numbers.parse_percentage(share).cast("double").alias("share"),
        numbers.parse_decimal(F.concat(F.col("p_brand"), F.lit("-1"))).cast("double").alias("broken"),
    )


@query
def alcohol(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_quantity").cast("int").cast("string")
    raw = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("5 % sugar, "), n, F.lit(".5% ABV")))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit("Alcohol : "), n, F.lit(" by volume")))
        .when(F.col("l_discount") > 0.05, F.concat(n, F.lit("% of all")))
        .otherwise(F.concat(F.lit("proof "), n))
    )
    value = numbers.extract_alcohol_content(raw).cast("double")
    return table(spark, sf_dir, "lineitem").groupBy(raw.alias("raw"), value.alias("alcohol")).agg(F.count("*").alias("lines"))


@query
def container(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size").cast("string")
    unit = tables.choose(F.col("p_type"), {"STANDARD": " ML", "ECONOMY": "00 ml", "MEDIUM": " L", "PROMO": "oz", "LARGE": " gallons"}, " units")
    return table(spark, sf_dir, "part").select(
        "p_partkey", numbers.standardize_container_size(F.concat(F.lit("approx "), n, unit)).alias("size")
    )


@query
def beverage_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    c = F.col("text")
    flags = classify.product_flags(c)
    pair = classify.category_pair(c)
    return docs.select(
        "doc_id", classify.beverage_type(c).alias("beverage_type"), classify.product_category(c).alias("category"),
        *[v.alias(k) for k, v in flags.items()], pair["category"].alias("kind"), pair["subcategory"].alias("subkind"),
    )


@query
def rule_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older rule set over pages read as detail rows."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("filing_id"), F.col("html").alias("brand_name"),
        F.col("url").alias("wine_vintage"), F.lit("12 oz").alias("net_contents"),
        F.concat(F.lit("<i>2024-01-"), F.lpad((F.col("page_id") % 31 + 1).cast("string"), 2, "0"), F.lit("</i>")).alias("filing_date"),
    )
    done = legacy_classification(registry.apply_rules(pages, rules_for(DETAIL, legacy=True)))
    return done.select(
        "filing_id", F.md5("brand_name").alias("brand_hash"), F.array_join("wine_vintage", ",").alias("wine_vintage"),
        "net_contents", "filing_date", "beverage_type", "filing_id_valid",
    )


# --- lenient casts, compliance ---------------------------------------------------

schemas.register(
    "loose_event",
    "event_id BIGINT, user_id STRING, event_type BOOLEAN, value BIGINT, props BIGINT, day DATE, stamp TIMESTAMP, extra STRING",
)


def _loose_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "user_id",
        F.when(F.col("event_type") == "click", "Yes").when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("event_type"),
        F.concat(F.lit("-"), F.format_string("%.2f", "value")).alias("value"),
        F.when(F.col("event_type") == "error", "none").otherwise(F.col("props")).alias("props"),
        F.when(F.col("user_id") < 50, F.date_format(d, "yyyy-M-d")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("day"),
        F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("stamp"),
    )


@query
def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = structure.project_to_schema(_loose_events(spark, sf_dir), schemas.get("loose_event"))
    return rows.withColumn("stamp", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "fields", clean.field_count(rows).cast("bigint")
    )


@query
def schema_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _loose_events(spark, sf_dir)
    report = stats.schema_compliance(rows.drop("stamp"), schemas.get("loose_event")).unionByName(
        stats.schema_compliance(rows.withColumn("extra", F.lit("x")).withColumn("more", F.lit(1)), schemas.get("loose_event"))
    )
    return report.withColumns({
        "missing_fields": F.array_join("missing_fields", ","), "extra_fields": F.array_join("extra_fields", ","),
    })


@query
def field_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.field_validation(_loose_events(spark, sf_dir), schemas.get("loose_event"))


@query
def dataset_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _loose_events(spark, sf_dir).withColumn("extra", F.lit("x"))
    out = stats.dataset_quality(stats.schema_compliance(rows, schemas.get("loose_event")), stats.field_validation(rows, schemas.get("loose_event")))
    return out.select(*[rounded(c).alias(c) for c in out.columns])


# --- runs, gaps ------------------------------------------------------------------

FETCH_GROUPS = ["partition_date", "receipt_method", "view"]


@query
def fetch_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts kept per group when three failures in a row stop it; small blocks exercise the carry."""
    log = tables.fetch_log(spark, sf_dir)
    kept = ordered.keep_until_failures(log, FETCH_GROUPS, max_failures=3, block=64)
    return kept.select(*FETCH_GROUPS, "sequence", "success")


@query
def fetch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.fetch_stats(tables.fetch_log(spark, sf_dir), FETCH_GROUPS)
    return out.withColumn("success_rate", rounded("success_rate"))


def _expected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Days from first to last event and four methods; landed where a purchase came in."""
    events = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    bounds = events.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    spine = grids.date_spine(bounds, "a", "b", name="partition_date")
    landed = events.where((F.col("event_type") == "purchase") & (F.col("value") > 35)).select(
        day.alias("partition_date"), (F.col("user_id") % 4).cast("int").alias("receipt_method")
    )
    return ordered.expected_partitions(spine, [1, 2, 3, 0]), landed


@query
def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, landed = _expected(spark, sf_dir)
    missing = ordered.missing_partitions(expected, landed).withColumn("landed", F.lit(False))
    return missing.unionByName(ordered.present_partitions(expected, landed).withColumn("landed", F.lit(True)))


@query
def backfill_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, landed = _expected(spark, sf_dir)
    return ordered.backfill_days(expected, landed).withColumn("found_run", F.col("found_run").cast("bigint"))


# --- statistics ------------------------------------------------------------------


@query
def extraction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.detail_raw(spark, sf_dir)
    rows = raw.withColumn("parsing_success", F.col("status_code") == 200)
    out = stats.extraction_stats(rows, clean.field_count(raw, ["brand_name", "applicant_phone", "applicant_email", "approval_date"]))
    return out.withColumn("success_rate", rounded("success_rate"))


@filings
def cleaning_stats(f: Filings) -> DataFrame:
    both = F.col("has_detail").cast("int") + F.col("has_certificate").cast("int")
    out = stats.cleaning_stats(f.merged, F.sum(both), F.lit(0).cast("bigint"))
    return out.withColumn("success_rate", rounded("success_rate"))


@filings
def structuring_stats(f: Filings) -> DataFrame:
    out = stats.structuring_stats(f.structured)
    return out.withColumn("average_quality_score", rounded("average_quality_score"))


@modelled
def fact_stats(f: Filings) -> DataFrame:
    p = stats.product_fact_stats(f.product_facts).select(
        F.lit("products").alias("fact"), "fact_records_created", "missing_company_keys",
        rounded("average_quality_score").alias("average_quality_score"), rounded("average_days_to_approval").alias("measure"),
    )
    c = stats.certificate_fact_stats(f.certificate_facts).select(
        F.lit("certificates").alias("fact"), "fact_records_created", "missing_company_keys",
        rounded("average_quality_score").alias("average_quality_score"), rounded("approval_rate").alias("measure"),
    )
    return p.unionByName(c)


@modelled
def export_summary(f: Filings) -> DataFrame:
    return stats.export_summary({
        "dim_dates": f.dates, "dim_companies": f.companies, "dim_products": f.products,
        "fact_products": f.product_facts, "fact_certificates": f.certificate_facts,
    })


@filings
def reference_stats(f: Filings) -> DataFrame:
    return stats.reference_stats(f.reference, ["product_class_type", "origin_code", "unknown_kind"])


COVERAGE_FIELDS = ["brand_name", "applicant_phone", "applicant_email", "applicant_fax", "net_contents", "approval_date", "cert_status"]


@filings
def field_coverage(f: Filings) -> DataFrame:
    out = stats.field_coverage(f.merged.select(*COVERAGE_FIELDS, "partition_date"))
    return out.withColumn("coverage_percentage", rounded("coverage_percentage"))


# --- checks ----------------------------------------------------------------------


def _flat_check(result: DataFrame) -> DataFrame:
    """Check row with joined issues and rounded numbers."""
    out = result.withColumn("issues", F.array_join("issues", "; "))
    fixed = {f.name: rounded(f.name) for f in out.schema.fields if isinstance(f.dataType, (T.DoubleType, T.DecimalType))}
    arrays = {f.name: F.array_join(f.name, ",") for f in out.schema.fields if isinstance(f.dataType, T.ArrayType)}
    return out.withColumns(fixed | arrays)


@query
def check_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.detail_raw(spark, sf_dir).withColumn("parsing_success", F.col("status_code") == 200)
    return _flat_check(checks.parsing_success(rows))


@query
def check_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_check(checks.extraction_completeness(clean.fetched_ok(tables.detail_raw(spark, sf_dir)), DETAIL))


@filings
def check_validation(f: Filings) -> DataFrame:
    rows = f.flat
    return _flat_check(checks.validation_rates(
        rows, F.col("filing_id_valid"), F.col("product_class_validation_is_valid"), F.col("origin_code_validation_is_valid"),
        F.col("cola_net_contents").isNull(),
    ))


@query
def check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _loose_events(spark, sf_dir).withColumn("extra", F.lit("x"))
    return _flat_check(checks.schema_compliance(rows, schemas.get("loose_event")))


@filings
def check_reference(f: Filings) -> DataFrame:
    return _flat_check(checks.reference_presence(f.reference))


@filings
def check_reference_coverage(f: Filings) -> DataFrame:
    now = F.lit("2001-08-20").cast("timestamp")
    return _flat_check(checks.reference_coverage(f.reference, now))


@filings
def reference_sample(f: Filings) -> DataFrame:
    return checks.reference_samples(f.reference, "origin_code")


@modelled
def check_facts(f: Filings) -> DataFrame:
    return _flat_check(checks.fact_integrity(f.product_facts))


@filings
def check_dimensions(f: Filings) -> DataFrame:
    return _flat_check(checks.dimension_quality(f.companies))


@modelled
def check_certificates(f: Filings) -> DataFrame:
    return _flat_check(checks.certificate_compliance(f.certificate_facts))


@filings
def top_companies(f: Filings) -> DataFrame:
    return checks.top_companies(f.companies)


@modelled
def certificate_types(f: Filings) -> DataFrame:
    return checks.certificate_types(f.certificate_facts)


@modelled
def most_common_type(f: Filings) -> DataFrame:
    return checks.most_common_type(f.certificate_facts)


# --- pages -----------------------------------------------------------------------


@query
def error_page_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop the fixed error page, and the shortest page taken as one more."""
    pages = table(spark, sf_dir, "pages")
    shortest = pages.agg(F.min_by("html", F.struct(F.length("html"), F.col("page_id"))).alias("html")).select(
        ids.content_hash(F.col("html")).alias("content_hash")
    )
    return clean.drop_error_pages(pages, shortest).select("page_id", ids.content_hash(F.col("html")).alias("content_hash"))


@lru_cache(maxsize=8)
def landed_pages(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """Rendered pages of a view, landed as files once: a page is read, not computed, by the extraction."""
    pages = tables.detail_pages(spark, sf_dir) if view == DETAIL else tables.certificate_pages(spark, sf_dir)
    return scratch.through_storage(pages, f"pages-{view}", files.PAGES_A_FILE)


@query
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = clean.readable(clean.fetched_ok(landed_pages(spark, sf_dir, DETAIL)))
    return extract.detail_fields(good).select(
        "filing_id", "status", "vendor_code", "serial_number", "class_type_code", "origin_code", "brand_name", "fanciful_name",
        "for_sale_in", "formula", "approval_date", "type_of_application", "grape_varietals", "total_bottle_capacity", "wine_vintage",
        "qualifications", F.size("extraction_errors").cast("bigint").alias("errors"), "parsing_success",
    )


@query
def filings_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of both views through the whole daily plan."""
    pages = landed_pages(spark, sf_dir, DETAIL).unionByName(landed_pages(spark, sf_dir, CERTIFICATE), allowMissingColumns=True)
    marked = write_outcomes(pages, scratch.fresh_path(spark, "outcomes"))
    return from_pages(marked).select(
        "filing_id", "has_detail", "has_certificate", "brand_name", "status", "applicant_business_name")


@query
def filings_from_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' pages landed as HTML files, compacted day by day, through the whole daily plan."""
    root, compact, outcomes = (scratch.fresh_path(spark, name) for name in ("html", "compact", "outcomes"))
    files.land_html(tables.supplier_pages(spark, sf_dir), root)
    files.compact_days(spark, root, compact)
    marked = write_outcomes(files.scan_parquet(spark, compact), outcomes)
    return from_pages(marked).select(
        "filing_id", "has_detail", "has_certificate", "brand_name", "status", "cert_status", "applicant_business_name", "partition_date")


def _web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web pages as landings of three days."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 3).cast("int"))
    return table(spark, sf_dir, "pages").select(
        filing_id(F.col("page_id")).alias("filing_id"), F.lit(DETAIL).alias("view"), day.alias("partition_date"),
        (F.col("page_id") % 4).cast("int").alias("receipt_method"), "html")


@query
def landed_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages landed as HTML files, compacted, and read back; ``listed`` tells the files of the last day, scanned alone."""
    root, target = scratch.fresh_path(spark, "html"), scratch.fresh_path(spark, "compact")
    pages = _web_pages(spark, sf_dir)
    files.land_html(pages, root)
    files.compact_days(spark, root, target)
    last = str(pages.agg(F.max("partition_date")).first()[0])
    listed = files.scan_landed_html(spark, root, [last]).select("filing_id", F.lit(True).alias("listed"))
    return files.scan_parquet(spark, target).join(listed, "filing_id", "left").select(
        "filing_id", "view", "partition_date", "receipt_method", F.col("size_bytes").cast("bigint").alias("size_bytes"), F.md5("html").alias("html_md5"),
        F.coalesce("listed", F.lit(False)).alias("listed"))


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered pages of both views with every kind of fault, and filings of one receipt method landed twice."""
    pages = landed_pages(spark, sf_dir, DETAIL).unionByName(landed_pages(spark, sf_dir, CERTIFICATE), allowMissingColumns=True)
    fault = F.substring("filing_id", 5, 1)  # a digit of the day
    spoiled = pages.select(
        F.when(fault != "2", F.col("filing_id")).alias("filing_id"), F.when(fault == "1", "leaflet").otherwise(F.col("view")).alias("view"),
        "sequence", "status_code", F.when(F.col("receipt_method") != 3, F.col("html")).alias("html"), "receipt_method", F.lit(1).alias("landing"))
    again = spoiled.where("receipt_method = 1").withColumn("sequence", F.col("sequence") - 1).withColumn("landing", F.lit(0))
    return spoiled.unionByName(again)


@query
def page_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that extraction does not take, and why."""
    marked = write_outcomes(_spoiled(spark, sf_dir), scratch.fresh_path(spark, "outcomes"))
    return marked.where(F.col("outcome") != "kept").select(
        "filing_id", F.col("view").cast("string").alias("view"), "landing", F.col("outcome").cast("string").alias("outcome"),
        F.array_join("extraction_errors", "; ").alias("errors"))


@query
def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by view and outcome, and how many landed in all."""
    marked = write_outcomes(_spoiled(spark, sf_dir), scratch.fresh_path(spark, "outcomes"))
    counts = marked.groupBy(F.col("view").cast("string").alias("view"), F.col("outcome").cast("string").alias("outcome")).agg(F.count("*").alias("pages"))
    return counts.withColumn("landed", marked.agg(F.count("*").alias("landed")).scalar())


@query
def page_company_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.detail_fields(landed_pages(spark, sf_dir, DETAIL)).select(
        "filing_id", "plant_registry_number", "applicant_business_name", "address_line_1", "address_line_2",
        "applicant_mailing_address", "contact_first_name", "contact_last_name", "contact_full_name", "applicant_phone",
        "contact_phone_area_code", "contact_phone_exchange", "contact_phone_number", "applicant_fax",
    )


@query
def page_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.certificate_fields(landed_pages(spark, sf_dir, CERTIFICATE))
    s = F.col("signatures")
    return out.select(
        "filing_id", "plant_registry_number", "serial_number", "brand_name", "wine_appellation", "applicant_phone",
        "applicant_email", "application_date", "approval_date", "applicant_business_name", "applicant_mailing_address",
        "status", "class_type_code", F.col("codes.ct_code").alias("ct_code"), F.col("codes.or_code").alias("or_code"),
        s["applicant_signature"].alias("signature"), s["present"].alias("signed"), s["width"].alias("signature_width"),
    )


@query
def page_checkboxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.certificate_fields(landed_pages(spark, sf_dir, CERTIFICATE))
    return out.select("filing_id", *[F.col(group)[name].alias(name) for group, name, *_ in CHECKBOXES])


@query
def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.certificate_fields(landed_pages(spark, sf_dir, CERTIFICATE))
    return images.explode_images(out).select(
        "filing_id", F.col("position").cast("bigint").alias("position"), "original_url", "type", F.col("display.w").alias("width"),
        F.col("physical.h").alias("height_inches"), "source_filename",
    )


@query
def image_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.image_counters(extract.certificate_fields(landed_pages(spark, sf_dir, CERTIFICATE)), lambda i: i["display"].isNotNull())


@query
def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code tables rendered one page per region and parsed back."""
    nation = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    row = F.concat(F.lit("<tr><td> "), F.col("n_name"), F.lit("</td><td>Goods &amp; wares of "), F.col("r_name"), F.lit("</td></tr>"))
    long_row = F.concat(F.lit("<tr><td>LONGER THAN TEN "), F.col("n_name"), F.lit("</td><td>x</td></tr><tr><td>one</td></tr>"))
    # a region holds a fixed handful of nations
    pages = nation.groupBy("r_name").agg(F.array_join(F.sort_array(F.collect_list(F.concat(row, long_row))), "").alias("body")).select(
        F.concat(
            F.lit("<html><table><tr><th>Other</th></tr><tr><td>A</td><td>B</td></tr></table><table><tr><th>Origin Code</th><th>Description</th></tr>"),
            F.col("body"), F.lit("</table></html>"),
        ).alias("html"),
        F.lit("2024-01-01").cast("timestamp").alias("extracted_at"),
    )
    return extract.reference_codes(pages).select("code", "description", "kind")


@query
def binary_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bytes behind different file signatures."""
    magic = tables.choose(
        F.col("page_id") % 6,
        {0: "FFD8FF", 1: "89504E470D0A1A0A", 2: "474946383961", 3: "52494646AABBCCDD57454250", 4: "52494646"}, "00",
    )
    body = F.when(F.col("page_id") % 7 == 0, F.lit("short")).otherwise(F.col("html"))
    content = F.concat(F.unhex(magic), F.encode(body, "UTF-8"))
    kind = F.when(F.col("url").startswith("https"), F.lit(None).cast("string")).when(F.col("url").contains("page="), "Image/PNG").otherwise("text/html")
    binaries = table(spark, sf_dir, "pages").select("page_id", content.alias("content"), kind.alias("content_type"))
    return images.check_payloads(binaries).withColumn("file_size_bytes", F.col("file_size_bytes").cast("bigint"))


# --- sinks -----------------------------------------------------------------------


@filings
def export_projection(f: Filings) -> DataFrame:
    out = upsert.export(f.companies, "dim_companies", F.lit("2001-12-31"))
    return out.withColumn("data_quality_score", rounded("data_quality_score"))


@filings
def export_dates(f: Filings) -> DataFrame:
    return upsert.export(f.dates, "dim_dates")


@modelled
def export_products(f: Filings) -> DataFrame:
    out = upsert.export(f.products, "dim_products", F.lit("2001-12-31"))
    return out.withColumn("data_quality_score", rounded("data_quality_score")).withColumn("alcohol_content", rounded("alcohol_content"))


@query
def export_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image addresses of a certificate as a list column; certificates without a signature export none."""
    found = extract.certificate_fields(landed_pages(spark, sf_dir, CERTIFICATE))
    urls = F.transform(F.filter("label_images", lambda i: F.col("signatures.present")), lambda i: i["original_url"])
    out = upsert.export(found.withColumn("image_urls", urls), "certificate_images", F.col("partition_date"))
    return out.select("filing_id", F.array_join("image_urls", "|").alias("urls"), F.size("image_urls").alias("images"), "partition_date")


@query
def nested_columns_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certificates without their nested columns, next to which columns those are."""
    found = extract.certificate_fields(landed_pages(spark, sf_dir, CERTIFICATE))
    flat, whole = clean.drop_nested(found), clean.drop_nested(found, keep_metadata=True)
    dropped = ",".join(c for c in whole.columns if c not in flat.columns)
    return flat.select("filing_id", "status", F.lit(dropped).alias("dropped"))


@query
def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in files that hold one JSON array each (a hundred keys a file), read back as records."""
    path = scratch.fresh_path(spark, "json-arrays")
    rows = table(spark, sf_dir, "customer").withColumn("block", F.floor(F.col("c_custkey") / 100))
    record = F.struct("c_custkey", "c_name", "c_mktsegment")
    files.write_json_arrays(rows, path, "block", record)
    return files.scan_json(spark, path, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING").select("c_custkey", "c_name", "c_mktsegment")


@query
def backfill_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range of a backward backfill begun on each order day, twenty years on; the earliest ones meet the first day of the archive."""
    today = table(spark, sf_dir, "orders").select(F.add_months(F.col("o_orderdate").cast("date"), 240).alias("today")).distinct()
    first, last = ordered.backfill_range(F.col("today"))
    return today.select("today", first.alias("first_day"), last.alias("last_day"), F.datediff(first, last).alias("days_back"))


def _two_days(f: Filings) -> tuple[DataFrame, DataFrame]:
    """Company dimension of the filings before 1998 and of those from 1998 on."""
    early, late = (f.structured.where(c) for c in (F.col("partition_date") < "1998-01-01", F.col("partition_date") >= "1998-01-01"))
    return tuple(
        upsert.export(dims.companies(rows), "dim_companies", F.lit(day)) for rows, day in ((early, "1997-12-31"), (late, "2001-12-31"))
    )


@modelled
def upsert_dims(f: Filings) -> DataFrame:
    old, new = _two_days(f)
    out = upsert.upsert_table(old, new, "dim_companies")
    return out.withColumn("data_quality_score", rounded("data_quality_score"))


@modelled
def upsert_facts(f: Filings) -> DataFrame:
    """Both fact tables merged by filing: an old day of all filings, and a new day of those from 1998 on, restated."""
    merged = []
    for name, rows in (("fact_products", f.product_facts), ("fact_certificates", f.certificate_facts)):
        late = F.col("partition_date") >= "1998-01-01"
        old = upsert.export(rows, name, F.lit("1998-12-31"))
        new = upsert.export(rows.where(late), name, F.lit("2001-12-31")).withColumn("serial_number", F.lit("restated"))
        out = upsert.upsert_table(old, new, name)
        merged.append(out.select(F.lit(name).alias("fact"), "filing_id", "company_key", "serial_number", "partition_date"))
    return reduce(DataFrame.unionByName, merged)


def _restated(f: Filings) -> tuple[DataFrame, DataFrame]:
    """Product facts of an old day, and those from 1998 on restated on a new one."""
    old = upsert.export(f.product_facts, "fact_products", F.lit("1998-12-31"))
    late = f.product_facts.where(F.col("partition_date") >= "1998-01-01")
    return old, upsert.export(late, "fact_products", F.lit("2001-12-31")).withColumn("serial_number", F.lit("restated"))


FACT_COLUMNS = ["filing_id", "company_key", "serial_number", "partition_date"]


@modelled
def merge_published(f: Filings) -> DataFrame:
    """Product facts published by bucket, a delta merged in place twice."""
    old, new = _restated(f)
    facts = published.PublishedTable(scratch.fresh_path(f.spark, "published"), ["filing_id"], PUBLISHED_BUCKETS)
    facts.create(old.select(*FACT_COLUMNS))
    for _ in range(2):
        facts.merge(new.select(*FACT_COLUMNS))
    return facts.read(f.spark)


@modelled
def stream_published(f: Filings) -> DataFrame:
    """The same table with the delta taken from a file stream, merged by micro-batch."""
    old, new = _restated(f)
    path = scratch.fresh_path(f.spark, "published")
    facts = published.PublishedTable(path, ["filing_id"], PUBLISHED_BUCKETS)
    facts.create(old.select(*FACT_COLUMNS))
    delta = scratch.fresh_path(f.spark, "delta")
    new.select(*FACT_COLUMNS).write.option("maxRecordsPerFile", 20_000).parquet(delta)
    stream = f.spark.readStream.schema(new.select(*FACT_COLUMNS).schema).option("maxFilesPerTrigger", 4).parquet(delta)
    facts.follow(stream, path + "-checkpoint").awaitTermination()
    return facts.read(f.spark)


DAY_DDL = "filing_id STRING, has_detail BOOLEAN, has_certificate BOOLEAN, partition_date DATE"


@modelled
def consolidated_day(f: Filings) -> DataFrame:
    """All days written under one schema, then the last day twice under a wider one, and every day read under that."""
    path = scratch.fresh_path(f.spark, "consolidated")
    narrow, wide = (T.StructType.fromDDL(DAY_DDL + more) for more in ("", ", data_completeness_score DOUBLE"))
    rows = f.structured.withColumn("data_completeness_score", rounded("data_completeness_score"))
    files.write_parquet(rows, path, narrow, ["partition_date"])
    last = str(rows.agg(F.max("partition_date")).first()[0])
    for _ in range(2):
        published.write_day(rows, path, last, wide)
    return published.read_days(f.spark, path, wide)


@modelled
def accumulate_dims(f: Filings) -> DataFrame:
    old, new = _two_days(f)
    columns = ["company_key", "first_seen_date", "last_seen_date", "total_applications", "business_name"]
    return upsert.accumulate(old.select(*columns), new.select(*columns), "company_key", "total_applications")


@filings
def upsert_codes(f: Filings) -> DataFrame:
    fresh = f.reference.where(F.col("code") != "NATION_3").withColumn("description", F.upper("description"))
    return upsert.export_codes(upsert.upsert_codes(f.reference, fresh))


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", rounded("o_totalprice", 2).alias("o_totalprice"), "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("partition_date"), (F.col("o_orderkey") % 4).cast("int").alias("receipt_method"),
    )


ORDER_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING, partition_date DATE, receipt_method INT"


@query
def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema-enforced write partitioned by status, read back whole."""
    path = scratch.fresh_path(spark, "orders-parquet")
    files.write_parquet(_order_rows(spark, sf_dir), path, T.StructType.fromDDL(ORDER_DDL), ["o_orderstatus"])
    return files.scan_parquet(spark, path)


@query
def roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "orders-json")
    files.write_json(_order_rows(spark, sf_dir), path)
    return files.read_table(spark, {"orders": {"format": "json", "path": path, "schema": ORDER_DDL}}, "orders")


@query
def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "orders-csv")
    rows = _order_rows(spark, sf_dir).withColumn("tags", F.array("o_orderstatus", "o_orderpriority"))
    files.write_csv(rows, path)
    return files.read_table(spark, {"orders": {"format": "csv", "path": path, "schema": ORDER_DDL + ", tags STRING"}}, "orders")


@query
def landed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as one file per row group in the landing layout, scanned with id and lineage."""
    path = scratch.fresh_path(spark, "landed")
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("sequence"), "html", "url", F.lit("2024-01-01").cast("date").alias("partition_date"),
        (F.col("page_id") % 4).cast("int").alias("receipt_method"), F.lit(DETAIL).alias("view"),
        filing_id(F.col("page_id")).alias("filing_id"), F.length("html").cast("bigint").alias("size_bytes"),
    )
    files.write_landed(pages, path)
    scanned = files.scan_parquet(spark, path, "2024-01-01", [DETAIL])
    return clean.lineage(scanned).select("filing_id", "sequence", "url", "size_bytes", "partition_date", "receipt_method", "view")


@query
def id_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids read from the page against ids of the file; orders of one customer segment were filed under another id."""
    landed = landed_pages(spark, sf_dir, DETAIL).withColumn(
        "file_id", F.when(F.col("receipt_method") == 0, F.concat(F.lit("9"), F.substring("filing_id", 2, 13))).otherwise(F.col("filing_id"))
    )
    found = extract.detail_fields(landed.withColumn("source_file", F.col("file_id")))
    return found.select("filing_id", "source_file", clean.id_mismatch(F.col("filing_id"), F.col("source_file")).alias("mismatch"))


# --- streaming -------------------------------------------------------------------


def _runs(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("is_failure"),
        F.col("event_type").isin("purchase", "click", "signup").alias("is_success"),
    )


def _stamp(frame: DataFrame, name: str = "window_start") -> DataFrame:
    return frame.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a file stream; it is one file or a folder of them, and only a pattern names either to a stream."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query
def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(table(spark, sf_dir, "events"))
    return _stamp(monitor.run_health(runs)).withColumn("success_rate", rounded("success_rate"))


@query
def run_health_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from a stream in update mode, the last state of each window."""
    windows = monitor.run_health(_runs(_stream(spark, sf_dir, "events")))
    path = scratch.fresh_path(spark, "run-health")
    ingest.land_batches(windows, path, path + "-checkpoint", "update").awaitTermination()
    out = ingest.merged(spark, path, windows.schema, ["window_start"])
    return _stamp(out).withColumn("success_rate", rounded("success_rate"))


@query
def health_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(monitor.health_alerts(monitor.run_health(_runs(table(spark, sf_dir, "events")))))


@query
def alert_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = monitor.health_alerts(monitor.run_health(_runs(table(spark, sf_dir, "events"))))
    return _stamp(monitor.alert_report(alerts))


def _results(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("passed"),
        F.when(F.col("value") > 20, "ERROR").when(F.col("value") > 5, "WARN").alias("severity"),
    )


@query
def check_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(monitor.check_rollup(_results(table(spark, sf_dir, "events"))))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drained as detail rows through the batch cleaning into partitioned Parquet."""
    rows = _stream(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("filing_id"), F.lit(DETAIL).alias("view"), F.col("text").alias("brand_name"), "lang",
    )
    path = scratch.fresh_path(spark, "ingest")
    cleaned = ingest.cleaned(rows, DETAIL)
    ingest.append_partitions(cleaned, path, path + "-checkpoint", ["view", "lang"]).awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(path).select(F.col("filing_id").cast("string"), F.md5("brand_name").alias("brand_hash"), F.col("lang").cast("string"))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event users deduplicated in a stream, landed by batch and merged by key."""
    rows = _stream(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("filing_id"), F.col("ts").cast("timestamp").alias("fetched_at"),
        F.lit("2024-01-31").cast("date").alias("partition_date"),
    )
    path = scratch.fresh_path(spark, "dedup")
    fresh = ingest.dedup_ids(rows, lateness="60 days")
    ingest.land_batches(fresh, path, path + "-checkpoint").awaitTermination()
    return ingest.merged(spark, path, fresh.schema, ["filing_id"], [F.col("partition_date").desc()]).select("filing_id", "partition_date")
