"""The daily plan: extract, clean, merge, structure, model.

Everything is one lazy plan. It shuffles by filing id to pick the last row per
view and to pair the views (one exchange per view serves both), and by dimension
key to build the dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartouche.constants import CERTIFICATE, DETAIL, ERROR_PAGE_SHA256
from cartouche.functions.ids import is_filing_id
from cartouche.functions.text import filled
from cartouche.operators import clean, consolidate, dims, extract, facts, lookup, merge, ordered, structure
from cartouche.sources import grids, tables
from cartouche.sources.files import PAGES_A_FILE, write_parquet
from cartouche.sources.scratch import through_storage


def cleaned(rows: DataFrame, view: str, order: list[Column] | None = None) -> DataFrame:
    """Last row per id of one view, cleaned.

    Cleaning is row by row, so picking first gives the same rows and spares the
    ones that are replaced.
    """
    return clean.apply_view_rules(ordered.latest_per_view(clean.identified(rows)[0], order), view)


# what a detail page does not show; the columns stay so that later steps find them
ABSENT_FROM_PAGES = {
    "filing_date": "date",
    "expiration_date": "date",
    "product_description": "string",
    "alcohol_content": "decimal(18,4)",
    "net_contents": "string",
    "applicant_email": "string",
}


KEPT, REPLACED = "kept", "replaced"


def with_outcome(pages: DataFrame, error_hashes: list[str] | None = None) -> DataFrame:
    """Add ``outcome`` to landed pages in one pass, and ``extraction_errors`` with every reason against a page.

    ``kept`` pages go on to extraction. Others are ``not_fetched`` (a status code outside 200 to 299), ``error_page`` (a
    known one, by content), ``unreadable`` (no html or no view), ``unknown_view`` or ``no_id``, by the first reason in this
    order; or ``replaced``, when the same id and view landed again with a later sequence or time. Rows without a status
    code count as fetched.
    """
    known = F.col("view").isin(DETAIL, CERTIFICATE)
    html, view = filled(F.col("html")), filled(F.col("view"))
    reasons = [
        ("not_fetched", ~F.col("status_code").between(200, 299) if "status_code" in pages.columns else F.lit(False), F.lit("Not fetched")),
        ("error_page", ~clean.not_error_page(F.col("html"), [ERROR_PAGE_SHA256, *(error_hashes or [])]), F.lit("Known error page")),
        ("unreadable", ~html, F.lit("No html")), ("unreadable", ~view, F.lit("No view")),
        ("unknown_view", view & ~known, F.concat(F.lit("Unknown data type: "), F.col("view"))),
        ("no_id", ~filled(F.col("filing_id")), F.lit("No filing id")),
    ]
    # an unknown status is no success
    tested = [(name, F.coalesce(test, F.lit(True)), text) for name, test, text in reasons]
    marked = pages.withColumn("extraction_errors", F.array_compact(F.array(*[F.when(t, text) for _, t, text in tested])))
    marked = marked.withColumn("outcome", F.coalesce(*[F.when(t, F.lit(name)) for name, t, _ in tested], F.lit(KEPT)))
    # only pages that could be kept compete; each other page is a group of its own
    group = F.when(F.col("outcome") == KEPT, F.col("filing_id")).otherwise(F.monotonically_increasing_id().cast("string"))
    order = [F.col("sequence").desc(), *([F.col("fetched_at").desc()] if "fetched_at" in pages.columns else [])]
    rank = F.row_number().over(W.partitionBy("view", "outcome", "__group").orderBy(*order))
    later = (F.col("outcome") == KEPT) & (F.col("__rank") > 1)
    ranked = marked.withColumn("__group", group).withColumn("__rank", rank)
    return ranked.withColumn("outcome", F.when(later, F.lit(REPLACED)).otherwise(F.col("outcome"))).drop("__group", "__rank")


def write_outcomes(pages: DataFrame, path: str, error_hashes: list[str] | None = None) -> DataFrame:
    """Landed pages written once, partitioned by outcome; a reader of one outcome opens only its folder."""
    write_parquet(with_outcome(pages, error_hashes), path, partition_by=["outcome", "view"], rows_a_file=PAGES_A_FILE)
    return pages.sparkSession.read.parquet(path)


def last_landed(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages to extract, the last landing of each file id and view; and all others with their outcome.

    Picking before extraction spares the pages that were replaced.
    """
    marked = with_outcome(pages)
    return marked.where(F.col("outcome") == KEPT).drop("outcome", "extraction_errors"), marked.where(F.col("outcome") != KEPT)


def from_pages(pages: DataFrame) -> DataFrame:
    """Landed pages (a stored table, best one of ``write_outcomes``) -> structured filings."""
    kept = pages.where(F.col("outcome") == KEPT) if "outcome" in pages.columns else last_landed(pages)[0]
    detail_page, certificate_page, _ = clean.split_views(kept)
    detail = cleaned(extract.detail_fields(detail_page), DETAIL)
    detail = detail.withColumns({
        c: F.lit(None).cast(t) for c, t in ABSENT_FROM_PAGES.items() if c not in detail.columns
    })
    certificate = cleaned(extract.certificate_fields(certificate_page), CERTIFICATE)
    return structure.structure(merge.merge_views(detail, certificate))


@dataclass(frozen=True)
class Filings:
    """The plan over the order tables. Each step is lazy and built once."""

    spark: SparkSession
    sf_dir: str
    written: DataFrame | None = None
    written_companies: DataFrame | None = None
    written_products: DataFrame | None = None

    @cached_property
    def detail(self) -> DataFrame:
        rows = clean.fetched_ok(tables.detail_raw(self.spark, self.sf_dir)).drop("status_code")
        return cleaned(rows, DETAIL)

    @cached_property
    def certificate(self) -> DataFrame:
        return cleaned(tables.certificate_raw(self.spark, self.sf_dir), CERTIFICATE)

    @cached_property
    def merged(self) -> DataFrame:
        return merge.merge_views(self.detail, self.certificate)

    @cached_property
    def structured(self) -> DataFrame:
        return structure.structure(self.merged) if self.written is None else self.written

    @cached_property
    def stored(self) -> Filings:
        """The same plan with the structured table and the dimensions written first, once, for results that read them several times."""
        written = Filings(self.spark, self.sf_dir, through_storage(self.structured, "structured"))
        return replace(
            written, written_companies=through_storage(written.companies, "companies"), written_products=through_storage(written.products, "products"))

    @cached_property
    def companies(self) -> DataFrame:
        return dims.companies(self.structured) if self.written_companies is None else self.written_companies

    @cached_property
    def products(self) -> DataFrame:
        return dims.products(self.structured) if self.written_products is None else self.written_products

    @cached_property
    def dates(self) -> DataFrame:
        orders = tables.table(self.spark, self.sf_dir, "orders")
        bounds = grids.year_bounds(orders, F.col("o_orderdate").cast("date"))
        return dims.date_dimension(grids.date_spine(bounds, "first_day", "last_day"))

    @cached_property
    def product_facts(self) -> DataFrame:
        return facts.product_facts(self.structured, self.companies, self.products)

    @cached_property
    def certificate_facts(self) -> DataFrame:
        return facts.certificate_facts(self.structured, self.companies)

    @cached_property
    def reference(self) -> DataFrame:
        return tables.reference_table(self.spark, self.sf_dir)

    @cached_property
    def flat(self) -> DataFrame:
        """The older consolidated table, with code validation on the detail side."""
        detail = self.detail.withColumns({
            "product_class_type": F.col("product_description"),
            "filing_id_valid": is_filing_id(F.col("filing_id")),
        })
        detail = lookup.validate_product_class(detail, "class_type_code", self.reference, output="product_class_validation")
        detail = lookup.validate_origin_code(detail, "origin_code", self.reference, output="origin_code_validation")
        certificate = self.certificate.withColumn("filing_id_valid", is_filing_id(F.col("filing_id")))
        flat = consolidate.merge_flat(consolidate.flat_detail(detail), consolidate.flat_certificate(certificate))
        return consolidate.with_tier(flat)
