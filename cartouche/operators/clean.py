"""Row filters, rejects, rule cleaning and lineage for landed and extracted rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartouche.constants import CERTIFICATE, DETAIL, ERROR_PAGE_SHA256
from cartouche.functions import lenient
from cartouche.functions.ids import content_hash
from cartouche.functions.score import points, total
from cartouche.functions.text import filled
from cartouche.registry import registry, rules_for

LINEAGE = ["filing_id", "sequence", "url", "size_bytes", "fetched_at", "partition_date", "receipt_method", "view"]


def split_by(frame: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Kept rows and rejected rows; a null predicate rejects."""
    sure = F.coalesce(keep, F.lit(False))
    return frame.where(sure), frame.where(~sure)


def not_error_page(html: Column, hashes: Iterable[str] = (ERROR_PAGE_SHA256,)) -> Column:
    return F.coalesce(~content_hash(html).isin(*hashes), F.lit(True))


def drop_error_pages(pages: DataFrame, error_hashes: DataFrame | None = None) -> DataFrame:
    """Drop known error pages by content hash.

    ``error_hashes`` (column ``content_hash``) adds more of them. The list is
    anti-joined without a hint: Spark broadcasts it while it is under the
    configured size and shuffles by hash beyond that.
    """
    kept = pages.where(not_error_page(F.col("html")))
    if error_hashes is None:
        return kept
    hashed = kept.withColumn("content_hash", content_hash(F.col("html")))
    return hashed.join(error_hashes.select("content_hash").distinct(), "content_hash", "left_anti").drop("content_hash")


def readable(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages with html and a view / the others."""
    return split_by(pages, filled(F.col("html")) & filled(F.col("view")))


def fetched_ok(log: DataFrame) -> DataFrame:
    return log.where(F.col("status_code").between(200, 299))


def lineage(pages: DataFrame) -> DataFrame:
    return pages.select(*[c for c in LINEAGE if c in pages.columns])


def identified(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a filing id and a view / the others."""
    return split_by(rows, filled(F.col("filing_id")) & filled(F.col("view")))


def apply_view_rules(rows: DataFrame, view: str, legacy: bool = False) -> DataFrame:
    return registry.apply_rules(rows, rules_for(view, legacy))


def id_mismatch(page_id: Column, file_id: Column) -> Column:
    """True when both ids are there and differ, else null (absent)."""
    return F.when(filled(page_id) & (page_id != F.coalesce(file_id, F.lit(""))), F.lit(True))


def drop_nested(rows: DataFrame, keep_metadata: bool = False) -> DataFrame:
    return rows if keep_metadata else rows.drop("label_images", "signatures")


def field_count(rows: DataFrame, columns: list[str] | None = None) -> Column:
    """Non-empty fields of a row; null, '' and [] are empty."""
    names = columns or rows.columns
    return total([points(lenient.non_empty(F.col(n), rows.schema[n].dataType), 1) for n in names])


def split_views(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Detail rows, certificate rows, rows of an unknown view."""
    known, unknown = split_by(rows, F.col("view").isin(DETAIL, CERTIFICATE))
    return known.where(F.col("view") == DETAIL), known.where(F.col("view") == CERTIFICATE), unknown
