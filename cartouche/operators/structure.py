"""Final standardisation, scoring, validation and schema projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.constants import STRUCTURED_DATES, STRUCTURED_FLAGS, STRUCTURED_NUMBERS, STRUCTURED_TEXT
from cartouche.functions import dates, score
from cartouche.functions.lenient import lenient_cast
from cartouche.functions.text import filled, strip, text


def standardize(frame: DataFrame) -> DataFrame:
    """Dates as DATE, flags as BOOLEAN, numbers as DOUBLE (bad text 0.0), id as text, text stripped."""
    fix: dict[str, Column] = {}
    for name in frame.columns:
        c, dtype = F.col(name), frame.schema[name].dataType
        if name in STRUCTURED_DATES:
            fix[name] = dates.iso_date(c) if isinstance(dtype, T.StringType) else c.cast("date")
        elif name in STRUCTURED_FLAGS:
            fix[name] = F.coalesce(c.try_cast("boolean"), F.lit(False))
        elif name in STRUCTURED_NUMBERS:
            fix[name] = F.when(c.isNotNull(), F.coalesce(c.try_cast("double"), F.lit(0.0)))
        elif name in STRUCTURED_TEXT:
            fix[name] = strip(c)
        elif name == "filing_id":
            fix[name] = text(c)
    return frame.withColumns(fix)


def validation(frame: DataFrame) -> Column:
    """STRUCT<is_valid, errors, warnings> of a structured row."""
    fid = F.col("filing_id")
    cert_columns = [c for c in frame.columns if c.startswith("cert_")]
    no_cert = F.lit(True) if not cert_columns else F.coalesce(*[text(F.col(c)) for c in cert_columns]).isNull()
    no_detail = F.col("brand_name").isNull() & F.col("product_description").isNull()
    warnings = [
        F.when(filled(fid) & ~fid.rlike("^[0-9]+$"), F.concat(F.lit("Filing ID format may be invalid: "), fid)),
        F.when(F.col("has_detail") & no_detail,
               F.lit("Record claims to have detail data but misses the typical detail fields")),
        F.when(F.col("has_certificate") & no_cert,
               F.lit("Record claims to have certificate data but misses cert_ fields")),
    ]
    for name in ("filing_date", "approval_date", "expiration_date"):
        if name in frame.columns and isinstance(frame.schema[name].dataType, T.StringType):
            c = F.col(name)
            warnings.append(F.when(filled(c) & dates.iso_date(c).isNull(),
                                   F.concat(F.lit(f"Invalid date format in {name}: "), c)))
    errors = F.array_compact(F.array(F.when(~filled(fid), F.lit("Missing required field: filing_id"))))
    return F.struct(
        filled(fid).alias("is_valid"),
        errors.alias("errors"),
        F.array_compact(F.array(*warnings)).alias("warnings"),
    )


def structure(merged: DataFrame) -> DataFrame:
    """Standardise, score and validate merged rows."""
    bonus = [c for c in merged.columns if c.endswith(("_transformed", "_validated"))]
    scored = merged.withColumn("final_quality_score", score.final_quality(len(bonus)))
    standard = standardize(scored)
    return standard.withColumn("schema_validation", validation(standard))


def project_to_schema(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the schema's fields only, absent ones null, each leniently cast."""
    have = {f.name: f.dataType for f in frame.schema.fields}
    return frame.select(*[
        (lenient_cast(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ])


def fill_to_schema(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """All schema columns in schema order; absent booleans false, other absent columns null."""
    have = set(frame.columns)

    def column(field: T.StructField) -> Column:
        if field.name in have:
            return F.col(field.name).cast(field.dataType)
        return F.lit(False if isinstance(field.dataType, T.BooleanType) else None).cast(field.dataType)

    return frame.select(*[column(f).alias(f.name) for f in schema.fields])
