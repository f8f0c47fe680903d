"""Operators on small fixtures, brute force and edge cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartouche.constants import CERTIFICATE, DETAIL
from cartouche.operators import checks, clean, dims, extract, lookup, merge, ordered, upsert
from cartouche.sources import files, grids, scratch
from cartouche.streaming import ingest, monitor

LOG = "g string, sequence bigint, success boolean"


def brute_cutoff(rows, n):
    run = 0
    for seq, ok in sorted(rows):
        run = 0 if ok else run + 1
        if run == n:
            return seq
    return None


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_cutoffs_against_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(f"g{g}", s, rng.random() < 0.3 + 0.1 * (g % 4)) for g in range(12) for s in sorted(rng.sample(range(200), 60))]
    got = {r["g"]: r["cutoff"] for r in ordered.failure_cutoffs(spark.createDataFrame(rows, LOG), ["g"], 4, block).collect()}
    assert got == {g: brute_cutoff([(s, ok) for h, s, ok in rows if h == g], 4) for g in got}


@pytest.mark.parametrize("failures,kept", [(9, 10), (10, 11), (11, 11)])
def test_threshold_of_ten(spark, failures, kept):
    rows = [("g", 0, True)] + [("g", i + 1, False) for i in range(failures)]
    assert ordered.keep_until_failures(spark.createDataFrame(rows, LOG), ["g"]).count() == kept


def test_rank_filter_limits_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = ordered.pick_first(frame, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_owner_keeps_every_id(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("o"), F.format_string("%05d", "id").alias("filing_id"))
    pairs = dims.source_ids(rows.union(rows.limit(5)), F.col("o")).where("owner_key = 1").collect()
    assert sorted(r["filing_id"] for r in pairs) == [f"{i:05d}" for i in range(2000)]


def test_facts_that_share_a_short_id_are_both_kept(spark):
    """The 32-bit id is an attribute: a merge of two filings with one such id keeps both."""
    old = spark.sql("SELECT 7L AS product_fact_id, '24001001000001' AS filing_id, DATE '2024-01-01' AS partition_date")
    new = spark.sql("SELECT 7L AS product_fact_id, '24001001000002' AS filing_id, DATE '2024-01-02' AS partition_date")
    merged = upsert.upsert_table(old, new.union(old), "fact_products")
    assert sorted(r["filing_id"] for r in merged.collect()) == ["24001001000001", "24001001000002"]


def test_sequences_are_not_clipped(spark):
    days = spark.sql("SELECT DATE '2024-01-01' AS date")
    got = grids.candidate_ids(days, [1], 999_998, 1_000_001).select("sequence", "filing_id").orderBy("sequence").collect()
    assert [r["sequence"] for r in got] == list(range(999_998, 1_000_002))
    assert [len(r["filing_id"]) for r in got] == [14, 14, 15, 15]


def views(spark):
    detail = spark.createDataFrame(
        [("1", DETAIL, "A", "", "2024-01-01", "2024-01-11", "b", "ale"), ("2", DETAIL, None, "9", "2024-01-01", None, "b", None)],
        "filing_id string, view string, applicant_business_name string, applicant_phone string, filing_date string, approval_date string, brand_name string, product_description string",
    ).withColumns({"applicant_mailing_address": F.lit("x"), "applicant_email": F.lit(None).cast("string"), "applicant_fax": F.lit(None).cast("string")})
    certificate = spark.createDataFrame(
        [("1", CERTIFICATE, "C", "5", "2024-02-01", "OK"), ("3", CERTIFICATE, "D", "6", "2024-02-02", "OK")],
        "filing_id string, view string, applicant_business_name string, applicant_phone string, approval_date string, status string",
    ).withColumns({"applicant_mailing_address": F.lit("y"), "applicant_email": F.lit("e"), "applicant_fax": F.lit("f")})
    return detail, certificate


def test_merge_cases(spark):
    rows = {r["filing_id"]: r for r in merge.merge_views(*views(spark)).collect()}
    both, alone, cert = rows["1"], rows["2"], rows["3"]
    assert (both["applicant_business_name"], both["applicant_phone"], both["applicant_email"]) == ("A", "5", "e")
    assert (both["cert_approval_date"], both["cert_status"], both["status"]) == ("2024-02-01", "OK", None)
    assert (both["days_to_approval"], both["product_category"], both["data_completeness_score"]) == (10, "BEER", 1.0)
    assert (alone["has_certificate"], alone["cert_status"], alone["days_to_approval"]) == (False, None, None)
    assert (cert["status"], cert["cert_status"], cert["approval_date"], cert["cert_approval_date"]) == ("OK", None, "2024-02-02", "2024-02-02")
    assert cert["data_completeness_score"] == 1.0 and cert["product_category"] is None


def test_rejects_are_not_lost(spark):
    frame = spark.createDataFrame([("1", "v"), ("", "v"), (None, "v"), ("2", None)], "filing_id string, view string")
    good, bad = clean.identified(frame)
    assert good.count() == 1 and bad.count() == 3


@pytest.mark.parametrize("ok,total,passed,severity", [(98, 100, True, None), (90, 100, True, "WARN"), (80, 100, False, "ERROR"), (0, 0, False, "WARN")])
def test_parsing_thresholds(spark, ok, total, passed, severity):
    frame = spark.range(total).select((F.col("id") < ok).alias("parsing_success"))
    row = checks.parsing_success(frame).first()
    assert (row["passed"], row["severity"]) == (passed, severity)


def test_empty_tables_warn(spark):
    empty = spark.createDataFrame([], "company_id bigint, product_id bigint, final_quality_score double, filing_date date, approval_date date, has_detail_data boolean, has_certificate_data boolean, status string")
    row = checks.fact_integrity(empty).first()
    assert (row["passed"], row["severity"], row["issues"]) == (False, "ERROR", [])


def test_code_lists(spark):
    ref = spark.createDataFrame([("80", "WINE", "product_class_type", "2024-01-01"), ("81", "WINE", "product_class_type", "2024-01-02"), ("51", "FRANCE", "origin_code", "2024-01-01")],
                                "code string, description string, kind string, extracted_at string").withColumn("extracted_at", F.col("extracted_at").cast("timestamp"))
    frame = spark.createDataFrame([(" 80 ",), ("XX",), ("",), (None,)], "c string")
    got = [(r["v"]["is_valid"], r["v"]["validation_error"]) for r in lookup.validate_product_class(frame, "c", ref, output="v").orderBy(F.col("c").desc()).collect()]
    assert (True, None) in got and (False, "Unknown product class type code: XX") in got and got.count((False, "Empty value")) == 2
    assert lookup.codes_by_description(ref, "product_class_type").first()["code"] == "81"


# --- pages written to parse to the published samples -----------------------------

BEER = """<html><body><table>
<tr><td><STRONG>TTB ID:</STRONG> 23001001000001</td><td><strong>Status:</strong> APPROVED</td><td><strong>Vendor Code:</strong>&nbsp;50197</td></tr>
<tr><td><strong>Serial #:</strong> 23TRIP</td><td><strong>Class/Type Code:</strong> BEER</td><td><strong>Origin Code:</strong> NEW YORK</td></tr>
<tr><td><strong>Brand Name:</strong> PARADOX BREWERY</td><td><strong>Fanciful Name:</strong>
 TIPPLE   TRIPEL</td><td><strong>Type of Application:</strong> LABEL APPROVAL</td></tr>
<tr><td><strong>For Sale In:</strong> </td><td>x <strong>Wine Vintage:</strong> 1999</td><td><strong>Approval Date:</strong> 01/09/2023</td></tr>
<tr><td>Phone: (518) 857-3024</td></tr></table>
<table><tr><td><strong>Qualifications:</strong> It is &quot;certified&quot; &#38; kept.</td></tr></table></body></html>"""


def test_beer_page(spark):
    row = extract.detail_fields(spark.createDataFrame([(BEER,)], "html string")).first()
    expected = {
        "filing_id": "23001001000001", "status": "APPROVED", "vendor_code": "50197", "serial_number": "23TRIP",
        "class_type_code": "BEER", "origin_code": "NEW YORK", "brand_name": "PARADOX BREWERY", "fanciful_name": "TIPPLE TRIPEL",
        "type_of_application": "LABEL APPROVAL", "approval_date": "01/09/2023", "for_sale_in": None, "wine_vintage": None,
        "applicant_phone": "(518) 857-3024", "contact_phone_area_code": "518", "applicant_business_name": None,
        "plant_registry_number": None, "qualifications": 'It is "certified" & kept.', "parsing_success": True,
    }
    assert {k: row[k] for k in expected} == expected


CERT = """<html><body><div class="data">24001001000001</div><table><tr>
<td><div class="label">CT</div><div class="data">81</div></td><td><div class="label">OR</div><div class="data"> 51 </div></td></tr>
<tr><td><div class="boldlabel">6. BRAND NAME</div><div class="data">DOMAINE JOURDAN</div></td>
<td><div class="boldlabel">16. DATE</div><div class="data">01/01/2024</div></td>
</tr><tr><td class="label">13. EMAIL</td><td><div class="data"></div></td></tr>
<tr><td><img alt="unchecked"> </td><td>Domestic</td></tr><tr><td><img alt="Checked"> Imported</td></tr>
<tr><td>8. NAME AND ADDRESS OF APPLICANT <b>(Required)</b><br>Vintage '59 Imports LLC<br>2800 JENNIFER ST , NW</td></tr>
<tr><td>THE STATUS IS APPROVED.</td><td>DISTILLED SPIRITS</td><td>TABLE WHITE WINE</td></tr></table></body></html>"""


def test_certificate_page(spark):
    row = extract.certificate_fields(spark.createDataFrame([(CERT,)], "html string")).first()
    assert (row["filing_id"], row["brand_name"], row["application_date"], row["applicant_email"]) == ("24001001000001", "DOMAINE JOURDAN", "01/01/2024", "")
    assert tuple(row["codes"]) == ("81", "51") and row["source_of_product"] == {"domestic": False, "imported": True}
    assert (row["applicant_business_name"], row["applicant_mailing_address"]) == ("Vintage '59 Imports LLC", "2800 JENNIFER ST , NW")
    assert (row["status"], row["class_type_code"]) == ("THE STATUS IS APPROVED.", "DISTILLED SPIRITS")
    assert row["label_images"] == [] and row["signatures"]["present"] is False and row["serial_number"] is None


def test_unknown_view_is_an_error(spark):
    pages = spark.createDataFrame([("x", "other"), (BEER, DETAIL)], "html string, view string")
    rows, rejects = extract.extract(pages)
    assert rows.count() == 1 and rejects.first()["extraction_errors"] == ["Unknown data type: other"]


# --- files and streams -----------------------------------------------------------


def test_landed_html_scan(spark, tmp_path):
    folder = tmp_path / f"view={DETAIL}" / "partition_date=2024-01-02" / "receipt_method=1"
    folder.mkdir(parents=True)
    (folder / "24002001000007.html").write_text("<p>a\nb</p>")
    row = files.scan_landed_html(spark, str(tmp_path)).first()
    assert (row["filing_id"], row["html"], row["size_bytes"], row["view"], row["receipt_method"]) == ("24002001000007", "<p>a\nb</p>", 10, DETAIL, 1)


def test_partition_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(r, "x int, d string")
    assert files.write_parquet(rows((1, "a"), (2, "b")), path, partition_by=["d"])["total_rows"] == 2
    files.write_parquet(rows((3, "b")), path, partition_by=["d"])
    assert sorted((r["x"], r["d"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]
    assert files.file_stats(spark, path).first()["files_written"] == 2


def test_json_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2, "b": "x"}]')
    assert sorted(tuple(r) for r in files.scan_json(spark, str(tmp_path), "a INT, b STRING").collect()) == [(1, None), (2, "x")]


def test_landed_batches_merge_by_key(spark):
    """A batch that ran twice counts once; the last batch of a key wins."""
    path = scratch.fresh_path(spark, "batches")
    for batch, low in ((0, 0), (1, 2), (1, 2)):
        spark.range(low, low + 3).select("id", F.lit(batch).alias("v")).write.mode("overwrite").parquet(f"{path}/batch={batch}")
    schema = spark.range(0).select("id", F.lit(0).alias("v")).schema
    ingest.compact(spark, path, path + "-whole", schema, ["id"])
    assert sorted(tuple(r) for r in spark.read.parquet(path + "-whole").collect()) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 1)]


def test_alerts(spark):
    t = dt.datetime(2024, 1, 1, 5)
    runs = [(t + dt.timedelta(minutes=i, hours=h), ok, not ok) for h, oks in enumerate([[1] * 3, [1, 1, 0, 1], [1, 1, 0, 0, 0]]) for i, ok in enumerate(map(bool, oks))]
    frame = spark.createDataFrame(runs, "ts timestamp, is_success boolean, is_failure boolean")
    got = sorted((r["type"], r["severity"]) for r in monitor.health_alerts(monitor.run_health(frame)).collect())
    assert got == [("low_success_rate", "high"), ("run_failures", "high"), ("run_failures", "medium")]


@pytest.mark.parametrize("today,first,last", [("2024-06-01", "2024-05-30", "2023-06-02"), ("2015-06-01", "2015-05-30", "2015-01-01"), ("2015-01-02", "2014-12-31", "2015-01-01")])
def test_backfill_range(spark, today, first, last):
    row = spark.range(1).select(*ordered.backfill_range(F.lit(today).cast("date"))).first()
    assert (str(row[0]), str(row[1])) == (first, last)
