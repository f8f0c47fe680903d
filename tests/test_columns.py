"""Column functions on literal rows, with null, '', no-break spaces and two-digit years."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartouche.functions import classify, dates, ids, lenient, numbers, score, text
from cartouche.registry import TransformRegistry, registry, rules_for
from cartouche.schemas import schemas


def run(spark, fn, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in frame.select("i", fn(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


CASES = [
    (text.clean_text, [" <b>A</b>  b\r\n", None, "", "a  b"], ["A b", "", "", "a b"]),
    (lambda c: text.clean_text(c, normalize_spaces=False), ["a  b\r\nc\rd"], ["a  b\nc\nd"]),
    (text.page_text, ["  x&nbsp;y \n"], ["x y"]),
    (text.extract_numbers, ["1.5 and 20.", None], [["1.5", "20."], []]),
    (lambda c: text.extract_numbers(c, include_decimals=False), ["1.5"], [["1", "5"]]),
    (text.clean_phone, ["202.966.9218", "1 (202) 966-9218", "12345", None], ["(202) 966-9218", "1-(202) 966-9218", "12345", ""]),
    (text.normalize_address, ["12 north  Main Street", "Northern Streets", None], ["12 N MAIN ST", "NORTHERN STREETS", ""]),
    (text.extract_zip_code, ["DC 20015-1234 x", "123456", "a 20015.", None], ["20015-1234", None, "20015", None]),
    (text.normalize_state, [" tx ", "New York", "Ohio", "", None], ["TX", "NY", "OHIO", None, None]),
    (text.is_email, ["a.b@c.org ", "a@b", None], [True, False, False]),
    (text.is_url, ["HTTP://x.org/a", "ftp://x", "http://xy z", None], [True, False, False, False]),
    (
        dates.parse_flexible_date,
        ["1/9/2023", "01-09-2023", "2023-01-09", "JANUARY 9, 2023", "Jan 9, 2023", "01/09/23", "1-9-70", "13/45/2023", "", None, "2023-1-9 x"],
        [dt.date(2023, 1, 9)] * 6 + [dt.date(1970, 1, 9), None, None, None, None],
    ),
    (dates.parse_legacy_date, ["2023-01-09 10:11:12", "01/09/2023", "01-09-2023"], [dt.date(2023, 1, 9)] * 2 + [None]),
    (numbers.parse_decimal, ["$1,234.565", "0.125", "1-2", "", None, "-3.5"], [Decimal("1234.56"), Decimal("0.12"), None, None, None, Decimal("-3.50")]),
    (numbers.parse_percentage, ["0.125%", "1 %", "12.5", "-3"], [Decimal("12.00"), Decimal("100.00"), Decimal("12.50"), Decimal("-300.00")]),
    (numbers.extract_alcohol_content, ["5% sugar 12.5% ABV", "Alcohol: 7", "9 %", "none", None], [Decimal("12.5000"), Decimal("7"), Decimal("9"), None, None]),
    (numbers.standardize_container_size, ["1750 ML", "33 l", "12oz", "2 gallons", "5", None], ["750ml", "3L", "12oz", "2gallon", None, None]),
    (classify.beverage_type, ["sale", "Original", "cider", "water", "", None], ["BEER", "SPIRITS", "OTHER_FERMENTED", "UNKNOWN", None, None]),
    (classify.product_category, ["Winery", "gin", None], ["WINE", "OTHER", None]),
    (ids.partition_key, ["23001001000001", "31001001000001", "23367001000001", "x"], ["2023-001-001", "1931-001-001", None, None]),
    (lambda c: ids.parse_filing_id(c)["error"], ["2300100100000", "23000001000001", "23001004000001", "23001001000000", None],
     ["format", "julian_day", "receipt_method", "sequence", "format"]),
    (ids.is_filing_id, [" 23001001000001 ", "2300100100000a", None], [True, False, False]),
    (dates.iso_date, ["2024-01-02", "2024-1-2", "2024-01-02T03:04:05", "2024-13-01"], [dt.date(2024, 1, 2), None, dt.date(2024, 1, 2), None]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_column(spark, case):
    fn, values, expected = CASES[case]
    assert run(spark, fn, values) == expected


def test_round_trip_of_ids(spark):
    built = spark.range(1).select(
        ids.build_filing_id(F.lit(2023), F.lit(9), F.lit(1), F.lit(42)).alias("a"),
        ids.build_filing_id(F.lit(2023), F.lit(9), F.lit(1), F.lit(1234567)).alias("b"),
        ids.short_key(F.lit("x|y")).alias("k"),
        dates.from_day_of_year(F.lit(2023), F.lit(366)).alias("none"),
        dates.from_day_of_year(F.lit(2024), F.lit(366)).alias("last"),
    ).first()
    import hashlib

    assert built["a"] == "23009001000042" and built["b"] == "230090011234567"
    assert built["k"] == int(hashlib.md5(b"x|y").hexdigest()[:8], 16)
    assert built["none"] is None and built["last"] == dt.date(2024, 12, 31)


def test_lenient_cast(spark):
    frame = spark.createDataFrame([("On", "-12 a", "x1.5y", "2024-01-02", ""), ("no", "", "z", "2024-1-2", None)], "a string, b string, c string, d string, e string")
    target = schemas.get("reference_code").__class__.fromDDL("a BOOLEAN, b INT, c DOUBLE, d DATE, e STRING")
    from cartouche.operators.structure import project_to_schema

    rows = [tuple(r) for r in project_to_schema(frame, target).collect()]
    assert rows == [(True, 12, 1.5, dt.date(2024, 1, 2), None), (False, None, None, None, None)]
    errors = frame.select(lenient.is_type_error(F.col("e"), frame.schema["e"].dataType, frame.schema["e"].dataType)).collect()
    assert [r[0] for r in errors] == [True, False]  # '' converts to null and counts as an error


def test_registry(spark):
    assert {"clean_text", "parse_date", "validate_product_class"} <= set(registry.available())
    with pytest.raises(KeyError):
        registry.apply("nothing", F.lit(1))
    own = TransformRegistry()
    own.register("twice", lambda c, times=2: F.repeat(c, times))
    frame = spark.createDataFrame([("ab",)], "x string")
    rules = {"x": [{"transform": "twice", "times": 3}, {"transform": "twice"}], "absent": [{"transform": "twice"}]}
    assert own.apply_rules(frame, rules).first()[0] == "ab" * 6
    assert rules_for("other") == {}


def test_tier_drops_one_step(spark):
    rows = [("1", "n", "a", "b", "d", "2024-01-01", True, True, 1.0), ("1", "n", "a", "b", "d", "2024-01-01", False, True, 1.0),
            ("1", "n", "a", None, "d", "x", True, True, 0.75), ("1", "n", "a", "b", "d", "x", True, True, 0.6)]
    frame = spark.createDataFrame(rows, "filing_id string, applicant_business_name string, applicant_mailing_address string, cola_brand_name string, "
                                  "cola_product_description string, cola_approval_date string, filing_id_valid boolean, product_class_validation_is_valid boolean, s double")
    assert [r[0] for r in frame.select(score.quality_tier(F.col("s"))).collect()] == ["premium", "standard", "basic", "basic"]
