"""Order tables read as filings.

The test tables are orders, line items and customers, not filings. These readers
reshape whole tables: an order fetched successfully is a detail view, an order's
line items together are its certificate view. Raw text keeps the noise that real
pages carry (tags, padding, mixed date formats), so that cleaning has work to do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartouche.constants import CERTIFICATE, DETAIL
from cartouche.functions.ids import build_filing_id

DESCRIPTIONS = {
    "STANDARD": "table wine",
    "ECONOMY": "pale ale",
    "MEDIUM": "lager beer",
    "PROMO": "gift pack",
    "LARGE": "rum and whiskey",
    "SMALL": "grape spirit",
}
STATUSES = {"F": "APPROVED", "O": "PENDING", "P": "SURRENDERED"}
CERTIFICATE_TYPES = {1: "CERTIFICATE OF LABEL APPROVAL", 2: "CERTIFICATE OF EXEMPTION", 3: "DISTINCTIVE LIQUOR BOTTLE"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(c: Column, options: dict, other: str | None = None) -> Column:
    items = list(options.items())
    chain = reduce(lambda acc, kv: acc.when(c == kv[0], F.lit(kv[1])), items[1:], F.when(c == items[0][0], F.lit(items[0][1])))
    return chain.otherwise(F.lit(other))


def id_parts(key: Column) -> dict[str, Column]:
    """Spread a whole number over the parts of a filing id; different numbers give different ids."""

    def over(n: int) -> Column:
        return ((key - key % n) / n).cast("bigint")

    return {"year": over(4 * 366) % 100, "day": over(4) % 366 + 1, "method": key % 4, "sequence": over(4 * 366 * 100) + 1}


def filing_id(key: Column) -> Column:
    p = id_parts(key)
    return build_filing_id(p["year"], p["day"], p["method"], p["sequence"])


def _identity(key: Column, view: str) -> list[Column]:
    p = id_parts(key)
    return [
        filing_id(key).alias("filing_id"),
        F.lit(view).alias("view"),
        p["sequence"].cast("int").alias("sequence"),
        p["method"].cast("int").alias("receipt_method"),
    ]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: numeric aggregates only, so map tasks combine in hash tables."""
    flag = choose(F.col("l_returnflag"), {"A": 1, "N": 2, "R": 3})
    ship = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("first_part"),
        F.min("l_suppkey").alias("first_supp"),
        F.min(ship).alias("first_ship"),
        F.max(ship).alias("last_ship"),
        F.max(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("finished"),
        F.max(flag.cast("int")).alias("flag"),
    )


def detail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted detail rows, uncleaned. ``status_code`` is 404 where no priority was recorded."""
    place = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf_dir, "customer").join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    # the exchange a sort-merge join with the lines needs anyway, also taken when the lines are broadcast:
    # the text columns below are then built by all tasks, however few files hold the orders
    orders = table(spark, sf_dir, "orders").repartition("o_orderkey")
    lines = order_lines(spark, sf_dir).select("l_orderkey", "first_part", "first_ship", "last_ship")
    part = table(spark, sf_dir, "part")
    joined = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(part, F.col("first_part") == F.col("p_partkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    key, cust = F.col("o_orderkey"), F.col("c_custkey")
    return joined.select(
        *_identity(key, DETAIL),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 404).otherwise(200).alias("status_code"),
        F.col("o_orderdate").cast("date").alias("partition_date"),
        choose(F.col("o_orderstatus"), STATUSES).alias("status"),
        F.format_string("%06d", key).alias("serial_number"),
        F.col("o_custkey").cast("string").alias("vendor_code"),
        F.col("p_type").alias("class_type_code"),
        F.col("n_name").alias("origin_code"),
        F.concat(F.lit("  <b>"), F.col("p_brand"), F.lit("</b> ")).alias("brand_name"),
        F.concat(F.col("p_name"), F.lit("  ")).alias("fanciful_name"),
        F.concat(choose(F.col("p_type"), DESCRIPTIONS), F.lit("  "), F.col("p_name")).alias("product_description"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("\t")).alias("applicant_business_name"),
        F.concat(F.col("c_mktsegment"), F.lit(" Street, <i>"), F.col("n_name"), F.lit("</i>,\n"), F.col("r_name")).alias(
            "applicant_mailing_address"
        ),
        F.when(
            F.col("c_acctbal") >= 0, F.format_string("%03d.%03d.%04d", F.col("c_nationkey") + 200, cust % 1000, cust % 10000)
        ).otherwise("").alias("applicant_phone"),
        F.when(
            F.col("c_mktsegment") != "MACHINERY",
            F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com ")),
        ).alias("applicant_email"),
        F.lit(None).cast("string").alias("applicant_fax"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("filing_date"),
        F.date_format("first_ship", "yyyy-MM-dd").alias("approval_date"),
        F.date_format("last_ship", "MMMM d, yyyy").alias("expiration_date"),
        F.concat(F.col("p_size").cast("string"), F.lit(".5% alcohol by volume")).alias("alcohol_content"),
        choose(F.col("p_size") % 4, {0: "750 ML", 1: "12 fl oz / 12 OZ", 2: "1.75 L"}, "one bottle").alias("net_contents"),
    )


def certificate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted certificate rows, uncleaned: one per order that has line items."""
    key, supp = F.col("l_orderkey"), F.col("first_supp")
    approved = F.col("finished") == 1
    word = F.when(approved, "APPROVED").otherwise("SURRENDERED")
    return order_lines(spark, sf_dir).select(
        *_identity(key, CERTIFICATE),
        F.col("first_ship").alias("partition_date"),
        F.format_string("%06d", key).alias("serial_number"),
        F.concat(F.lit("C"), key.cast("string")).alias("certificate_number"),
        F.concat(F.lit("<em>"), word, F.lit("</em>")).alias("certificate_status"),
        F.concat(F.lit(" "), choose(F.col("flag"), CERTIFICATE_TYPES)).alias("certificate_type"),
        F.concat(F.lit("THE STATUS IS "), word, F.lit(".")).alias("status"),
        F.date_format("first_ship", "MM-dd-yyyy").alias("application_date"),
        F.date_format("last_ship", "MMM d, yyyy").alias("approval_date"),
        F.concat(F.lit("DC-I-"), supp.cast("string")).alias("plant_registry_number"),
        F.concat(F.lit("Supplier  "), supp.cast("string")).alias("applicant_business_name"),
        F.concat(F.lit("Dock "), supp.cast("string"), F.lit(" North Road")).alias("applicant_mailing_address"),
        F.format_string("1 (555) %03d-%04d", supp % 1000, supp % 10000).alias("applicant_phone"),
        F.concat(F.lit("dock"), supp.cast("string"), F.lit("@example.org")).alias("applicant_email"),
        F.lit(None).cast("string").alias("applicant_fax"),
        F.concat(F.lit("VALLEY "), supp.cast("string")).alias("wine_appellation"),
        (F.col("flag") >= 2).alias("applicant_signature_present"),
        approved.alias("authorized_signature_present"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as fetch attempts: an error event is a failed attempt; ids count up in time."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("partition_date"),
        (F.col("user_id") % 4).cast("int").alias("receipt_method"),
        F.when(F.col("event_type").isin("click", "view"), DETAIL)
        .when(F.col("event_type").isin("purchase", "signup"), CERTIFICATE)
        .when(F.col("value") < 10, DETAIL)
        .otherwise(CERTIFICATE)
        .alias("view"),
        F.col("event_id").alias("sequence"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status_code"),
    )


def reference_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types as class codes, nations as origin codes; the stamp is the latest order day."""
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    classes = part.select(
        F.col("p_type").alias("code"),
        choose(F.col("p_type"), DESCRIPTIONS).alias("description"),
        F.lit("product_class_type").alias("kind"),
    ).distinct()
    origins = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("code"),
        F.concat(F.lit("Goods of "), F.col("r_name")).alias("description"),
        F.lit("origin_code").alias("kind"),
    )
    stamp = table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("date").cast("timestamp").alias("extracted_at"))
    return classes.unionByName(origins).withColumn("extracted_at", stamp.scalar())


# --- landed pages rendered from the same rows ----------------------------------


def _cells(*texts) -> Column:
    parts = []
    for t in texts:
        parts += [F.lit("<td>"), F.lit(t) if isinstance(t, str) else F.coalesce(t, F.lit("")), F.lit("</td>")]
    return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>\n"))


def _bold(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"<strong>{label}</strong>&nbsp; "), F.coalesce(value.cast("string"), F.lit("")))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages as a site would serve them, one per detail row."""
    raw = detail_raw(spark, sf_dir)
    c = F.col
    html = F.concat(
        F.lit("<html><!-- <td><strong>Status:</strong> draft</td> --><body><p><strong>Type of Application:</strong> LABEL APPROVAL</p><table>"),
        _cells(_bold("TTB ID:", c("filing_id")), _bold("Status:", c("status"))),
        _cells(F.concat(F.lit("<p>"), _bold("Vendor Code:", c("vendor_code")), F.lit("</p>")), _bold("Serial #:", c("serial_number"))),
        _cells(_bold("Class/Type Code:", c("class_type_code")), _bold("Origin Code:", c("origin_code"))),
        _cells(_bold("Brand Name:", c("brand_name")), _bold("Fanciful Name:", c("fanciful_name"))),
        _cells(_bold("For Sale In:", F.lit(None)), _bold("Formula :", F.lit(None))),
        _cells(_bold("Approval Date:", c("approval_date")), _bold("Grape Varietal(s):", F.concat(F.lit("VINE "), c("vendor_code")))),
        _cells(_bold("Total Bottle Capacity:", F.concat(c("serial_number"), F.lit(" ml"))), _bold("Wine Vintage:", F.year("partition_date"))),
        _cells(_bold("Plant Registry/Basic Permit/Brewers No (Other):", F.lit("BW-9"))),
        F.lit("</table><table>"),
        _cells(F.concat(F.lit("DC-I-"), c("vendor_code"))),
        _cells(F.concat(c("applicant_business_name"), F.lit(" &amp; Sons"))),
        _cells(c("applicant_mailing_address")),
        _cells(F.lit("UNIT &#55;")),
        _cells("Contact Information:"),
        _cells("ROY  CLOUD"),
        _cells(F.concat(F.lit("Phone Number: ("), F.lpad(c("vendor_code"), 3, "0"), F.lit(") 555-0100"))),
        _cells("Fax", "main desk", F.concat(F.lit("("), F.lpad(c("vendor_code"), 3, "0"), F.lit(") 555-0199"))),
        F.lit("</table><table><tr><td><strong>Qualifications:</strong> Filed "),
        c("filing_date"),
        F.lit(" as is. Caf&eacute; &#x2014; &#128512; &lsqb;1&rsqb; &Zcaron; &#150; &copy 2</td></tr></table></body></html>"),
    )
    return raw.select("filing_id", "view", "sequence", "receipt_method", "partition_date", "status_code", html.alias("html"))


def _field(number: int, label: str, value: Column) -> Column:
    return F.concat(
        F.lit(f'<td><div class="boldlabel">{number}. {label}</div><div class="data">'),
        F.coalesce(value.cast("string"), F.lit("")),
        F.lit("</div></td>"),
    )


def certificate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = certificate_raw(spark, sf_dir)
    c = F.col
    box = lambda on: F.when(on, "checked").otherwise("unchecked")
    html = F.concat(
        F.lit('<html><body><div class="data">'), c("filing_id"), F.lit("</div><table><tr>"),
        F.lit('<td><div class="label">CT</div><div class="data">81</div></td>'),
        F.lit('<td><div class="label">OR</div><div class="data">51</div></td></tr><tr>'),
        _field(2, "PLANT REGISTRY", c("plant_registry_number")),
        _field(4, "SERIAL NUMBER", c("serial_number")),
        _field(11, "WINE APPELLATION", c("wine_appellation")),
        _field(12, "PHONE NUMBER", c("applicant_phone")),
        _field(13, "EMAIL", F.lit("")),
        F.lit("</tr><tr>"),
        _field(16, "DATE OF APPLICATION", c("application_date")),
        _field(17, "SIGNATURE OF APPLICANT", F.lit("(Application was e-filed)")),
        _field(19, "DATE ISSUED", c("approval_date")),
        F.lit('</tr><tr><td><img src="/box.gif" alt="'), box(c("applicant_signature_present")), F.lit('"> Domestic</td>'),
        F.lit('<td><img src="/box.gif" alt="'), box(~c("applicant_signature_present")), F.lit('"> Imported</td>'),
        F.lit('<td><img src="/box.gif" alt="'), box(c("authorized_signature_present")), F.lit('"> WINE</td></tr><tr>'),
        *[part for words, on in (
            ("DISTILLED SPIRITS", c("applicant_signature_present")), ("MALT BEVERAGE", F.lit(False)),
            *[(words, F.trim("certificate_type") == words) for words in ("CERTIFICATE OF LABEL APPROVAL", "CERTIFICATE OF EXEMPTION")],
            ("DISTINCTIVE LIQUOR BOTTLE APPROVAL", c("certificate_type").contains("DISTINCTIVE")),
            ("RESUBMISSION AFTER REJECTION", ~c("authorized_signature_present")),
        ) for part in (F.lit('<td><img src="/box.gif" alt="'), box(on), F.lit(f'"> {words}</td>'))],
        F.lit("</tr>"),
        F.lit("<tr><td><div>8. NAME AND ADDRESS OF APPLICANT</div>(Required)<br>"),
        c("applicant_business_name"), F.lit("<br>"), c("applicant_mailing_address"), F.lit("<br>Harbour</td></tr>"),
        F.lit('<tr><td><img src="/publicViewAttachment.do?filename=front '), c("serial_number"),
        F.lit('.jpg&amp;filetype=l" alt="Label Image: Brand (front)" width="308" height="356"> 3.2 inches W X 3.7 inches H</td>'),
        F.lit('<td><img src="/publicViewAttachment.do?filename=back.jpg" alt="Label Image: Back"></td></tr>'),
        F.lit('<tr><td>'), c("status"), F.lit("</td><td>TABLE RED WINE</td></tr><tr><td>"),
        F.when(c("authorized_signature_present"),
               F.lit('<img src="/publicViewSignature.do?id=1" width="193" height="49">')).otherwise(""),
        F.lit("</td></tr></table></body></html>"),
    )
    return raw.select("filing_id", "view", "sequence", "receipt_method", "partition_date",
                      F.lit(200).alias("status_code"), html.alias("html"))


def supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as filings landed over 25 days: a detail page each, and a certificate page for those not in debt."""
    c, fid = F.col, filing_id(F.col("s_suppkey"))
    detail = F.concat(
        F.lit("<html><body><p><strong>Status:</strong> APPROVED</p><table><tr><td><strong>TTB ID:</strong> "), fid,
        F.lit("</td><td><strong>Brand Name:</strong> "), c("s_name"), F.lit(" &amp Sons</td></table><table><tr><td>DC-I-"), c("s_nationkey").cast("string"),
        F.lit("</td></tr><tr><td>"), c("s_name"), F.lit("</td></tr><tr><td>Contact Information:</td></tr></table></body></html>"))
    certificate = F.concat(
        F.lit('<html><body><div class="data">'), fid, F.lit("</div><table><tr>"), _field(4, "SERIAL NUMBER", c("s_suppkey")),
        F.lit("</tr><tr><td>THE STATUS IS APPROVED&period;</td></tr></table></body></html>"))
    views = F.array(F.struct(F.lit(DETAIL).alias("view"), detail.alias("html")), F.struct(F.lit(CERTIFICATE).alias("view"), certificate.alias("html")))
    rows = table(spark, sf_dir, "supplier").select(
        fid.alias("filing_id"), F.date_add(F.lit("2024-01-01").cast("date"), c("s_nationkey").cast("int")).alias("partition_date"),
        id_parts(c("s_suppkey"))["method"].cast("int").alias("receipt_method"),
        F.explode(F.filter(views, lambda v: (v["view"] == DETAIL) | (c("s_acctbal") >= 0))).alias("page"))
    return rows.select("filing_id", "partition_date", "receipt_method", "page.view", "page.html")
