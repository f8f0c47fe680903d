"""SQL twins of the catalog, for an independent engine on the same tables.

They state the expected values straight from the tables; none of the library's
expressions is reused.
"""

from __future__ import annotations


def fid(k: str) -> str:
    return (
        f"printf('%02d%03d%03d%06d', ((({k})//4)//366)%100, (({k})//4)%366+1, ({k})%4, ((({k})//4)//366)//100+1)"
    )


def key32(s: str) -> str:
    return f"CAST('0x' || substr(md5({s}),1,8) AS BIGINT)"


def date_id(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INT)"


SQUEEZE_SPACE = r"[\s\x{A0}\x{85}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B]+"


def squeeze(s: str) -> str:
    return f"trim(regexp_replace({s}, '{SQUEEZE_SPACE}', ' ', 'g'))"


def clean(s: str) -> str:
    return squeeze(f"regexp_replace({s}, '<[^>]+>', '', 'g')")


def percent(a: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN {a} * 100.0::DOUBLE / {n} ELSE 0.0 END"


def description(c: str) -> str:
    return (
        f"CASE {c} WHEN 'STANDARD' THEN 'table wine' WHEN 'ECONOMY' THEN 'pale ale' WHEN 'MEDIUM' THEN 'lager beer' "
        f"WHEN 'PROMO' THEN 'gift pack' WHEN 'LARGE' THEN 'rum and whiskey' WHEN 'SMALL' THEN 'grape spirit' END"
    )


def first_class(s: str, classes: list[tuple[str, str]], other: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower({s}), '{words}') THEN '{name}'" for name, words in classes)
    return f"CASE WHEN {s} IS NULL OR {s} = '' THEN NULL {whens} ELSE '{other}' END"


CATEGORY = [("WINE", "wine|vintner|winery"), ("BEER", "beer|ale|lager"), ("SPIRITS", "spirit|whiskey|vodka")]
BEVERAGE = [
    ("WINE", "wine|vintner|winery|grape"), ("BEER", "beer|brewery|ale|lager|stout"),
    ("SPIRITS", "spirit|whiskey|vodka|rum|gin|distillery"), ("OTHER_FERMENTED", "cider|mead|sake"),
]

DETAIL_ROWS = f"""
  SELECT {fid('o_orderkey')} AS filing_id, o_orderkey, CAST(o_orderdate AS DATE) AS partition_date,
    o_orderpriority <> '4-NOT SPECIFIED' AS fetched,
    CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'SURRENDERED' END AS status,
    printf('%06d', o_orderkey) AS serial_number, CAST(o_custkey AS VARCHAR) AS vendor_code,
    p_type AS class_type_code, n_name AS origin_code, coalesce(p_brand, '') AS brand_name,
    coalesce(p_name, '') AS fanciful_name, coalesce({description('p_type')} || ' ' || p_name, '') AS product_description,
    c_name AS applicant_business_name,
    c_mktsegment || ' ST, ' || n_name || ', ' || replace(r_name, 'EAST', 'E') AS applicant_mailing_address,
    CASE WHEN c_acctbal >= 0 THEN printf('(%03d) %03d-%04d', c_nationkey + 200, c_custkey % 1000, c_custkey % 10000)
      ELSE '' END AS applicant_phone,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(replace(c_name, '#', '.')) || '@example.com' ELSE '' END AS applicant_email,
    CAST(NULL AS VARCHAR) AS applicant_fax,
    CAST(o_orderdate AS DATE) AS filing_date, first_ship AS approval_date, last_ship AS expiration_date,
    p_size + 0.5::DOUBLE AS alcohol_content,
    CASE p_size % 4 WHEN 0 THEN '750ml' WHEN 1 THEN '12oz' WHEN 2 THEN '1.75l' END AS net_contents,
    c_custkey, c_mktsegment, n_name, r_name
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey LEFT JOIN part ON first_part = p_partkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
"""

BASE = f"""
WITH lines AS (
  SELECT l_orderkey, min(l_partkey) AS first_part, min(l_suppkey) AS first_supp,
    min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship,
    max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS finished,
    max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END) AS flag
  FROM lineitem GROUP BY l_orderkey),
detail_all AS ({DETAIL_ROWS}),
d AS (SELECT * FROM detail_all WHERE fetched),
c AS (
  SELECT {fid('l_orderkey')} AS filing_id, l_orderkey, first_ship AS partition_date, printf('%06d', l_orderkey) AS serial_number,
    'C' || l_orderkey AS certificate_number,
    CASE WHEN finished = 1 THEN 'APPROVED' ELSE 'SURRENDERED' END AS certificate_status,
    CASE flag WHEN 1 THEN 'CERTIFICATE OF LABEL APPROVAL' WHEN 2 THEN 'CERTIFICATE OF EXEMPTION'
      WHEN 3 THEN 'DISTINCTIVE LIQUOR BOTTLE' END AS certificate_type,
    'THE STATUS IS ' || CASE WHEN finished = 1 THEN 'APPROVED' ELSE 'SURRENDERED' END || '.' AS status,
    first_ship AS application_date, last_ship AS approval_date, 'DC-I-' || first_supp AS plant_registry_number,
    'Supplier ' || first_supp AS applicant_business_name, 'DOCK ' || first_supp || ' N RD' AS applicant_mailing_address,
    printf('1-(555) %03d-%04d', first_supp % 1000, first_supp % 10000) AS applicant_phone,
    'dock' || first_supp || '@example.org' AS applicant_email, CAST(NULL AS VARCHAR) AS applicant_fax,
    'VALLEY ' || first_supp AS wine_appellation, flag >= 2 AS applicant_signature_present,
    finished = 1 AS authorized_signature_present, first_supp, flag, finished
  FROM lines),
m0 AS (
  SELECT coalesce(d.filing_id, c.filing_id) AS filing_id, d.filing_id IS NOT NULL AS has_detail,
    c.filing_id IS NOT NULL AS has_certificate,
    CASE WHEN d.filing_id IS NULL THEN c.status ELSE d.status END AS status,
    CASE WHEN d.filing_id IS NULL THEN c.serial_number ELSE d.serial_number END AS serial_number,
    d.vendor_code, d.class_type_code, d.origin_code, d.brand_name, d.fanciful_name, d.product_description,
    CASE WHEN coalesce(d.applicant_business_name,'')='' AND coalesce(c.applicant_business_name,'')<>'' THEN c.applicant_business_name ELSE d.applicant_business_name END AS applicant_business_name,
    CASE WHEN coalesce(d.applicant_mailing_address,'')='' AND coalesce(c.applicant_mailing_address,'')<>'' THEN c.applicant_mailing_address ELSE d.applicant_mailing_address END AS applicant_mailing_address,
    CASE WHEN coalesce(d.applicant_phone,'')='' AND coalesce(c.applicant_phone,'')<>'' THEN c.applicant_phone ELSE d.applicant_phone END AS applicant_phone,
    CASE WHEN coalesce(d.applicant_email,'')='' AND coalesce(c.applicant_email,'')<>'' THEN c.applicant_email ELSE d.applicant_email END AS applicant_email,
    CAST(NULL AS VARCHAR) AS applicant_fax,
    d.filing_date, CASE WHEN d.filing_id IS NULL THEN c.approval_date ELSE d.approval_date END AS approval_date,
    d.approval_date AS detail_approval_date, d.expiration_date, d.alcohol_content, d.net_contents,
    CASE WHEN d.filing_id IS NOT NULL THEN c.status END AS cert_status,
    CASE WHEN d.filing_id IS NOT NULL THEN c.serial_number END AS cert_serial_number,
    CASE WHEN d.filing_id IS NOT NULL THEN c.applicant_business_name END AS cert_applicant_business_name,
    CASE WHEN d.filing_id IS NOT NULL THEN c.wine_appellation END AS cert_wine_appellation,
    CASE WHEN d.filing_id IS NOT NULL THEN c.applicant_signature_present END AS cert_applicant_signature_present,
    c.certificate_number AS cert_certificate_number, c.certificate_status AS cert_certificate_status,
    c.applicant_signature_present AS flat_signature,
    c.certificate_type AS cert_certificate_type, c.application_date AS cert_application_date, c.approval_date AS cert_approval_date,
    c.plant_registry_number AS cert_plant_registry_number,
    CASE WHEN d.filing_id IS NULL THEN c.partition_date ELSE d.partition_date END AS partition_date
  FROM d FULL OUTER JOIN c ON d.filing_id = c.filing_id),
m AS (
  SELECT *, (CASE WHEN coalesce(filing_id,'')<>'' THEN 1 ELSE 0 END + CASE WHEN coalesce(applicant_business_name,'')<>'' THEN 1 ELSE 0 END
      + CASE WHEN coalesce(applicant_mailing_address,'')<>'' THEN 1 ELSE 0 END
      + CASE WHEN has_detail AND coalesce(brand_name,'')<>'' THEN 1 ELSE 0 END
      + CASE WHEN has_detail AND coalesce(product_description,'')<>'' THEN 1 ELSE 0 END
      + CASE WHEN has_detail AND approval_date IS NOT NULL THEN 1 ELSE 0 END)
      / (CASE WHEN has_detail THEN 6.0::DOUBLE ELSE 3.0::DOUBLE END) AS data_completeness_score,
    CASE WHEN has_detail THEN CAST(approval_date - filing_date AS INT) END AS days_to_approval,
    {first_class('product_description', CATEGORY, 'OTHER')} AS product_category
  FROM m0),
s AS (
  SELECT *, data_completeness_score * 0.4::DOUBLE
    + CASE WHEN has_detail AND has_certificate THEN 0.3::DOUBLE WHEN has_detail OR has_certificate THEN 0.15::DOUBLE ELSE 0 END
    + (CASE WHEN coalesce(filing_id,'')<>'' THEN 1 ELSE 0 END + CASE WHEN coalesce(applicant_business_name,'')<>'' THEN 1 ELSE 0 END)
      / 2.0::DOUBLE * 0.1::DOUBLE AS final_quality_score,
    upper(trim(coalesce(applicant_business_name,''))) || '|' || upper(trim(coalesce(applicant_mailing_address,''))) AS ckey,
    upper(trim(coalesce(brand_name,''))) || '|' || upper(trim(coalesce(fanciful_name,''))) AS pkey,
    strftime(partition_date, '%Y-%m-%d') || filing_id AS ord
  FROM m),
companies AS (
  SELECT md5(ckey) AS company_key, {key32('ckey')} AS company_id,
    arg_min(applicant_business_name, ord) AS business_name, arg_min(coalesce(applicant_mailing_address,''), ord) AS mailing_address,
    coalesce(arg_min(applicant_phone, ord) FILTER (WHERE applicant_phone <> ''), '') AS phone,
    coalesce(arg_min(applicant_email, ord) FILTER (WHERE applicant_email <> ''), '') AS email, '' AS fax,
    min(partition_date) AS first_seen_date, max(partition_date) AS last_seen_date, count(*) AS total_applications,
    CAST(least(arg_min(30 + CASE WHEN length(applicant_business_name) > 5 THEN 10 ELSE 0 END
      + CASE WHEN coalesce(applicant_mailing_address,'') <> '' THEN 30 ELSE 0 END
      + CASE WHEN applicant_mailing_address LIKE '%,%' THEN 10 ELSE 0 END
      + CASE WHEN coalesce(applicant_phone,'') <> '' THEN 15 ELSE 0 END
      + CASE WHEN coalesce(applicant_email,'') <> '' THEN 15 ELSE 0 END, ord), 100) / 100.0 AS DECIMAL(5,3)) AS data_quality_score
  FROM s WHERE coalesce(applicant_business_name,'') <> '' GROUP BY ckey),
products AS (
  SELECT md5(pkey) AS product_key, {key32('pkey')} AS product_id, arg_min(brand_name, ord) AS brand_name,
    arg_min(fanciful_name, ord) AS fanciful_name, arg_min(product_description, ord) AS product_description,
    arg_min(class_type_code, ord) AS class_type_code, arg_min(origin_code, ord) AS origin_code,
    arg_min(coalesce(product_category,'OTHER'), ord) AS product_category, '' AS grape_varietals,
    arg_min(coalesce(cert_wine_appellation,''), ord) AS wine_appellation,
    CAST(arg_min(alcohol_content, ord) AS DECIMAL(5,2)) AS alcohol_content, arg_min(coalesce(net_contents,''), ord) AS net_contents,
    min(partition_date) AS first_seen_date, max(partition_date) AS last_seen_date, count(*) AS total_labels,
    CAST(arg_min(25 + CASE WHEN coalesce(class_type_code,'')<>'' THEN 20 ELSE 0 END + CASE WHEN coalesce(origin_code,'')<>'' THEN 15 ELSE 0 END
      + CASE WHEN coalesce(product_description,'')<>'' THEN 20 ELSE 0 END + CASE WHEN coalesce(net_contents,'')<>'' THEN 10 ELSE 0 END
      + CASE WHEN alcohol_content <> 0 THEN 10 ELSE 0 END, ord) / 100.0 AS DECIMAL(5,3)) AS data_quality_score
  FROM s WHERE has_detail AND brand_name <> '' GROUP BY pkey),
fp AS (
  SELECT {key32("'product_' || filing_id")} AS product_fact_id, filing_id, co.company_key, co.company_id, pr.product_key, pr.product_id,
    {date_id('filing_date')} AS filing_date_id, {date_id('approval_date')} AS approval_date_id,
    {date_id('expiration_date')} AS expiration_date_id,
    CAST(final_quality_score AS DECIMAL(5,3)) AS final_quality_score, CAST(data_completeness_score AS DECIMAL(5,3)) AS data_completeness_score,
    days_to_approval, has_certificate AS has_certificate_data, has_detail AS has_detail_data,
    coalesce(s.class_type_code,'') AS class_type_code, coalesce(s.origin_code,'') AS origin_code,
    coalesce(s.product_category,'OTHER') AS product_category, coalesce(status,'') AS status, serial_number, vendor_code,
    filing_date, approval_date, expiration_date, partition_date
  FROM s LEFT JOIN companies co ON co.company_key = md5(ckey) LEFT JOIN products pr ON pr.product_key = md5(pkey) WHERE has_detail),
fc AS (
  SELECT {key32("'certificate_' || filing_id")} AS certificate_fact_id, filing_id, co.company_key, co.company_id,
    {date_id('cert_application_date')} AS application_date_id, {date_id('cert_approval_date')} AS approval_date_id,
    CAST(final_quality_score AS DECIMAL(5,3)) AS final_quality_score, CAST(data_completeness_score AS DECIMAL(5,3)) AS data_completeness_score,
    coalesce(cert_status, status) LIKE '%APPROVED%' AS is_approved, has_detail AS has_detail_data,
    coalesce(cert_status, status) AS certificate_status, coalesce(cert_certificate_type,'') AS certificate_type,
    coalesce(cert_serial_number, serial_number) AS serial_number, coalesce(cert_plant_registry_number,'') AS plant_registry_number,
    cert_application_date AS application_date, cert_approval_date AS approval_date, partition_date
  FROM s LEFT JOIN companies co ON co.company_key = md5(ckey) WHERE has_certificate),
flat AS (
  SELECT *, product_description AS class_text, regexp_matches(filing_id, '^[0-9]{{14}}$') AS filing_id_valid,
    coalesce(class_type_code IS NOT NULL AND has_detail, false) AS class_valid, coalesce(origin_code IS NOT NULL AND has_detail, false) AS origin_valid,
    (1 + CASE WHEN coalesce(applicant_business_name,'')<>'' THEN 1 ELSE 0 END + CASE WHEN coalesce(applicant_mailing_address,'')<>'' THEN 1 ELSE 0 END
     + CASE WHEN coalesce(brand_name,'')<>'' THEN 1 ELSE 0 END + CASE WHEN coalesce(product_description,'')<>'' THEN 1 ELSE 0 END
     + CASE WHEN detail_approval_date IS NOT NULL THEN 1 ELSE 0 END) / 6.0::DOUBLE AS flat_score,
    (2 * (1 + CASE WHEN applicant_business_name IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN brand_name IS NOT NULL THEN 1 ELSE 0 END
      + CASE WHEN product_description IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN detail_approval_date IS NOT NULL THEN 1 ELSE 0 END)
     + CASE WHEN filing_date IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN net_contents IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN alcohol_content IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN product_description IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN origin_code IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN fanciful_name IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN applicant_phone IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN applicant_email IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN applicant_mailing_address IS NOT NULL THEN 1 ELSE 0 END) / 20.0::DOUBLE AS record_score
  FROM s),
tiered AS (
  SELECT *, CASE WHEN flat_score >= 0.9 THEN
      CASE WHEN applicant_business_name<>'' AND applicant_mailing_address<>'' AND brand_name<>'' AND product_description<>''
        AND detail_approval_date IS NOT NULL AND filing_id_valid AND class_valid THEN 'premium' ELSE 'standard' END
    WHEN flat_score >= 0.7 THEN CASE WHEN applicant_business_name<>'' AND brand_name<>'' AND filing_id_valid THEN 'standard' ELSE 'basic' END
    ELSE 'basic' END AS data_quality_tier
  FROM flat),
dates AS (
  SELECT CAST(day AS DATE) AS date FROM (SELECT unnest(generate_series(make_date(year(min(o_orderdate)),1,1), make_date(year(max(o_orderdate)),12,31), INTERVAL 1 DAY)) AS day FROM orders)),
reference AS (
  SELECT DISTINCT p_type AS code, {description('p_type')} AS description, 'product_class_type' AS kind FROM part
  UNION ALL SELECT n_name, 'Goods of ' || r_name, 'origin_code' FROM nation JOIN region ON n_regionkey = r_regionkey)
"""

LINE_FILINGS = f"""
  SELECT {fid('l_orderkey')} AS filing_id, CASE WHEN l_linestatus='F' THEN 'cola-detail' ELSE 'certificate' END AS view,
    CAST(l_suppkey % 4 AS INT) AS receipt_method, l_linenumber AS sequence, l_partkey, l_suppkey, l_extendedprice AS price FROM lineitem
"""

FETCH_LOG = """
  SELECT CAST(ts AS DATE) AS partition_date, CAST(user_id % 4 AS INT) AS receipt_method,
    CASE WHEN event_type IN ('click','view') THEN 'cola-detail' WHEN event_type IN ('purchase','signup') THEN 'certificate'
      WHEN value < 10 THEN 'cola-detail' ELSE 'certificate' END AS view,
    event_id AS sequence, event_type <> 'error' AS success FROM events
"""

GAPS = """
WITH expected AS (
  SELECT CAST(day AS DATE) AS partition_date, m AS receipt_method
  FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS day FROM events), (VALUES (0),(1),(2),(3)) v(m)),
landed AS (SELECT DISTINCT CAST(ts AS DATE) AS partition_date, CAST(user_id % 4 AS INT) AS receipt_method
  FROM events WHERE event_type='purchase' AND value > 35)
"""

LOOSE = """
WITH e AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
    CASE event_type WHEN 'click' THEN 'Yes' WHEN 'view' THEN '' ELSE event_type END AS event_type,
    value, CASE WHEN event_type='error' THEN 'none' ELSE props END AS props,
    CASE WHEN user_id < 50 THEN strftime(ts, '%Y-%-m-%-d') ELSE strftime(ts, '%Y-%m-%d') END AS day, date_trunc('second', ts) AS stamp FROM events),
k AS (
  SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    CASE WHEN event_type='' THEN NULL ELSE lower(event_type) IN ('true','yes','1','on') END AS event_type,
    CAST(regexp_extract(printf('%.2f', value), '[0-9]+') AS BIGINT) AS value,
    TRY_CAST(NULLIF(regexp_extract(props, '[0-9]+'),'') AS BIGINT) AS props,
    CASE WHEN regexp_matches(day, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN CAST(day AS DATE) END AS day,
    strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp FROM e),
bad AS (SELECT (event_type IS NULL) AS b1, (props IS NULL) AS b2, (day IS NULL) AS b3 FROM k)
"""


def window_hours(where: str = "TRUE") -> str:
    return f"""
WITH h AS (SELECT date_trunc('hour', ts) AS w, count(*) AS total_runs,
    count(*) FILTER (WHERE event_type='error') AS failed_runs,
    count(*) FILTER (WHERE event_type IN ('purchase','click','signup')) AS successful_runs FROM events WHERE {where} GROUP BY 1),
r AS (SELECT *, successful_runs * 100.0::DOUBLE / total_runs AS rate FROM h),
a AS (
  SELECT w, 'run_failures' AS type, CASE WHEN failed_runs > 2 THEN 'high' ELSE 'medium' END AS severity,
    failed_runs || ' pipeline runs failed in the last hour' AS message FROM r WHERE failed_runs > 0
  UNION ALL SELECT w, 'low_success_rate', 'high', 'pipeline success rate dropped to ' || printf('%.1f', rate) || '%' FROM r
    WHERE rate < 80 AND total_runs >= 5)
"""


def company_export(where: str, day: str) -> str:
    """Company dimension of part of the filings, at the sink schema."""
    return f"""
  SELECT md5(ckey) AS company_key, {key32('ckey')} AS company_id, arg_min(applicant_business_name, ord) AS business_name,
    arg_min(coalesce(applicant_mailing_address,''), ord) AS mailing_address,
    coalesce(arg_min(applicant_phone, ord) FILTER (WHERE applicant_phone <> ''), '') AS phone,
    coalesce(arg_min(applicant_email, ord) FILTER (WHERE applicant_email <> ''), '') AS email, '' AS fax,
    min(partition_date) AS first_seen_date, max(partition_date) AS last_seen_date, count(*) AS total_applications,
    least(arg_min(30 + CASE WHEN length(applicant_business_name) > 5 THEN 10 ELSE 0 END
      + CASE WHEN coalesce(applicant_mailing_address,'') <> '' THEN 30 ELSE 0 END
      + CASE WHEN applicant_mailing_address LIKE '%,%' THEN 10 ELSE 0 END
      + CASE WHEN coalesce(applicant_phone,'') <> '' THEN 15 ELSE 0 END
      + CASE WHEN coalesce(applicant_email,'') <> '' THEN 15 ELSE 0 END, ord), 100) / 100.0::DOUBLE AS data_quality_score,
    DATE '{day}' AS partition_date
  FROM s WHERE {where} GROUP BY ckey
"""


ORACLES: dict[str, str] = {}


def base(name: str, sql: str) -> None:
    ORACLES[name] = BASE + sql


def plain(name: str, sql: str) -> None:
    ORACLES[name] = sql


base("merged_filings", """
SELECT filing_id, has_detail, has_certificate, status, brand_name, product_description, applicant_business_name,
  applicant_mailing_address, applicant_phone, applicant_email, filing_date, approval_date, expiration_date, net_contents,
  alcohol_content, cert_status, cert_certificate_type, cert_application_date, cert_approval_date, cert_plant_registry_number,
  cert_wine_appellation, partition_date, round(data_completeness_score, 6) AS data_completeness_score, days_to_approval,
  product_category FROM m""")
base("filings_by_source", """
SELECT has_detail, has_certificate, count(*) AS filings, round(avg(data_completeness_score),6) AS mean_completeness,
  round(avg(days_to_approval),6) AS mean_days FROM m GROUP BY 1,2""")
base("merged_legacy", """
SELECT filing_id, has_detail, has_certificate, applicant_business_name, applicant_phone, brand_name AS cola_brand_name,
  filing_date AS cola_filing_date, detail_approval_date AS cola_approval_date, origin_code AS cola_origin_code,
  cert_certificate_number, cert_certificate_status, cert_plant_registry_number, flat_signature AS cert_applicant_signature_present,
  round(flat_score,6) AS data_completeness_score, CAST(detail_approval_date - filing_date AS INT) AS days_to_approval,
  coalesce(regexp_matches(class_text,'wine'),false) AS is_wine, coalesce(regexp_matches(class_text,'beer|malt'),false) AS is_beer,
  coalesce(regexp_matches(class_text,'spirit|distilled'),false) AS is_spirits,
  coalesce(applicant_business_name,'')<>'' AND coalesce(applicant_mailing_address,'')<>'' AND coalesce(applicant_phone,'')<>''
    AND coalesce(applicant_email,'')<>'' AS has_complete_applicant_info FROM flat""")
base("quality_tiers", """
SELECT data_quality_tier, count(*) AS filings, round(avg(record_score),6) AS mean_record_score FROM tiered GROUP BY 1""")
base("consolidated_schema", """
SELECT filing_id, false AS is_wine, coalesce(regexp_matches(class_text,'beer|malt'),false) AS is_beer,
  CAST(NULL AS VARCHAR) AS cola_formula_number, CAST(NULL AS INT) AS validation_errors_count, data_quality_tier,
  CAST(52 AS BIGINT) AS columns FROM tiered""")
base("structured", """
SELECT filing_id, filing_date, cert_approval_date, has_detail, coalesce(cert_applicant_signature_present,false) AS cert_applicant_signature_present,
  brand_name, cert_certificate_type, CAST(days_to_approval AS DOUBLE) AS days_to_approval, round(final_quality_score,6) AS final_quality_score,
  true AS is_valid, '' AS errors, '' AS warnings FROM s""")
base("cross_view_consistency", """
, pair AS (SELECT *, CASE WHEN substr(filing_id,6,3) = '002' THEN '9' || substr(filing_id,2,13) ELSE filing_id END AS other FROM m WHERE has_detail AND has_certificate),
told AS (SELECT filing_id, [CASE WHEN other <> filing_id THEN 'Filing ID mismatch: detail=' || filing_id || ', cert=' || other END,
  CASE WHEN lower(applicant_business_name) <> lower(cert_applicant_business_name) THEN
    'Applicant name mismatch: detail=''' || applicant_business_name || ''', cert=''' || cert_applicant_business_name || '''' END] AS i FROM pair)
SELECT filing_id, len(list_filter(i, lambda x: x IS NOT NULL)) = 0 AS is_consistent, coalesce(array_to_string(list_filter(i, lambda x: x IS NOT NULL), '; '), '') AS issues,
  'filing_id,applicant_name' AS checked_fields FROM told""")

plain("latest_per_view", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY filing_id, view ORDER BY sequence DESC, l_partkey DESC, l_suppkey DESC, price DESC) AS rn
FROM ({LINE_FILINGS})) WHERE rn = 1""")
plain("dedup_keep_first", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY CASE receipt_method WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 3 END,
  CASE view WHEN 'cola-detail' THEN 0 ELSE 1 END, sequence, l_partkey, l_suppkey, price) AS rn FROM ({LINE_FILINGS})) WHERE rn = 1""")
plain("distinct_documents", """
SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY 1""")
base("union_partitions", """
SELECT n AS landed, k AS kept, round(k / n::DOUBLE, 6) AS ratio FROM (
  SELECT (SELECT count(*) FROM d) + (SELECT count(*) FROM c) AS n, (SELECT count(*) FROM m) AS k)""")

ORDER_ID = "printf('%02d%03d%03d%06d', year(o_orderdate) % 100, dayofyear(o_orderdate), o_orderkey % 4, o_orderkey // 146400 + 1)"
plain("filing_ids", f"""
SELECT o_orderkey, {ORDER_ID} AS filing_id,
  printf('%d-%03d-%03d', CASE WHEN year(o_orderdate) % 100 <= 30 THEN 2000 + year(o_orderdate) % 100 ELSE 1900 + year(o_orderdate) % 100 END,
    dayofyear(o_orderdate), o_orderkey % 4) AS partition_key,
  printf('%d%03d%03d%06d', year(o_orderdate), dayofyear(o_orderdate), o_orderkey % 4, o_orderkey // 146400 + 1) AS long_id,
  CAST(o_orderdate AS DATE) AS day_again,
  CASE o_orderkey % 4 WHEN 1 THEN 'e-filed' WHEN 2 THEN 'mailed' WHEN 3 THEN 'overnight' ELSE 'hand delivered' END AS method_name FROM orders""")
plain("filing_id_parse", f"""
WITH b AS (SELECT *, {fid('l_orderkey')} AS f FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag='A' THEN f WHEN l_linestatus='O' THEN substr(f,1,5)||'009'||substr(f,9,6)
  WHEN l_quantity > 40 THEN '31367' || substr(f,6,9) WHEN l_quantity > 20 THEN 'x' || f ELSE substr(f,1,8) || '000000' END AS raw_id FROM b),
e AS (SELECT *, CASE WHEN NOT regexp_matches(raw_id,'^[0-9]{{14}}$') THEN 'format' WHEN CAST(substr(raw_id,3,3) AS INT) NOT BETWEEN 1 AND 366 THEN 'julian_day'
  WHEN CAST(substr(raw_id,6,3) AS INT) > 3 THEN 'receipt_method' WHEN CAST(substr(raw_id,9,6) AS INT) < 1 THEN 'sequence' END AS error FROM r)
SELECT l_orderkey, l_linenumber, raw_id,
  CASE WHEN error IS NULL THEN CAST(substr(raw_id,1,2) AS INT) + CASE WHEN CAST(substr(raw_id,1,2) AS INT) <= 30 THEN 2000 ELSE 1900 END END AS year,
  CASE WHEN error IS NULL THEN CAST(substr(raw_id,3,3) AS INT) END AS julian_day, CASE WHEN error IS NULL THEN CAST(substr(raw_id,6,3) AS INT) END AS receipt_method,
  CASE WHEN error IS NULL THEN CAST(substr(raw_id,9,6) AS INT) END AS sequence, error, regexp_matches(raw_id,'^[0-9]{{14}}$') AS is_id,
  CASE WHEN length(raw_id) = 14 THEN TRY_CAST(substr('202'||raw_id,1,4) AS INT) END AS long_year,
  CASE WHEN length(raw_id) = 14 THEN TRY_CAST(substr('202'||raw_id,11,7) AS INT) END AS long_sequence FROM e""")
plain("candidate_ids", """
SELECT CAST(m AS INT) AS receipt_method, CAST(s AS INT) AS sequence, printf('%02d%03d%03d%06d', year(day) % 100, dayofyear(day), m, s) AS filing_id
FROM (SELECT day, unnest(generate_series(1, n)) AS s FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)), (VALUES (0),(1),(2),(3)) v(m)""")
plain("work_grid", """
SELECT date, view, printf('%03d', m) || '-' || view AS work_key, CAST(m AS INT) AS receipt_method
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), (VALUES (0),(1),(2),(3)) v(m), (VALUES ('cola-detail'),('certificate')) w(view)""")
plain("date_spine", """
SELECT CAST(day AS DATE) AS date, coalesce(n, 0) AS events FROM
 (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS day FROM events)
 LEFT JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) ON CAST(day AS DATE) = d""")
DATES = f"""
SELECT {date_id('date')} AS date_id, date, CAST(year(date) AS INT) AS year, CAST(quarter(date) AS INT) AS quarter, CAST(month(date) AS INT) AS month,
  CAST(day(date) AS INT) AS day, CAST(isodow(date) AS INT) AS day_of_week, CAST(dayofyear(date) AS INT) AS day_of_year,
  CAST(weekofyear(date) AS INT) AS week_of_year, CAST(CASE WHEN month(date) >= 10 THEN year(date) ELSE year(date) - 1 END AS INT) AS fiscal_year,
  CAST(CASE WHEN month(date) >= 10 THEN 1 ELSE (month(date) + 2) // 3 END AS INT) AS fiscal_quarter, isodow(date) >= 6 AS is_weekend,
  strftime(date,'%m-%d') IN ('01-01','07-04','12-25') AS is_holiday, strftime(date,'%B') AS month_name, strftime(date,'%A') AS day_name,
  'Q' || quarter(date) AS quarter_name, CASE WHEN month(date) IN (12,1,2) THEN 'Winter' WHEN month(date) <= 5 THEN 'Spring' WHEN month(date) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
  CAST(date - DATE '1970-01-01' AS INT) AS days_from_epoch FROM dates"""
base("date_dim", DATES)
base("export_dates", DATES)

base("company_dim", "SELECT * FROM companies")
base("company_source_ids", f"""
SELECT DISTINCT md5(ckey) AS owner_key, filing_id FROM s WHERE coalesce(applicant_business_name,'') <> ''""")
base("product_dim", "SELECT * FROM products")
base("product_categories", """
SELECT count(*) AS unique_products, count(*) FILTER (WHERE product_category='WINE') AS wine_products,
  count(*) FILTER (WHERE product_category='BEER') AS beer_products, count(*) FILTER (WHERE product_category='SPIRITS') AS spirits_products FROM products""")
base("id_collisions", """
SELECT a.audited, count(c.id) AS collided_ids
FROM (VALUES ('companies'), ('products'), ('product_facts'), ('certificate_facts')) a(audited) LEFT JOIN (
  SELECT audited, id FROM (
    SELECT 'companies' AS audited, company_id AS id, company_key AS k FROM companies UNION ALL SELECT 'products', product_id, product_key FROM products
    UNION ALL SELECT 'product_facts', product_fact_id, filing_id FROM fp UNION ALL SELECT 'certificate_facts', certificate_fact_id, filing_id FROM fc)
  GROUP BY 1, 2 HAVING count(DISTINCT k) > 1) c USING (audited) GROUP BY 1""")
LEGACY_KEY = "applicant_business_name || '|' || coalesce(applicant_mailing_address, 'None')"
base("company_dim_legacy", f"""
SELECT substr(md5({LEGACY_KEY}),1,16) AS company_hash, arg_min(applicant_business_name, ord) AS company_name, arg_min(applicant_mailing_address, ord) AS mailing_address,
  arg_min(applicant_phone, ord) FILTER (WHERE applicant_phone IS NOT NULL) AS phone, arg_min(applicant_email, ord) FILTER (WHERE applicant_email IS NOT NULL) AS email,
  CAST(NULL AS VARCHAR) AS fax, arg_min(cert_plant_registry_number, ord) FILTER (WHERE cert_plant_registry_number IS NOT NULL) AS plant_registry_number,
  min(partition_date) AS created_date, count(*) AS filings, {key32(LEGACY_KEY)} AS company_id, min(partition_date) AS modified_date, true AS is_current
FROM s WHERE applicant_business_name IS NOT NULL GROUP BY {LEGACY_KEY}""")
base("location_dim", f"""
SELECT {key32('origin_code')} AS location_id, origin_code, d AS origin_description, CAST(NULL AS VARCHAR) AS state,
  CASE WHEN regexp_matches(d,'CA|NY|TX|FL|WA') THEN 'USA' ELSE 'Other' END AS country, CAST(NULL AS VARCHAR) AS region,
  regexp_matches(d,'CA|NY|TX|FL|WA') AS is_domestic
FROM (SELECT DISTINCT s.origin_code, 'Goods of ' || r_name AS d FROM s JOIN nation ON n_name = origin_code JOIN region ON n_regionkey = r_regionkey)""")
base("product_type_dim", f"""
SELECT {key32('t')} AS product_type_id, t AS product_class_code, t AS product_class_description,
  CASE WHEN regexp_matches(t,'wine|grape') THEN 'Wine' WHEN regexp_matches(t,'beer|malt|ale|lager') THEN 'Beer' WHEN regexp_matches(t,'spirit|whiskey|vodka|gin|rum') THEN 'Spirits' ELSE 'Other' END AS category,
  CASE WHEN regexp_matches(t,'wine|grape') THEN CASE WHEN t LIKE '%table%' THEN 'Table Wine' ELSE 'Specialty Wine' END
    WHEN regexp_matches(t,'beer|malt|ale|lager') THEN CASE WHEN t LIKE '%beer%' THEN 'Standard Beer' ELSE 'Specialty Beer' END
    WHEN regexp_matches(t,'spirit|whiskey|vodka|gin|rum') THEN 'Distilled Spirits' ELSE 'Specialty Product' END AS subcategory, true AS is_alcoholic
FROM (SELECT DISTINCT product_description AS t FROM s WHERE product_description IS NOT NULL)""")
base("fact_products", "SELECT * FROM fp")
base("fact_certificates", "SELECT * FROM fc")
base("fact_products_legacy", f"""
SELECT {key32("filing_id || '_product'")} AS product_id, filing_id, {key32(LEGACY_KEY)} AS company_id, {key32('origin_code')} AS location_id,
  {key32('product_description')} AS product_type_id, {date_id('filing_date')} AS filing_date_id, {date_id('detail_approval_date')} AS approval_date_id, brand_name,
  CAST(0 AS INT) AS label_images_count, CAST(detail_approval_date - filing_date AS INT) AS days_to_approval, round(record_score,6) AS data_quality_score
FROM flat WHERE has_detail""")
base("fact_certificates_legacy", f"""
SELECT {key32("m.filing_id || '_certificate'")} AS certificate_id, m.filing_id, {key32('m.' + LEGACY_KEY.replace('coalesce(', 'coalesce(m.'))} AS company_id,
  {date_id('application_date')} AS application_date_id, {date_id('c.approval_date')} AS approval_date_id, certificate_number, certificate_status, certificate_type,
  plant_registry_number, applicant_signature_present, authorized_signature_present, CAST(c.approval_date - application_date AS INT) AS days_to_approval
FROM m JOIN c ON m.filing_id = c.filing_id""")
base("star_rollup", """
SELECT CAST(year(filing_date) AS INT) AS year, CASE WHEN month(filing_date) IN (12,1,2) THEN 'Winter' WHEN month(filing_date) <= 5 THEN 'Spring' WHEN month(filing_date) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
  p.brand_name, count(*) AS filings, count(DISTINCT business_name) AS companies, round(avg(days_to_approval),6) AS mean_days
FROM fp LEFT JOIN companies USING (company_key) LEFT JOIN products p USING (product_key) GROUP BY 1,2,3""")
base("fact_dates", """
SELECT CAST(year(filing_date) AS INT) AS filed_year, CASE WHEN year(approval_date) <= (SELECT year(max(date)) FROM dates) THEN CAST(year(approval_date) AS INT) END AS approved_year,
  CASE WHEN year(expiration_date) <= (SELECT year(max(date)) FROM dates) THEN 'Q' || quarter(expiration_date) END AS expires_quarter_name, count(*) AS filings FROM fp GROUP BY 1,2,3""")
plain("orphans", """
SELECT 'l_orderkey' AS foreign_key, count(*) AS orphans FROM lineitem ANTI JOIN (SELECT * FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED') ON l_orderkey = o_orderkey
UNION ALL SELECT 'l_partkey', count(*) FROM lineitem ANTI JOIN part ON l_partkey = p_partkey
UNION ALL SELECT 'l_suppkey', count(*) FROM lineitem ANTI JOIN supplier ON l_suppkey = s_suppkey""")
plain("code_validation", f"""
SELECT p_partkey, coalesce(p_size < 20, false) AS is_valid, CASE WHEN p_size < 20 THEN p_type END AS validated_code, CASE WHEN p_size < 20 THEN {description('p_type')} END AS description,
  CASE WHEN p_size < 20 THEN NULL WHEN p_size < 30 THEN 'Unknown product class type code: ' || p_brand ELSE 'Empty value' END AS validation_error FROM part""")
plain("code_reverse", """
SELECT r_name, max(n_name) AS code FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1""")

plain("text_clean", f"""
SELECT page_id, md5({clean('html')}) AS cleaned, md5({squeeze('html')}) AS squeezed, md5(replace({squeeze('html')}, '&nbsp;', ' ')) AS page_text,
  CAST(length({squeeze('html')}) AS INT) AS kept_tags_length FROM pages""")
plain("text_numbers", r"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '[0-9]+\.?[0-9]*'), ',') AS numbers, CAST(len(regexp_extract_all(text, '[0-9]+')) AS BIGINT) AS whole_numbers FROM documents""")
plain("email_zip", rf"""
SELECT doc_id, NULLIF(regexp_extract(text, '(?:^|[^\pL\pM\pN_])([0-9]{{5}}(?:-[0-9]{{4}})?)(?:$|[^\pL\pM\pN_])', 1), '') AS zip,
  CAST(len(w) AS BIGINT) AS words, CAST(len([x FOR x IN w IF regexp_matches(x, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}$')]) AS BIGINT) AS emails
FROM (SELECT doc_id, text, [x FOR x IN string_split({squeeze('text')}, ' ') IF contains(x, '@')] AS w FROM documents)""")
plain("url_check", r"""
SELECT page_id, regexp_matches(url, '(?i)^https?://[^\s/$.?#].[^\s]*$') AS is_url,
  regexp_matches(CASE WHEN contains(url, '#') THEN replace(url, '#', ' ') ELSE upper(url) END, '(?i)^https?://[^\s/$.?#].[^\s]*$') AS bent_is_url FROM pages""")
plain("phone_format", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN printf('1-(%03d) 555-%04d', c_custkey % 900 + 100, c_custkey % 10000)
  WHEN c_acctbal < 5000 THEN printf('(%03d) 555-%04d', c_custkey % 900 + 100, c_custkey % 10000) ELSE CAST(c_custkey AS VARCHAR) END AS phone FROM customer""")
plain("address_norm", """
SELECT c_custkey, upper(c_custkey || ' N ' || c_mktsegment || ' AVE, LOWER EASTERN RD ' || c_name || ' PL DR') AS address,
  upper(c_name || '|' || c_custkey || ' north <b>' || c_mktsegment || '</b> Avenue,' || chr(160) || 'Lower  Eastern Road' || chr(10) || c_name || ' place Drive') AS match_key FROM customer""")
plain("state_norm", """
SELECT c_custkey, CASE n_nationkey % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'FL' ELSE 'X1' END AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
plain("date_parse", f"""
WITH p AS (SELECT *, CASE WHEN o_custkey % 9 <= 6 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders)
SELECT o_orderkey, parsed, strftime(parsed, '%Y-%m-%d') AS iso, CASE WHEN o_custkey % 9 IN (0, 2) THEN parsed END AS legacy,
  {date_id('parsed')} AS date_id, CAST(o_orderdate AS DATE) AS legacy_stamp FROM p""")
plain("decimal_parse", """
SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS plain, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS currency,
  CASE WHEN h <= 100 THEN CAST(h AS DOUBLE) ELSE h / 100.0::DOUBLE END AS share, CAST(NULL AS DOUBLE) AS broken
FROM (SELECT *, CASE p_size % 8 WHEN 1 THEN (p_size // 8) * 100 + 12 WHEN 3 THEN (p_size // 8) * 100 + 38 WHEN 5 THEN (p_size // 8) * 100 + 62
  WHEN 7 THEN (p_size // 8) * 100 + 88 ELSE p_size * 100 // 8 END AS h FROM part)""")
plain("alcohol", """
SELECT raw, CASE WHEN l_returnflag='A' THEN n + 0.5::DOUBLE WHEN l_linestatus='O' OR l_discount > 0.05 THEN CAST(n AS DOUBLE) END AS alcohol, count(*) AS lines FROM (
  SELECT *, CASE WHEN l_returnflag='A' THEN '5 % sugar, ' || n || '.5% ABV' WHEN l_linestatus='O' THEN 'Alcohol : ' || n || ' by volume'
    WHEN l_discount > 0.05 THEN n || '% of all' ELSE 'proof ' || n END AS raw FROM (SELECT *, CAST(l_quantity AS INT) AS n FROM lineitem)) GROUP BY 1, 2""")
plain("container", r"""
SELECT p_partkey, CASE WHEN regexp_matches(t,'750\s*ml') THEN '750ml' WHEN regexp_matches(t,'375\s*ml') THEN '375ml' WHEN regexp_matches(t,'1\.5\s*l|1500\s*ml') THEN '1.5L'
  WHEN regexp_matches(t,'3\s*l|3000\s*ml') THEN '3L' WHEN regexp_matches(t,'12\s*oz') THEN '12oz' WHEN regexp_matches(t,'16\s*oz') THEN '16oz' WHEN regexp_matches(t,'22\s*oz') THEN '22oz'
  WHEN regexp_matches(t,'[0-9]\s*(ml|l|oz|gallon)') THEN regexp_extract(t,'([0-9]+\.?[0-9]*)\s*(ml|l|oz|gallon)',1) || regexp_extract(t,'([0-9]+\.?[0-9]*)\s*(ml|l|oz|gallon)',2) END AS size
FROM (SELECT p_partkey, lower('approx ' || p_size || CASE p_type WHEN 'STANDARD' THEN ' ML' WHEN 'ECONOMY' THEN '00 ml' WHEN 'MEDIUM' THEN ' L' WHEN 'PROMO' THEN 'oz' WHEN 'LARGE' THEN ' gallons' ELSE ' units' END) AS t FROM part)""")
plain("beverage_class", f"""
SELECT doc_id, {first_class('text', BEVERAGE, 'UNKNOWN')} AS beverage_type, {first_class('text', CATEGORY, 'OTHER')} AS category,
  regexp_matches(lower(text),'wine') AS is_wine, regexp_matches(lower(text),'beer|malt') AS is_beer, regexp_matches(lower(text),'spirit|distilled') AS is_spirits,
  CASE WHEN regexp_matches(t,'wine|grape') THEN 'Wine' WHEN regexp_matches(t,'beer|malt|ale|lager') THEN 'Beer' WHEN regexp_matches(t,'spirit|whiskey|vodka|gin|rum') THEN 'Spirits' ELSE 'Other' END AS kind,
  CASE WHEN regexp_matches(t,'wine|grape') THEN CASE WHEN t LIKE '%table%' THEN 'Table Wine' ELSE 'Specialty Wine' END
    WHEN regexp_matches(t,'beer|malt|ale|lager') THEN CASE WHEN t LIKE '%beer%' THEN 'Standard Beer' ELSE 'Specialty Beer' END
    WHEN regexp_matches(t,'spirit|whiskey|vodka|gin|rum') THEN 'Distilled Spirits' ELSE 'Specialty Product' END AS subkind
FROM (SELECT *, lower(text) AS t FROM documents)""")
plain("rule_clean", f"""
SELECT CAST(page_id AS VARCHAR) AS filing_id, md5({clean('html')}) AS brand_hash, array_to_string(regexp_extract_all(url, '[0-9]+'), ',') AS wine_vintage, '12oz' AS net_contents,
  '2024-01-' || lpad(CAST(page_id % 31 + 1 AS VARCHAR), 2, '0') AS filing_date,
  {first_class(clean('html'), BEVERAGE, 'UNKNOWN')} AS beverage_type, false AS filing_id_valid FROM pages""")

plain("lenient_cast", LOOSE + """
SELECT *, CAST(NULL AS VARCHAR) AS extra, CAST(3 + (value IS NOT NULL)::INT + (event_type IS NOT NULL)::INT + (props IS NOT NULL)::INT + (day IS NOT NULL)::INT AS BIGINT) AS fields FROM k""")
plain("schema_compliance", LOOSE + """
SELECT count(*) AS total_records, CAST(0 AS BIGINT) AS valid_records, count(*) AS error_records, 'extra,stamp' AS missing_fields, '' AS extra_fields FROM bad
UNION ALL SELECT count(*), count(*) FILTER (WHERE NOT (b1 OR b2 OR b3)), count(*) FILTER (WHERE b1 OR b2 OR b3), '', 'more' FROM bad""")
FIELD_COUNTS = "".join(
    f"{'UNION ALL ' if i else ''}SELECT '{f}' AS field, count({f}) AS non_null_count, count(*) - count({f}) AS null_count, count(*) - count({f}) AS type_errors FROM k\n"
    for i, f in enumerate(["event_id", "user_id", "event_type", "value", "props", "day", "stamp"])
)
plain("field_validation", LOOSE + FIELD_COUNTS)
plain("dataset_quality", LOOSE + f"""
, f AS ({FIELD_COUNTS}), fc AS (SELECT (sum(non_null_count / (non_null_count + null_count)::DOUBLE) + 1) / 8 AS v FROM f),
cr AS (SELECT count(*) FILTER (WHERE NOT (b1 OR b2 OR b3)) / count(*)::DOUBLE AS v FROM bad)
SELECT round(cr.v,6) AS compliance_rate, round(fc.v,6) AS field_completeness, round((cr.v + fc.v)/2,6) AS data_quality_score FROM fc, cr""")

plain("fetch_cutoff", f"""
WITH l AS ({FETCH_LOG}),
i AS (SELECT *, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY partition_date, receipt_method, view ORDER BY sequence) AS island FROM l),
r AS (SELECT *, sum(CASE WHEN success THEN 0 ELSE 1 END) OVER (PARTITION BY partition_date, receipt_method, view, island ORDER BY sequence) AS run FROM i),
cut AS (SELECT partition_date, receipt_method, view, min(sequence) FILTER (WHERE run = 3) AS cutoff FROM r GROUP BY 1,2,3)
SELECT partition_date, receipt_method, view, sequence, success FROM l JOIN cut USING (partition_date, receipt_method, view) WHERE cutoff IS NULL OR sequence <= cutoff""")
plain("fetch_stats", f"""
SELECT partition_date, receipt_method, view, count(*) AS total_processed, count(*) FILTER (WHERE success) AS total_success, count(*) FILTER (WHERE NOT success) AS total_failures,
  round(count(*) FILTER (WHERE success) / count(*)::DOUBLE, 6) AS success_rate FROM ({FETCH_LOG}) GROUP BY 1,2,3""")
plain("missing_partitions", GAPS + """
SELECT partition_date, CAST(receipt_method AS INT) AS receipt_method, landed.partition_date IS NOT NULL AS landed FROM expected LEFT JOIN landed USING (partition_date, receipt_method)""".replace(
    "landed.partition_date IS NOT NULL", "hit IS NOT NULL").replace("LEFT JOIN landed", "LEFT JOIN (SELECT *, 1 AS hit FROM landed)"))
plain("backfill_stop", GAPS + """
, day AS (SELECT partition_date, bool_and(hit IS NOT NULL) AS complete FROM expected LEFT JOIN (SELECT *, 1 AS hit FROM landed) USING (partition_date, receipt_method) GROUP BY 1),
i AS (SELECT *, sum(CASE WHEN complete THEN 0 ELSE 1 END) OVER (ORDER BY partition_date DESC) AS island FROM day),
r AS (SELECT *, CAST(sum(CASE WHEN complete THEN 1 ELSE 0 END) OVER (PARTITION BY island ORDER BY partition_date DESC) AS BIGINT) AS found_run FROM i)
SELECT partition_date, complete, found_run, found_run >= 3 AS stops FROM r
WHERE partition_date >= coalesce((SELECT max(partition_date) FROM r WHERE found_run >= 3), DATE '1900-01-01')""")

base("extraction_stats", """
SELECT 'cola-detail' AS view, count(*) AS total_files, count(*) FILTER (WHERE fetched) AS successful_parses, count(*) FILTER (WHERE NOT fetched) AS failed_parses,
  CAST(sum(CASE WHEN fetched THEN (brand_name<>'')::INT + (applicant_phone<>'')::INT + (applicant_email<>'')::INT + (approval_date IS NOT NULL)::INT END) AS BIGINT) AS total_fields_extracted,
  round(count(*) FILTER (WHERE fetched) / count(*)::DOUBLE, 6) AS success_rate FROM detail_all""")
base("cleaning_stats", """
SELECT count(*) AS records_cleaned, count(*) FILTER (WHERE has_detail AND has_certificate) AS duplicates_removed, count(*) FILTER (WHERE has_certificate) AS certificate_records,
  count(*) FILTER (WHERE has_detail) AS detail_records, CAST(sum(has_detail::INT + has_certificate::INT) AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS validation_errors,
  round(count(*) / sum(has_detail::INT + has_certificate::INT)::DOUBLE, 6) AS success_rate FROM m""")
base("structuring_stats", """
SELECT count(*) AS records_structured, count(*) AS validation_passed, CAST(0 AS BIGINT) AS validation_failed, CAST(0 AS BIGINT) AS schema_violations,
  round(avg(final_quality_score),6) AS average_quality_score FROM s""")
base("fact_stats", """
SELECT 'products' AS fact, count(*) AS fact_records_created, count(*) - count(company_id) AS missing_company_keys, round(avg(CAST(final_quality_score AS DOUBLE)),6) AS average_quality_score,
  round(avg(days_to_approval),6) AS measure FROM fp
UNION ALL SELECT 'certificates', count(*), count(*) - count(company_id), round(avg(CAST(final_quality_score AS DOUBLE)),6), round(avg(is_approved::INT),6) FROM fc""")
base("export_summary", """
SELECT 'dim_dates' AS "table", count(*) AS rows FROM dates UNION ALL SELECT 'dim_companies', count(*) FROM companies UNION ALL SELECT 'dim_products', count(*) FROM products
UNION ALL SELECT 'fact_products', count(*) FROM fp UNION ALL SELECT 'fact_certificates', count(*) FROM fc""")
base("reference_stats", """
SELECT k AS kind, count(code) AS records, count(code) = 0 AS has_errors FROM (VALUES ('product_class_type'),('origin_code'),('unknown_kind')) v(k) LEFT JOIN reference ON kind = k GROUP BY 1""")
COVER = " UNION ALL ".join(
    f"SELECT '{f}' AS field, count(*) FILTER (WHERE coalesce(CAST({f} AS VARCHAR),'')<>'') AS non_empty_count, count(*) AS total_records FROM m"
    for f in ["brand_name", "applicant_phone", "applicant_email", "applicant_fax", "net_contents", "approval_date", "cert_status"]
)
base("field_coverage", f"""
SELECT *, round(non_empty_count * 100.0::DOUBLE / total_records, 6) AS coverage_percentage,
  CASE WHEN non_empty_count * 100.0::DOUBLE / total_records > 80 THEN 'high' WHEN non_empty_count * 100.0::DOUBLE / total_records >= 50 THEN 'medium' ELSE 'low' END AS band FROM ({COVER})""")


def issues(*pairs: tuple[str, str]) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN {msg} END" for c, msg in pairs) + ")"


def p1(x: str) -> str:
    return f"printf('%.1f', {x})"


def p2(x: str) -> str:
    return f"printf('%.2f', {x})"


def check(name: str, found: str, description: str, source: str, metrics: str, severity: str = "CASE WHEN i <> '' THEN 'WARN' END", passed: str = "i = ''") -> str:
    return f"""
, z AS ({source}), y AS (SELECT *, {found} AS i FROM z)
SELECT '{name}' AS "check", {passed} AS passed, {severity} AS severity, {description} AS description, i AS issues, {metrics} FROM y"""


base("check_parse", check(
    "parsing_success_rate", issues(("r < 85", "'Below failure threshold of 85.0%'"), ("r >= 85 AND r < 95", "'Below warning threshold of 95.0%'")),
    f"'Parsing success rate: ' || {p1('r')} || '% (' || k || '/' || n || ' files)'",
    f"SELECT n, k, {percent('k', 'n')} AS r FROM (SELECT count(*) AS n, count(*) FILTER (WHERE fetched) AS k FROM detail_all)",
    "n AS total_files, k AS successful_parses, n - k AS failed_parses, round(r,6) AS success_rate_percent",
    "CASE WHEN r < 85 THEN 'ERROR' WHEN r < 95 THEN 'WARN' END", "r >= 85"))
ESSENTIAL = ["filing_id", "serial_number", "filing_date", "applicant_business_name", "brand_name", "product_description", "net_contents"]


def essential(f: str) -> str:
    # the check reads raw rows, where an unreadable size is still text
    test = "filing_id IS NOT NULL" if f == "net_contents" else f"coalesce(CAST({f} AS VARCHAR),'')<>''"
    return f"count(*) FILTER (WHERE {test}) * 100.0::DOUBLE / count(*) AS {f}_percent"


base("check_fields", check(
    "field_extraction_completeness", issues(*[(f"{f}_percent < 70", f"'{f}'") for f in ESSENTIAL]),
    f"'Field extraction completeness: ' || {p1('o')} || '% average'",
    f"SELECT *, ({' + '.join(f + '_percent' for f in ESSENTIAL)}) / 7 AS o FROM (SELECT count(*) AS total_records, {', '.join(essential(f) for f in ESSENTIAL)} FROM d)",
    "total_records, " + ", ".join(f"round({f}_percent,6) AS {f}_percent" for f in ESSENTIAL) + ", round(o,6) AS overall_completeness_percent"))
base("check_validation", check(
    "transformation_validation_rates", issues(("a < 90", f"'Low filing ID validation rate: ' || {p1('a')} || '%'"), ("e > 10", f"'High transformation error rate: ' || {p1('e')} || '%'")),
    f"'Validation rates - Filing ID: ' || {p1('a')} || '%, Product Class: ' || {p1('b')} || '%, Origin: ' || {p1('g')} || '%'",
    f"""SELECT *, {percent('va','n')} AS a, {percent('vb','n')} AS b, {percent('vg','n')} AS g, {percent('ve','n')} AS e FROM (
      SELECT count(*) AS n, count(*) FILTER (WHERE filing_id_valid) AS va, count(*) FILTER (WHERE class_valid) AS vb, count(*) FILTER (WHERE origin_valid) AS vg,
        count(*) FILTER (WHERE net_contents IS NULL) AS ve FROM flat)""",
    "n AS total_records, va AS valid_ids, vb AS valid_product_classes, vg AS valid_origin_codes, round(a,6) AS id_validation_rate, round(b,6) AS product_class_validation_rate, "
    "round(g,6) AS origin_code_validation_rate, round(e,6) AS transformation_error_rate"))
plain("check_schema", LOOSE + check(
    "schema_compliance", issues(("g < 95", f"'Low compliance rate: ' || {p1('g')} || '%'"), ("e > 5", f"'Error rate: ' || {p1('e')} || '%'")),
    f"'Schema compliance: ' || {p1('g')} || '%'",
    "SELECT n, v, n - v AS w, v * 100.0::DOUBLE / n AS g, (n - v) * 100.0::DOUBLE / n AS e FROM (SELECT count(*) AS n, count(*) FILTER (WHERE NOT (b1 OR b2 OR b3)) AS v FROM bad)",
    "n AS total_records, v AS valid_records, w AS error_records, '' AS missing_fields, '' AS extra_fields, round(g,6) AS compliance_rate, round(e,6) AS error_rate"))
COUNTS = "SELECT count(DISTINCT code) FILTER (WHERE kind='product_class_type') AS p, count(DISTINCT code) FILTER (WHERE kind='origin_code') AS o FROM reference"
LOW_COUNTS = [("p < 500", "'Low product code count: ' || p || ' (expected ≥ 500)'"), ("o < 200", "'Low origin code count: ' || o || ' (expected ≥ 200)'")]
base("check_reference", check(
    "reference_data_freshness", issues(*LOW_COUNTS), "'Reference data loaded: ' || p || ' product codes, ' || o || ' origin codes'", COUNTS,
    "p AS product_codes_count, o AS origin_codes_count, p + o AS total_reference_records"))
base("check_reference_coverage", check(
    "reference_data_coverage", issues(*LOW_COUNTS, ("age > 7", "'Product codes data is ' || age || ' days old'"), ("age > 7", "'Origin codes data is ' || age || ' days old'")),
    "'Reference data: ' || p || ' product codes, ' || o || ' origin codes'",
    f"SELECT *, (SELECT CAST(DATE '2001-08-20' - max(CAST(o_orderdate AS DATE)) AS INT) FROM orders) AS age FROM ({COUNTS})",
    "p AS product_codes_count, o AS origin_codes_count, CAST(0 AS BIGINT) AS empty_product_descriptions, CAST(0 AS BIGINT) AS empty_origin_descriptions, age AS product_age_days, "
    "age AS origin_age_days, p + o AS total_reference_records, 0.0::DOUBLE AS product_empty_percentage, 0.0::DOUBLE AS origin_empty_percentage"))
base("reference_sample", "SELECT code FROM reference WHERE kind='origin_code' ORDER BY code LIMIT 10")
base("check_facts", check(
    "fact_table_integrity", issues(("ci < 95", f"'Low company foreign key integrity: ' || {p1('ci')} || '%'"), ("pi < 95", f"'Low product foreign key integrity: ' || {p1('pi')} || '%'"),
                                   ("q < 0.6", f"'Low average quality score: ' || {p2('q')}"), ("dc < 80", f"'Low date completeness: ' || {p1('dc')} || '%'")),
    f"'Fact table integrity: ' || n || ' records, FK integrity ' || {p1('least(ci, pi)')} || '%, avg quality ' || {p2('q')}",
    f"""SELECT *, {percent('nc','n')} AS ci, {percent('np','n')} AS pi, {percent('nd','n')} AS dc, {percent('na','n')} AS ar FROM (
      SELECT count(*) AS n, count(company_id) AS nc, count(product_id) AS np, avg(CAST(final_quality_score AS DOUBLE)) AS q, count(*) FILTER (WHERE filing_date IS NOT NULL AND approval_date IS NOT NULL) AS nd,
        count(*) FILTER (WHERE has_detail_data) AS hd, count(*) FILTER (WHERE has_certificate_data) AS hc, count(*) FILTER (WHERE status LIKE '%APPROVED%') AS na FROM fp)""",
    "n AS total_records, n - nc AS missing_company_keys, n - np AS missing_product_keys, round(ci,6) AS company_key_integrity_percent, round(pi,6) AS product_key_integrity_percent, round(q,6) AS average_quality_score, "
    "nd AS records_with_dates, round(dc,6) AS date_completeness_percent, hd AS has_detail_count, hc AS has_certificate_count, round(ar,6) AS approval_rate"))
base("check_dimensions", check(
    "dimensional_data_quality", issues(("q < 0.6", f"'Low average quality score: ' || {p2('q')}"), ("lp > 20", f"'High percentage of low-quality companies: ' || {p1('lp')} || '%'"),
                                       ("ap < 90", f"'Low address completeness: ' || {p1('ap')} || '%'"), ("dup > 0", "'Potential duplicate companies detected: ' || dup")),
    f"'Company dimension: ' || n || ' unique companies, avg quality ' || {p2('q')} || ', ' || {p1('aa')} || ' avg applications'",
    f"""SELECT *, {percent('low','n')} AS lp, {percent('np','n')} AS pp, {percent('ne','n')} AS ep, {percent('na','n')} AS ap, t / n::DOUBLE AS aa FROM (
      SELECT count(*) AS n, avg(CAST(data_quality_score AS DOUBLE)) AS q, count(*) FILTER (WHERE data_quality_score < 0.5) AS low, count(*) FILTER (WHERE phone<>'') AS np, count(*) FILTER (WHERE email<>'') AS ne,
        count(*) FILTER (WHERE mailing_address<>'') AS na, count(*) - count(DISTINCT upper(trim(business_name))) AS dup, CAST(sum(total_applications) AS BIGINT) AS t FROM companies)""",
    "n AS total_companies, round(q,6) AS average_quality_score, low AS low_quality_companies, round(lp,6) AS low_quality_percentage, round(pp,6) AS phone_percent, round(ep,6) AS email_percent, "
    "round(ap,6) AS address_percent, dup AS potential_duplicates, t AS total_applications, round(aa,6) AS avg_applications_per_company"))
base("check_certificates", check(
    "certificate_compliance_monitoring", issues(("ar < 80", f"'Low approval rate: ' || {p1('ar')} || '%'"), ("q < 0.6", f"'Low average quality score: ' || {p2('q')}"),
                                                ("sp < 90", f"'Low serial number completeness: ' || {p1('sp')} || '%'"), ("rp < 90", f"'Low plant registry completeness: ' || {p1('rp')} || '%'"), ("dp < 90", f"'Low date completeness: ' || {p1('dp')} || '%'")),
    f"'Certificate compliance: ' || {p1('ar')} || '% approval rate, avg quality ' || {p2('q')}",
    f"""SELECT *, {percent('na','n')} AS ar, {percent('ns','n')} AS sp, {percent('nr','n')} AS rp, {percent('nd','n')} AS dp FROM (
      SELECT count(*) AS n, count(*) FILTER (WHERE is_approved) AS na, avg(CAST(final_quality_score AS DOUBLE)) AS q, count(*) FILTER (WHERE coalesce(serial_number,'')<>'') AS ns, count(*) FILTER (WHERE plant_registry_number<>'') AS nr,
        count(*) FILTER (WHERE application_date IS NOT NULL AND approval_date IS NOT NULL) AS nd FROM fc)""",
    "n AS total_certificates, na AS approved_certificates, round(ar,6) AS approval_rate_percent, round(q,6) AS average_quality_score, round(sp,6) AS serial_number_percent, round(rp,6) AS plant_registry_percent, round(dp,6) AS dates_percent"))
base("top_companies", "SELECT business_name, total_applications FROM companies ORDER BY total_applications DESC, business_name LIMIT 5")
base("certificate_types", "SELECT certificate_type, count(*) AS records FROM fc GROUP BY 1")
base("most_common_type", "SELECT certificate_type, count(*) AS records FROM fc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")

plain("error_page_filter", """
SELECT page_id, sha256(html) AS content_hash FROM pages
WHERE sha256(html) NOT IN ('50fa048f9cf8200c3d82d60add59b3b1f78f9e3ebc67f9395051595fc830a9e3', (SELECT sha256(html) FROM pages ORDER BY length(html), page_id LIMIT 1))""")
base("page_fields", """
SELECT filing_id, status, vendor_code, serial_number, class_type_code, origin_code, NULLIF(brand_name,'') AS brand_name, NULLIF(fanciful_name,'') AS fanciful_name,
  CAST(NULL AS VARCHAR) AS for_sale_in, CAST(NULL AS VARCHAR) AS formula, strftime(approval_date,'%Y-%m-%d') AS approval_date,
  'LABEL APPROVAL' AS type_of_application, 'VINE ' || vendor_code AS grape_varietals, serial_number || ' ml' AS total_bottle_capacity, CAST(year(partition_date) AS VARCHAR) AS wine_vintage,
  'Filed ' || strftime(filing_date,'%m/%d/%Y') || ' as is. Café — 😀 [1] Ž – © 2' AS qualifications, CAST(0 AS BIGINT) AS errors, true AS parsing_success FROM d""")
base("page_company_block", """
SELECT filing_id, 'DC-I-' || vendor_code AS plant_registry_number, applicant_business_name || ' & Sons' AS applicant_business_name,
  a AS address_line_1, 'UNIT 7' AS address_line_2, a || ', UNIT 7' AS applicant_mailing_address, 'ROY' AS contact_first_name, 'CLOUD' AS contact_last_name,
  'ROY CLOUD' AS contact_full_name, '(' || v || ') 555-0199' AS applicant_phone, v AS contact_phone_area_code, '555' AS contact_phone_exchange, '0199' AS contact_phone_number,
  '(' || v || ') 555-0199' AS applicant_fax
FROM (SELECT *, c_mktsegment || ' Street, ' || n_name || ', ' || r_name AS a, CASE WHEN length(vendor_code) > 3 THEN substr(vendor_code,1,3) ELSE lpad(vendor_code,3,'0') END AS v FROM detail_all)""")
base("page_certificates", """
SELECT filing_id, plant_registry_number, serial_number, CAST(NULL AS VARCHAR) AS brand_name, wine_appellation,
  printf('1 (555) %03d-%04d', first_supp % 1000, first_supp % 10000) AS applicant_phone, '' AS applicant_email, strftime(application_date,'%m-%d-%Y') AS application_date,
  strftime(approval_date,'%b %-d, %Y') AS approval_date, applicant_business_name, 'Dock ' || first_supp || ' North Road, Harbour' AS applicant_mailing_address, status,
  'DISTILLED SPIRITS' AS class_type_code, '81' AS ct_code, '51' AS or_code, '(Application was e-filed)' AS signature, finished = 1 AS signed, CASE WHEN finished = 1 THEN CAST(193 AS INT) END AS signature_width FROM c""")
base("page_checkboxes", """
SELECT filing_id, flag >= 2 AS domestic, flag < 2 AS imported, finished = 1 AS wine, flag >= 2 AS distilled_spirits, false AS malt_beverage,
  flag = 1 AS certificate_of_label_approval, flag = 2 AS certificate_of_exemption, flag = 3 AS distinctive_liquor_bottle_approval,
  finished = 0 AS resubmission_after_rejection FROM c""")
base("page_images", """
SELECT filing_id, CAST(0 AS BIGINT) AS position, '/publicViewAttachment.do?filename=front ' || serial_number || '.jpg&filetype=l' AS original_url, 'Brand (front)' AS type, CAST(308 AS INT) AS width,
  3.7::DOUBLE AS height_inches, 'front ' || serial_number || '.jpg' AS source_filename FROM c
UNION ALL SELECT filing_id, 1, '/publicViewAttachment.do?filename=back.jpg', 'Back', NULL, 3.7::DOUBLE, 'back.jpg' FROM c""")
base("image_counters", "SELECT filing_id, CAST(2 AS BIGINT) AS total_images, CAST(1 AS BIGINT) AS successful, CAST(1 AS BIGINT) AS failed FROM c")
plain("page_tables", "SELECT n_name AS code, 'Goods & wares of ' || r_name AS description, 'origin_code' AS kind FROM nation JOIN region ON n_regionkey = r_regionkey")
plain("binary_validation", """
WITH b AS (SELECT page_id, url, unhex(CASE page_id % 6 WHEN 0 THEN 'FFD8FF' WHEN 1 THEN '89504E470D0A1A0A' WHEN 2 THEN '474946383961' WHEN 3 THEN '52494646AABBCCDD57454250' WHEN 4 THEN '52494646' ELSE '00' END)
  || encode(CASE WHEN page_id % 7 = 0 THEN 'short' ELSE html END) AS content FROM pages)
SELECT page_id, CASE WHEN starts_with(url,'https') THEN NULL WHEN contains(url,'page=') THEN 'Image/PNG' ELSE 'text/html' END AS content_type,
  octet_length(content) >= 100 AND (page_id % 6 <= 3 OR (NOT starts_with(url,'https') AND contains(url,'page='))) AS valid, CAST(octet_length(content) AS BIGINT) AS file_size_bytes, sha256(content) AS file_hash FROM b""")

base("export_projection", company_export("coalesce(applicant_business_name,'') <> ''", "2001-12-31"))
base("upsert_dims", f"""
, o AS ({company_export("coalesce(applicant_business_name,'') <> '' AND partition_date < DATE '1998-01-01'", '1997-12-31')}),
n AS ({company_export("coalesce(applicant_business_name,'') <> '' AND partition_date >= DATE '1998-01-01'", '2001-12-31')})
SELECT * FROM n UNION ALL SELECT * FROM o WHERE company_key NOT IN (SELECT company_key FROM n)""")
base("upsert_facts", """
, all_facts AS (SELECT 'fact_products' AS fact, filing_id, company_key, serial_number, partition_date FROM fp
  UNION ALL SELECT 'fact_certificates', filing_id, company_key, serial_number, partition_date FROM fc)
SELECT fact, filing_id, company_key, CASE WHEN partition_date >= DATE '1998-01-01' THEN 'restated' ELSE serial_number END AS serial_number,
  CASE WHEN partition_date >= DATE '1998-01-01' THEN DATE '2001-12-31' ELSE DATE '1998-12-31' END AS partition_date FROM all_facts""")
FACTS_PUBLISHED = """
SELECT filing_id, company_key, CASE WHEN partition_date >= DATE '1998-01-01' THEN 'restated' ELSE serial_number END AS serial_number,
  CASE WHEN partition_date >= DATE '1998-01-01' THEN DATE '2001-12-31' ELSE DATE '1998-12-31' END AS partition_date FROM fp"""
base("merge_published", FACTS_PUBLISHED)
base("stream_published", FACTS_PUBLISHED)
base("consolidated_day", """
SELECT filing_id, has_detail, has_certificate, partition_date, CASE WHEN partition_date = (SELECT max(partition_date) FROM s) THEN round(data_completeness_score, 6) END AS data_completeness_score FROM s""")
base("accumulate_dims", f"""
SELECT md5(ckey) AS company_key, any_value(applicant_business_name) AS business_name, min(partition_date) AS first_seen_date, max(partition_date) AS last_seen_date, count(*) AS total_applications
FROM s WHERE coalesce(applicant_business_name,'') <> '' GROUP BY ckey""")
base("upsert_codes", "SELECT kind, code, CASE WHEN code = 'NATION_3' THEN description ELSE upper(description) END AS description FROM reference")
ORDER_ROWS = """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice,2) AS o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS partition_date, CAST(o_orderkey % 4 AS INT) AS receipt_method"""
plain("roundtrip_parquet", ORDER_ROWS + " FROM orders")
plain("roundtrip_json", ORDER_ROWS + " FROM orders")
plain("roundtrip_csv", ORDER_ROWS + """, '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags FROM orders""")
plain("landed_scan", f"""
SELECT {fid('page_id')} AS filing_id, page_id AS sequence, url, CAST(length(html) AS BIGINT) AS size_bytes, DATE '2024-01-01' AS partition_date, CAST(page_id % 4 AS INT) AS receipt_method, 'cola-detail' AS view FROM pages""")
base("id_mismatch", """
SELECT filing_id, CASE WHEN o_orderkey % 4 = 0 THEN '9' || substr(filing_id,2,13) ELSE filing_id END AS source_file, CASE WHEN o_orderkey % 4 = 0 AND substr(filing_id,1,1) <> '9' THEN true END AS mismatch FROM detail_all""")

HOUR = "strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start"
plain("run_health", window_hours() + f"SELECT {HOUR}, total_runs, failed_runs, successful_runs, round(rate,6) AS success_rate FROM r")
plain("run_health_stream", window_hours() + f"""
SELECT {HOUR}, total_runs, failed_runs, successful_runs, round(rate,6) AS success_rate FROM r""")
plain("health_alerts", window_hours() + f"SELECT {HOUR}, type, severity, message FROM a")
plain("alert_report", window_hours() + f"""
SELECT {HOUR}, count(*) FILTER (WHERE severity='high') AS high_alerts, count(*) FILTER (WHERE severity='medium') AS medium_alerts, count(*) FILTER (WHERE severity='low') AS low_alerts FROM a GROUP BY w""")
plain("check_rollup", f"""
SELECT {HOUR}, severity, count(*) AS failed_checks FROM (SELECT date_trunc('hour', ts) AS w, CASE WHEN value > 20 THEN 'ERROR' WHEN value > 5 THEN 'WARN' END AS severity FROM events WHERE event_type='error')
WHERE severity IS NOT NULL GROUP BY w, severity""")
plain("stream_ingest", f"SELECT CAST(doc_id AS VARCHAR) AS filing_id, md5({clean('text')}) AS brand_hash, lang FROM documents")
plain("stream_dedup", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS filing_id, DATE '2024-01-31' AS partition_date FROM events")
base("filings_from_pages", """
SELECT filing_id, has_detail, has_certificate, brand_name, status, CASE WHEN has_detail THEN applicant_business_name || ' & Sons' ELSE applicant_business_name END AS applicant_business_name FROM s""")
plain("landed_html", f"""
SELECT {fid('page_id')} AS filing_id, 'cola-detail' AS view, DATE '2024-01-01' + CAST(page_id % 3 AS INT) AS partition_date, CAST(page_id % 4 AS INT) AS receipt_method,
  CAST(octet_length(encode(html)) + 1 AS BIGINT) AS size_bytes, md5(html || chr(10)) AS html_md5,
  page_id % 3 = (SELECT max(page_id % 3) FROM pages) AS listed FROM pages""")
SPOILED = """
, landed AS (
  SELECT filing_id, 'cola-detail' AS view, fetched, o_orderkey AS k FROM detail_all UNION ALL SELECT filing_id, 'certificate', true, l_orderkey FROM c),
spoiled AS (
  SELECT CASE WHEN substr(filing_id,5,1) <> '2' THEN filing_id END AS filing_id, CASE WHEN substr(filing_id,5,1) = '1' THEN 'leaflet' ELSE view END AS view, fetched, k % 4 = 3 AS empty,
    k % 4 = 1 AS twice, landing
  FROM landed, (VALUES (CAST(1 AS INT)), (CAST(0 AS INT))) AS l(landing) WHERE landing = 1 OR k % 4 = 1),
marked AS (
  SELECT *, CASE WHEN NOT fetched THEN 'not_fetched' WHEN empty THEN 'unreadable' WHEN view = 'leaflet' THEN 'unknown_view' WHEN filing_id IS NULL THEN 'no_id'
      WHEN landing = 0 THEN 'replaced' ELSE 'kept' END AS outcome,
    array_to_string(list_filter([CASE WHEN NOT fetched THEN 'Not fetched' END, CASE WHEN empty THEN 'No html' END, CASE WHEN view = 'leaflet' THEN 'Unknown data type: leaflet' END,
      CASE WHEN filing_id IS NULL THEN 'No filing id' END], lambda x: x IS NOT NULL), '; ') AS errors
  FROM spoiled)"""
base("page_rejects", SPOILED + " SELECT filing_id, view, landing, outcome, errors FROM marked WHERE outcome <> 'kept'")
base("page_outcomes", SPOILED + " SELECT view, outcome, count(*) AS pages, CAST(sum(count(*)) OVER () AS BIGINT) AS landed FROM marked GROUP BY view, outcome")
plain("filings_from_html", f"""
SELECT {fid('s_suppkey')} AS filing_id, true AS has_detail, s_acctbal >= 0 AS has_certificate, s_name || ' & Sons' AS brand_name, 'APPROVED' AS status,
  CASE WHEN s_acctbal >= 0 THEN 'THE STATUS IS APPROVED.' END AS cert_status, s_name AS applicant_business_name, DATE '2024-01-01' + CAST(s_nationkey AS INT) AS partition_date FROM supplier""")
base("export_products", """
SELECT * EXCLUDE (alcohol_content, data_quality_score), round(CAST(alcohol_content AS DOUBLE), 6) AS alcohol_content,
  round(CAST(data_quality_score AS DOUBLE), 6) AS data_quality_score, DATE '2001-12-31' AS partition_date FROM products""")
base("export_images", """
SELECT filing_id, CASE WHEN finished = 1 THEN '/publicViewAttachment.do?filename=front ' || serial_number || '.jpg&filetype=l|/publicViewAttachment.do?filename=back.jpg' END AS urls,
  CASE WHEN finished = 1 THEN CAST(2 AS INT) END AS images, partition_date FROM c""")
base("nested_columns_dropped", "SELECT filing_id, status, 'label_images,signatures' AS dropped FROM c")
plain("json_arrays", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
plain("backfill_days", """
SELECT today, first_day, last_day, CAST(first_day - last_day AS INT) AS days_back FROM (
  SELECT today, CAST(today - INTERVAL 2 DAY AS DATE) AS first_day, greatest(CAST(today - INTERVAL 365 DAY AS DATE), DATE '2015-01-01') AS last_day
  FROM (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) + INTERVAL 240 MONTH AS DATE) AS today FROM orders))""")
base("location_states", f"""
SELECT {key32('origin_code')} AS location_id, origin_code, d AS origin_description, NULLIF(regexp_extract(d, '\\b([A-Z]{{2}})\\b', 1), '') AS state,
  CASE WHEN regexp_matches(d,'CA|NY|TX|FL|WA') THEN 'USA' ELSE 'Other' END AS country, NULLIF(regexp_extract(d, '\\b([A-Z]{{2}})\\b', 1), '') AS region,
  regexp_matches(d,'CA|NY|TX|FL|WA') AS is_domestic
FROM (SELECT DISTINCT origin_code, 'Goods of nation ' || split_part(origin_code,'_',2) || CASE CAST(split_part(origin_code,'_',2) AS INT) % 3 WHEN 0 THEN ', NY' WHEN 1 THEN ' (CA WEST)' ELSE '' END AS d
  FROM s WHERE coalesce(origin_code,'') <> '')""")
