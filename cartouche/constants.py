"""Fixed values.

Every literal below has to equal the published filing conventions for results to
be right (page labels, word lists, thresholds, weights, patterns). They are kept
together and in their natural order; no logic lives here.
"""

# --- views and receipt methods -------------------------------------------------
DETAIL = "cola-detail"
CERTIFICATE = "certificate"
RECEIPT_METHODS = {1: "e-filed", 2: "mailed", 3: "overnight", 0: "hand delivered"}
METHOD_ORDER = [1, 2, 3, 0]
VIEW_ORDER = [DETAIL, CERTIFICATE]

# --- landing -------------------------------------------------------------------
ERROR_PAGE_SHA256 = "50fa048f9cf8200c3d82d60add59b3b1f78f9e3ebc67f9395051595fc830a9e3"
MAX_CONSECUTIVE_FAILURES = 10
STOP_AFTER_FOUND_DAYS = 3
BACKFILL_DAYS = 365
EARLIEST_DAY = "2015-01-01"

# --- text ----------------------------------------------------------------------
ADDRESS_ABBREVIATIONS = [
    ("STREET", "ST"),
    ("AVENUE", "AVE"),
    ("BOULEVARD", "BLVD"),
    ("ROAD", "RD"),
    ("DRIVE", "DR"),
    ("COURT", "CT"),
    ("LANE", "LN"),
    ("PLACE", "PL"),
    ("NORTH", "N"),
    ("SOUTH", "S"),
    ("EAST", "E"),
    ("WEST", "W"),
]
STATE_CODES = {"CALIFORNIA": "CA", "NEW YORK": "NY", "TEXAS": "TX", "FLORIDA": "FL"}
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
URL_PATTERN = r"(?i)^https?://[^\s/$.?#].[^\s]*$"
ZIP_PATTERN = r"(?U)\b([0-9]{5}(?:-[0-9]{4})?)\b"

# --- dates ---------------------------------------------------------------------
DATE_FORMATS = ["%m/%d/%Y", "%m-%d-%Y", "%Y-%m-%d", "%B %d, %Y", "%b %d, %Y", "%m/%d/%y", "%m-%d-%y"]
LEGACY_DATE_FORMATS = ["%Y-%m-%d", "%m/%d/%Y", "%Y-%m-%d %H:%M:%S"]
HOLIDAYS = ["01-01", "07-04", "12-25"]

# --- beverage classification ---------------------------------------------------
BEVERAGE_WORDS = [
    ("WINE", ["wine", "vintner", "winery", "grape"]),
    ("BEER", ["beer", "brewery", "ale", "lager", "stout"]),
    ("SPIRITS", ["spirit", "whiskey", "vodka", "rum", "gin", "distillery"]),
    ("OTHER_FERMENTED", ["cider", "mead", "sake"]),
]
CATEGORY_WORDS = [
    ("WINE", ["wine", "vintner", "winery"]),
    ("BEER", ["beer", "ale", "lager"]),
    ("SPIRITS", ["spirit", "whiskey", "vodka"]),
]
FLAG_WORDS = {
    "is_wine": ["wine"],
    "is_beer": ["beer", "malt"],
    "is_spirits": ["spirit", "distilled"],
}
TYPE_WORDS = {
    "Wine": ["wine", "grape"],
    "Beer": ["beer", "malt", "ale", "lager"],
    "Spirits": ["spirit", "whiskey", "vodka", "gin", "rum"],
}
DOMESTIC_MARKS = ["CA", "NY", "TX", "FL", "WA"]

# --- measures ------------------------------------------------------------------
ALCOHOL_PATTERNS = [
    r"([0-9]+\.?[0-9]*)(?U:\s*)%(?U:\s*)(?:abv|alcohol)",
    r"(?:abv|alcohol)(?U:\s*):?(?U:\s*)([0-9]+\.?[0-9]*)(?U:\s*)%?",
    r"([0-9]+\.?[0-9]*)(?U:\s*)%",
]
CONTAINER_PATTERNS = [
    (r"750(?U:\s*)ml", "750ml"),
    (r"375(?U:\s*)ml", "375ml"),
    (r"1\.5(?U:\s*)l|1500(?U:\s*)ml", "1.5L"),
    (r"3(?U:\s*)l|3000(?U:\s*)ml", "3L"),
    (r"12(?U:\s*)oz", "12oz"),
    (r"16(?U:\s*)oz", "16oz"),
    (r"22(?U:\s*)oz", "22oz"),
]
CONTAINER_GENERIC = r"([0-9]+\.?[0-9]*)(?U:\s*)(ml|l|oz|gallon)"
TRUE_WORDS = ["true", "yes", "1", "on"]

# --- merge ---------------------------------------------------------------------
APPLICANT_FIELDS = [
    "applicant_business_name",
    "applicant_mailing_address",
    "applicant_phone",
    "applicant_email",
    "applicant_fax",
]
UNPREFIXED_FIELDS = ["filing_id", "view", "cleaning_timestamp", "cleaning_version"]
CERT_ONLY_COPIES = [
    "certificate_number",
    "certificate_status",
    "certificate_type",
    "application_date",
    "approval_date",
    "plant_registry_number",
]

# --- scoring -------------------------------------------------------------------
COMPLETENESS_BASE = ["filing_id", "applicant_business_name", "applicant_mailing_address"]
COMPLETENESS_DETAIL = ["brand_name", "product_description", "approval_date"]
LEGACY_COMPLETENESS = [
    "filing_id",
    "applicant_business_name",
    "applicant_mailing_address",
    "cola_brand_name",
    "cola_product_description",
    "cola_approval_date",
]
CRITICAL_FIELDS = ["filing_id", "applicant_business_name"]
LEGACY_CRITICAL = [
    "filing_id",
    "applicant_business_name",
    "cola_brand_name",
    "cola_product_description",
    "cola_approval_date",
]
LEGACY_IMPORTANT = [
    "cola_filing_date",
    "cola_net_contents",
    "cola_alcohol_content",
    "cola_product_class_type",
    "cola_origin_code",
]
LEGACY_OPTIONAL = [
    "cola_fanciful_name",
    "cola_formula_number",
    "applicant_phone",
    "applicant_email",
    "applicant_mailing_address",
]
QUALITY_TIERS = {
    "premium": {
        "min_score": 0.9,
        "required_fields": LEGACY_COMPLETENESS,
        "required_flags": ["filing_id_valid", "product_class_validation_is_valid"],
    },
    "standard": {
        "min_score": 0.7,
        "required_fields": ["filing_id", "applicant_business_name", "cola_brand_name"],
        "required_flags": ["filing_id_valid"],
    },
}

# --- structuring ---------------------------------------------------------------
STRUCTURED_DATES = ["filing_date", "approval_date", "expiration_date", "cert_application_date", "cert_approval_date"]
STRUCTURED_FLAGS = [
    "has_detail",
    "has_certificate",
    "cert_applicant_signature_present",
    "cert_authorized_signature_present",
]
STRUCTURED_NUMBERS = ["data_completeness_score", "final_quality_score", "days_to_approval"]
STRUCTURED_TEXT = [
    "applicant_business_name",
    "applicant_mailing_address",
    "brand_name",
    "fanciful_name",
    "product_description",
    "cert_certificate_status",
    "cert_certificate_type",
]

# --- pages ---------------------------------------------------------------------
DETAIL_LABELS = [
    ("filing_id", "TTB ID:"),
    ("status", "Status:"),
    ("vendor_code", "Vendor Code:"),
    ("serial_number", "Serial #:"),
    ("class_type_code", "Class/Type Code:"),
    ("origin_code", "Origin Code:"),
    ("brand_name", "Brand Name:"),
    ("fanciful_name", "Fanciful Name:"),
    ("type_of_application", "Type of Application:"),
    ("grape_varietals", "Grape Varietal"),
    ("for_sale_in", "For Sale In:"),
    ("total_bottle_capacity", "Total Bottle Capacity:"),
    ("wine_vintage", "Wine Vintage:"),
    ("formula", "Formula"),
    ("approval_date", "Approval Date:"),
    ("plant_registry_number", "Plant Registry/Basic Permit/Brewers No"),
]
CERTIFICATE_NUMBERS = [
    ("plant_registry_number", 2),
    ("serial_number", 4),
    ("brand_name", 6),
    ("fanciful_name", 7),
    ("grape_varietals", 10),
    ("wine_appellation", 11),
    ("applicant_phone", 12),
    ("applicant_email", 13),
    ("application_date", 16),
    ("approval_date", 19),
]
SIGNATURE_NUMBER = 17
PERMIT_PATTERN = r"^[A-Z]{2}-[A-Z]-[0-9]+$"
PHONE_PATTERN = r"\(([0-9]{3})\)(?U:\s*)([0-9]{3})-([0-9]{4})"
FAX_PATTERNS = [
    r"(?i)fax(?U:\s*):(?U:\s*)\(([0-9]{3})\)(?U:\s*)([0-9]{3})-([0-9]{4})",
    r"(?i)fax(?U:\s*)([0-9]{3})-([0-9]{3})-([0-9]{4})",
]
CONTACT_NAME_PATTERN = r"^[A-Z]+(?U:\s+)[A-Z]+$"
STATUS_MARK = "THE STATUS IS"
CLASS_MARK = "TABLE.*WINE|DISTILLED SPIRITS|MALT BEVERAGE"
QUALIFICATION_MARK = "TTB has not reviewed"
APPLICANT_BLOCK_MARK = "8.*NAME AND ADDRESS OF APPLICANT"
IMAGE_MARK = "publicViewAttachment"
SIGNATURE_MARK = "publicViewSignature"
IMAGE_SIZE_PATTERN = (
    r"([0-9]+\.?[0-9]*)(?U:\s*)inches?(?U:\s*)W(?U:\s*)[Xx×](?U:\s*)([0-9]+\.?[0-9]*)(?U:\s*)inches?(?U:\s*)H"
)
CHECKBOXES = [
    ("source_of_product", "domestic", ["domestic"], []),
    ("source_of_product", "imported", ["imported"], []),
    ("product_type", "wine", ["wine"], ["distilled"]),
    ("product_type", "distilled_spirits", ["distilled spirits"], []),
    ("product_type", "malt_beverage", ["malt beverage"], []),
    ("application_type", "certificate_of_label_approval", ["certificate of label approval"], []),
    ("application_type", "certificate_of_exemption", ["certificate of exemption"], []),
    ("application_type", "distinctive_liquor_bottle_approval", ["distinctive liquor bottle"], []),
    ("application_type", "resubmission_after_rejection", ["resubmission"], []),
]
REFERENCE_TABLE_HEADERS = [
    ("product_class_type", "Class/Type Code"),
    ("origin_code", "Origin Code"),
]
REFERENCE_DESCRIPTION_HEADER = "Description"
REFERENCE_CODE_LENGTH = 10
IMAGE_MAGIC = ["FFD8FF", "89504E470D0A1A0A", "474946383761", "474946383961"]
IMAGE_MIN_BYTES = 100

# --- checks --------------------------------------------------------------------
ESSENTIAL_FIELDS = {
    DETAIL: [
        "filing_id",
        "serial_number",
        "filing_date",
        "applicant_business_name",
        "brand_name",
        "product_description",
        "net_contents",
    ],
    CERTIFICATE: [
        "filing_id",
        "certificate_number",
        "effective_date",
        "trade_name",
        "premises_address",
        "permit_type",
    ],
}
COVERAGE_METADATA = [
    "extraction_timestamp",
    "source_file",
    "partition_date",
    "receipt_method",
    "view",
    "parsing_success",
]
PRIMARY_KEYS = {
    "dim_dates": "date_id",
    "dim_companies": "company_key",
    "dim_products": "product_key",
    "fact_products": "filing_id",
    "fact_certificates": "filing_id",
}
