"""Fixed values.

FIXED VALUES: these lists must equal the behaviour being reproduced for
results to match (rule order matters: the first matching rule wins). They are
stated plainly, in their natural order, and are only defaults: every operator
that uses them takes its own rule table as an argument.
"""

from __future__ import annotations

# ---------------------------------------------------------------- domains
# FIXED VALUES: top-level categories.
TOP_CATEGORIES = ["consumer_goods", "electronics", "industrial", "automotive", "other"]

# FIXED VALUES: sub-categories.
SUB_CATEGORIES = [
    "animal_products", "vegetable_products", "food_beverages", "minerals_fuels",
    "chemicals_pharma", "plastics_rubber", "leather_goods", "wood_paper",
    "textiles_apparel", "footwear_accessories", "construction_materials",
    "jewelry", "metals", "machinery", "computers_electronics",
    "consumer_appliances", "vehicles_transport", "instruments",
    "arms_ammunition", "furniture_misc", "art_antiques", "uncategorized",
]

# FIXED VALUES: confidence flags, best first.
CONFIDENCE_FLAGS = ["high", "medium", "review_required"]

# FIXED VALUES: lineage of the seed table's records, and the name of the
# primary (official) source that wins conflicts by default.
SEED_SOURCE_NAME = "Embedded Fallback (CBIC 2025)"
SEED_SOURCE_URL = "https://www.cbic-gst.gov.in"
PRIMARY_SOURCE_NAME = "CBIC GST Goods Rates"

DEFAULT_TOP = "other"
DEFAULT_SUB = "uncategorized"
DEFAULT_TEMPLATE_SUB = "furniture_misc"

# ------------------------------------------------------------ range rules
# FIXED VALUES: (first chapter, last chapter, top category, sub-category);
# chapter = integer value of the first two characters of the code.
HSN_RANGE_RULES = [
    (1, 5, "consumer_goods", "animal_products"),
    (6, 14, "consumer_goods", "vegetable_products"),
    (15, 24, "consumer_goods", "food_beverages"),
    (25, 27, "industrial", "minerals_fuels"),
    (28, 38, "industrial", "chemicals_pharma"),
    (39, 40, "industrial", "plastics_rubber"),
    (41, 43, "consumer_goods", "leather_goods"),
    (44, 49, "industrial", "wood_paper"),
    (50, 63, "consumer_goods", "textiles_apparel"),
    (64, 67, "consumer_goods", "footwear_accessories"),
    (68, 70, "industrial", "construction_materials"),
    (71, 71, "consumer_goods", "jewelry"),
    (72, 83, "industrial", "metals"),
    (84, 85, "electronics", "computers_electronics"),
    (86, 89, "automotive", "vehicles_transport"),
    (90, 92, "electronics", "instruments"),
    (93, 93, "other", "arms_ammunition"),
    (94, 96, "consumer_goods", "furniture_misc"),
    (97, 97, "consumer_goods", "art_antiques"),
]

# ---------------------------------------------------------- keyword rules
# FIXED VALUES: (keyword, top category) in priority order; a keyword matches
# when it is a substring of the lower-cased description.
KEYWORD_RULES = [
    ("mobile", "electronics"), ("smartphone", "electronics"),
    ("laptop", "electronics"), ("computer", "electronics"),
    ("television", "electronics"), ("tv", "electronics"),
    ("tablet", "electronics"), ("monitor", "electronics"),
    ("printer", "electronics"), ("camera", "electronics"),
    ("headphone", "electronics"), ("speaker", "electronics"),
    ("refrigerator", "electronics"), ("washing machine", "electronics"),
    ("air conditioner", "electronics"), ("microwave", "electronics"),
    ("fan", "electronics"), ("led", "electronics"),
    ("charger", "electronics"), ("battery", "electronics"),
    ("inverter", "electronics"), ("motor", "electronics"),
    ("transformer", "electronics"), ("cable", "electronics"),
    ("wire", "electronics"), ("car", "automotive"),
    ("motorcycle", "automotive"), ("scooter", "automotive"),
    ("tyre", "automotive"), ("tire", "automotive"),
    ("vehicle", "automotive"), ("automobile", "automotive"),
    ("tractor", "automotive"), ("engine", "automotive"),
    ("medicine", "consumer_goods"), ("pharmaceutical", "consumer_goods"),
    ("drug", "consumer_goods"), ("surgical", "consumer_goods"),
    ("fertilizer", "industrial"), ("cement", "industrial"),
    ("steel", "industrial"), ("iron", "industrial"),
    ("aluminium", "industrial"), ("copper", "industrial"),
    ("plastic", "industrial"), ("rubber", "industrial"),
    ("petroleum", "industrial"), ("coal", "industrial"),
]

# FIXED VALUES: keyword -> sub-category (keywords not listed -> uncategorized).
KEYWORD_SUB = {
    "mobile": "computers_electronics", "smartphone": "computers_electronics",
    "laptop": "computers_electronics", "computer": "computers_electronics",
    "television": "consumer_appliances", "tv": "consumer_appliances",
    "refrigerator": "consumer_appliances", "washing machine": "consumer_appliances",
    "air conditioner": "consumer_appliances", "microwave": "consumer_appliances",
    "fan": "consumer_appliances", "car": "vehicles_transport",
    "motorcycle": "vehicles_transport", "tractor": "vehicles_transport",
    "medicine": "chemicals_pharma", "pharmaceutical": "chemicals_pharma",
}

# ----------------------------------------------------------- field aliases
# FIXED VALUES: canonical field -> header aliases, fields and aliases in
# priority order. Headers and aliases are compared after lower-casing and
# dropping every character outside [a-z0-9].
FIELD_ALIASES = [
    ("hsn_code", ["hsn", "hsn_code", "hsn_sac", "hsn_sac_code", "hsncode",
                  "chapter_heading", "heading", "tariff", "tariff_item"]),
    ("description", ["description", "desc", "goods_description",
                     "description_of_goods", "particulars", "commodity", "item",
                     "product", "description_of_supply", "name_of_commodity"]),
    ("rate", ["rate", "gst_rate", "tax_rate", "rate_of_tax", "rate_of_gst",
              "applicable_rate", "gst"]),
    ("cgst_rate", ["cgst", "cgst_rate", "cgst_percent", "central_gst"]),
    ("sgst_rate", ["sgst", "sgst_rate", "sgst_percent", "state_gst", "utgst"]),
    ("igst_rate", ["igst", "igst_rate", "igst_percent", "integrated_gst"]),
    ("cess_rate", ["cess", "cess_rate", "compensation_cess", "cess_percent"]),
    ("serial_no", ["serial_no", "sr_no", "s_no", "sl_no", "sno", "sr", "serial",
                   "no", "serial_number"]),
    ("schedule", ["schedule", "sched", "schedule_no", "annexure"]),
    ("effective_from", ["effective_from", "effective_date", "w_e_f", "wef", "date",
                        "notification_date"]),
]

# ------------------------------------------------------------- rate words
# FIXED VALUES: rate texts that mean zero (after lower-casing and trimming).
RATE_ZERO_WORDS = ["nil", "exempt", "exempted", "-", "", "n/a", "na", "free", "0"]
# FIXED VALUES: zero words of the record-level coercion (no "free", no "0").
COERCE_ZERO_WORDS = ["nil", "exempt", "exempted", "-", "", "n/a", "na"]

# ------------------------------------------------------------ date formats
# FIXED VALUES: accepted date layouts, tried in this order (strptime names,
# followed by the equivalent Spark pattern).
DATE_FORMATS = [
    ("%d-%m-%Y", "d-M-yyyy"),
    ("%d/%m/%Y", "d/M/yyyy"),
    ("%Y-%m-%d", "yyyy-M-d"),
    ("%d.%m.%Y", "d.M.yyyy"),
    ("%d %b %Y", "d MMM yyyy"),
    ("%d %B %Y", "d MMMM yyyy"),
    ("%B %d, %Y", "MMMM d, yyyy"),
    ("%b %d, %Y", "MMM d, yyyy"),
    ("%d-%b-%Y", "d-MMM-yyyy"),
    ("%d-%B-%Y", "d-MMMM-yyyy"),
]
# FIXED VALUES: texts that mean "no date".
DATE_NULL_WORDS = ["", "-", "n/a", "na"]

# ---------------------------------------------------------- table scoring
# FIXED VALUES: words that mark a rate table when found in its header text
# and first three data rows.
TABLE_KEYWORDS = ["hsn", "rate", "gst", "cgst", "sgst", "igst", "description",
                  "goods", "tax", "cess", "slab"]
# FIXED VALUES: class pattern of fallback <div> containers (case-insensitive).
DIV_CLASS_PATTERN = "table|rate|schedule"

# ---------------------------------------------------------------- formats
# FIXED VALUES: output texts and separators (Python format fields).
ISSUE_MISSING_HSN = "Missing HSN code. Description: {desc80}"
ISSUE_NEGATIVE = "Negative {field}: {value}"
ISSUE_INVALID_TOP = "Invalid top_category: {value}"
ISSUE_INVALID_SUB = "Invalid sub_category: {value}"
ISSUE_ZERO_RATES = "All rates are zero. May be exempt. Desc: {desc60}"
ISSUE_DUPLICATE = "Duplicate of record {first_id}. HSN={hsn}, Rate={rate}%"
ISSUE_CONFLICT = "Rate conflict for HSN {hsn}: {sources}. Primary rate ({rate}%) takes precedence."
CONFLICT_SOURCE_ITEM = "{source}={rate}%"
CONFLICT_SOURCE_SEP = ", "
PRODUCT_NAME = "{brand} {name} - {variant}"
SIMPLE_PRODUCT_NAME = "{desc} - Variant {n}"
CATALOG_ID_PREFIX = "catalog"
ID_SEPARATOR = "|"
RAW_TEXT_SEPARATOR = " | "
BLANK_HEADER = "col_{i}"
CACHE_SUFFIX = ".html"

# ----------------------------------------------------------------- ledger
# FIXED VALUES: job priority order (unknown values sort first).
PRIORITY_ORDER = ["high", "medium", "low"]
JOB_STATUSES = ["pending", "in_progress", "completed", "failed", "skipped"]
STALE_MINUTES = 30

# ------------------------------------------------------------- lookups
# FIXED VALUES: (default, max) result limits of the four lookups.
LIMIT_PRODUCT = (5, 20)
LIMIT_DESCRIPTION = (10, 30)
LIMIT_CODE = (10, 20)
CATEGORY_GROUP_CAP = 100
ISSUE_REPORT_CAP = 10_000
EXPORT_CHUNK_ROWS = 500_000
PAD_CHUNK = 1_000
