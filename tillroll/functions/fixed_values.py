"""Lists, patterns and thresholds that define the metrics."""

# Stock codes that are charges, not products (compared upper-case and trimmed).
OPERATIONAL_STOCK_CODES = [
    "M", "DOT", "D", "CRUK", "POST", "BANK CHARGES", "AMAZONFEE", "S",
]

# Prefixes of further charge codes.
OPERATIONAL_CODE_PATTERN = "^(?:DOT|POST|BANK|AMAZON|DCGS|TEST|ADJUST)"

# Words that mark a charge anywhere in a description, in any case.
OPERATIONAL_DESCRIPTION_PATTERN = (
    "(?i)manual|postage|discount|commission|damage|damaged|damages|ebay|"
    "amazon|bank charge|adjust|adjustment|found|lost|missing|"
    "unsaleable|destroyed|samples?|mailout|check"
)

# Country labels that need a manual mapping.
COUNTRY_EXCEPTIONS = [
    "EIRE", "RSA", "USA", "Unspecified", "European Community", "Channel Islands", "West Indies",
]

# Raw header (lower-case, without spaces and underscores) to column name.
HEADER_ALIASES = {
    "invoiceno": "invoice_number",
    "invoice": "invoice_number",
    "stockcode": "stock_code",
    "description": "description",
    "quantity": "quantity",
    "invoicedate": "invoice_date",
    "price": "unit_price",
    "unitprice": "unit_price",
    "customerid": "customer_id",
    "country": "country",
}

# Product return risk.
HIGH_REVENUE_PERCENTILE = "0.75"
HIGH_REVENUE_LINE_RATE = 0.08
HIGH_LINE_RATE = 0.15
HIGH_UNIT_RATE = 0.10
RISK_LABELS = ["High revenue / high return", "High return rate", "Unit return risk", "Normal"]

# Days since the last order: right-closed upper edges and labels.
RECENCY_EDGES = [30, 90, 180, 365]
RECENCY_LABELS = ["0-30 days", "31-90 days", "91-180 days", "181-365 days", "365+ days"]

# A line is an outlier beyond either of these.
OUTLIER_PRICE = 1000
OUTLIER_QUANTITY = 1000

# Bubble sizes are clipped to this percentile.
BUBBLE_PERCENTILE = "0.95"

HOME_COUNTRY = "United Kingdom"

# Text that stands for a missing value in the source files.
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Column captions for report tables.
READABLE_NAMES = {
    "total_revenue": "Total Revenue",
    "total_invoices": "Total Invoices",
    "customer_lifetime_value": "Customer Lifetime Value",
    "repeat_purchase_rate": "Repeat Purchase Rate",
    "country_name": "Country",
    "quantity_sold": "Quantity Sold",
}

# Forms of dates in source files besides ISO (month first).
DATE_PATTERNS = ["M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy"]

# Shown where no country needs a manual mapping.
NO_EXCEPTIONS = "No known mapping exceptions in selected filters"
