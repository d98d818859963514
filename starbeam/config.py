"""Parameters of the warehouse: as-of date, thresholds, recode tables.

Everything that the reference evaluates against "today" takes ``as_of`` instead, so
a run gives the same answer every time. Thresholds are parameters because the right
values depend on the currency and size of the data.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the source system's codes and labels.
# ---------------------------------------------------------------------------

# Null markers that the original CSV reader turns into missing values.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")

# Gender codes (customer master and ERP demographics). Upper-cased, trimmed input.
GENDER_CODES = {"M": "Male", "F": "Female", "MALE": "Male", "FEMALE": "Female"}
GENDER_NULL_CODES = ("N/A", "NAS")

# Marital status codes. Upper-cased, trimmed input.
MARITAL_CODES = {"S": "Single", "M": "Married", "SINGLE": "Single", "MARRIED": "Married"}

# Country codes. Trimmed input; blank or missing becomes UNKNOWN_TEXT.
COUNTRY_CODES = {
    "DE": "Germany",
    "US": "United States",
    "USA": "United States",
    "GB": "United Kingdom",
    "UK": "United Kingdom",
    "FR": "France",
    "AU": "Australia",
    "CA": "Canada",
}

# Product line codes (trimmed); a missing code becomes "n/a".
PRODUCT_LINES = {"R": "Road", "M": "Mountain", "S": "Other Sales", "T": "Touring"}
PRODUCT_LINE_MISSING = "n/a"

# CRM columns that may hold the ERP id.
CUSTOMER_KEYS = ("cst_id", "cst_key")

UNKNOWN_TEXT = "Unknown"

# Forms of date text tried in this order after the ISO forms.
DATE_FORMATS = ("M/d/yyyy", "yyyy/M/d")

# Age bins: right-closed (lower, upper] with their labels.
AGE_BINS = ((0, 19, "Under 20"), (19, 29, "20-29"), (29, 39, "30-39"),
            (39, 49, "40-49"), (49, 999, "50 and above"))

CUSTOMER_SEGMENTS = ("VIP", "Regular", "New")
PRODUCT_SEGMENTS = ("High-Performer", "Mid-Range", "Low-Performer")
WEEKEND_DAYS = ("Saturday", "Sunday")
YEAR_COMPARE = ("Above Average", "Below Average", "Average")
LAST_YEAR_COMPARE = ("Better Performance", "Worse Performance", "Same Performance")
PRODUCT_AVG_COMPARE = ("Above Avg", "Below Avg", "Avg")
PRODUCT_PREV_COMPARE = ("Increase", "Decrease", "No Change")

# Measure names of the key-metrics summary, in output order.
KEY_METRICS = ("Total Sales", "Total Quantity", "Average Price", "Total Orders",
               "Total Products", "Total Customers")


@dataclass(frozen=True)
class Params:
    """Run parameters. Defaults are the source system's; fixtures pass their own."""

    as_of: dt.date = dt.date(2025, 1, 31)
    # customer segmentation: VIP needs lifespan >= months and sales > vip_sales
    vip_sales: float = 5000.0
    segment_months: int = 12
    # product segmentation: > high is High-Performer, >= mid is Mid-Range
    product_high_sales: float = 50000.0
    product_mid_sales: float = 10000.0
    # product cost ranges (three bounds -> four labelled ranges)
    cost_bounds: tuple = (100, 500, 1000)
    # top / bottom sizes of the ranking queries
    top_customers_revenue: int = 20
    top_products: int = 5
    bottom_products: int = 5
    top_customers_ranked: int = 10
    fewest_order_customers: int = 10
    # CRM column that is matched with the ERP ids, and the least share of customers that must find theirs
    customer_join_key: str = "cst_id"
    min_customer_match_rate: float = 0.0
    # unit cost of the profit: a column of the sales lines or else of the product dimension
    profit_cost: str = "prd_cost"
    # form of dates such as 3/4/2012: "vote" (each column's own values decide), "day" or "month"
    date_order: str = "vote"
    # collation of keys, groups and order of the gold layer's text (such as UNICODE_CI_AI); None compares bytes
    collation: str | None = None
    role_overrides: dict = field(default_factory=dict)


DEFAULT = Params()

# Thresholds chosen from the test-data star adapter (sf0.01 distribution) so that
# every segment and cost range is hit.
FIXTURE = Params(
    vip_sales=52_300_000.0,
    product_high_sales=44_300_000.0,
    product_mid_sales=36_100_000.0,
    cost_bounds=(920, 950, 980),
)
