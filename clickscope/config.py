"""Query parameters.

The reference reads these from a properties file holding relaxed JSON; here
they are a plain dataclass handed to the operators by the caller.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Condition:
    """Filter for the action log (B1) and parameters of the page report.

    Empty strings and zero ages mean "no predicate", as in the reference.
    ``professionals``, ``city``, ``gender``, ``keywords`` and ``category_ids``
    are declared but unused by the reference; here they are optional
    comma-separated allow-lists (empty = no filter).
    """

    start_date: str = ""
    end_date: str = ""
    start_age: int = 0
    end_age: int = 0
    professionals: str = ""
    city: str = ""
    gender: str = ""
    keywords: str = ""
    category_ids: str = ""
    target_page_flow: str = ""


# Parameters used against the driver's test tables (FIXTURES.md section 2).
DEFAULT_CONDITION = Condition(
    start_date="2024-01-05",
    end_date="2024-01-25",
    start_age=20,
    end_age=50,
    target_page_flow="1,2,3,4,5,6,7",
)

# Fixed values of the reports.
TOP_CATEGORIES = 10          # category_top10
TOP_SESSIONS = 10            # sessions kept per top category
TOP_PRODUCTS = 3             # rank <= 3 per area (ties kept)
TOP_CITIES = 2               # named cities in the city remark
TOP_ADS = 3                  # ads kept per (day, area)
BLACKLIST_THRESHOLD = 100    # clicks per (user, day, ad) that list a user
OTHER_LABEL = "其他"         # label of the residual share in the city remark
LAST_HOUR_MINUTES = 60       # window of the last-hour report

# Result table names of the reference, spelled as it spells them.
REPORT_TABLES = ("category_top10", "category_top10_session_count", "page_conversion_rate",
                 "arer_product_click")

# Percent patterns (java.text.DecimalFormat syntax, as used by format_number).
PAGE_RATE_PATTERN = ".00%"
CITY_SHARE_PATTERN = "0.00%"


@dataclass(frozen=True)
class CheckParams:
    """Parameters of the registered test queries (FIXTURES.md section 2)."""

    condition: Condition = DEFAULT_CONDITION
    blacklist_threshold: int = 4
    other_label: str = "other"
    task_id: str = "check"


CHECK = CheckParams()
