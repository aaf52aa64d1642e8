"""Fixed values that results depend on. Change none of these without rebuilding history."""

from __future__ import annotations

import datetime as dt

# Change hash and hash keys.
HASH_SEPARATOR = "||"

# Calendar dimension bounds (both days included).
CALENDAR_FROM = dt.date(2023, 1, 1)
CALENDAR_TO = dt.date(2027, 12, 31)
FIRST_WEEK_LAST_DAY = 7

# Daily sales mart segment.
PREMIUM_THRESHOLD = 200
PREMIUM = "Premium"
BASIC = "Basic"

# Text patterns; \z is the very end of the text (Java's $ also matches before a final newline).
DIGITS = r"^\d+\z"
DECIMAL = r"^\d+(\.\d+)?\z"
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\z"
NON_DIGIT = r"\D"
DATE_PATTERN = "yyyy-M-d"

# Text length limits of the cleaned and mart tables.
TEXT_LIMITS = {
    "customers": {"email": 100, "phone": 20, "city": 50},
    "products": {"name": 100},
    "customer_status": {"status": 20},
    "mart_daily_sales": {"product_name": 100, "customer_segment": 20},
    "mart_customer_360": {"last_email": 100, "last_city": 50},
}

# Business rules.
ACTIVE_DAYS = 90
RECENT_SPEND_DAYS = 30
ORDER_STATUS_CHAIN = ("created", "paid", "shipped", "delivered", "cancelled")
