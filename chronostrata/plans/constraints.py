"""What each table of the warehouse promises. Text limits are in `fixed_values`."""

from __future__ import annotations

from chronostrata.fixed_values import TEXT_LIMITS
from chronostrata.operators.constraints import Constraints

_HISTORY_RULES = {"period_order": "valid_to IS NULL OR valid_to > valid_from"}


def _history(sk: str) -> Constraints:
    return Constraints(
        not_null=(sk, "customer_bk", "hashdiff", "valid_from", "created_at", "updated_at"),
        rules=_HISTORY_RULES,
        unique=((sk,), ("customer_bk", "valid_from")),
        unique_where={"one_open": (("customer_bk",), "valid_to IS NULL")},
    )


CONSTRAINTS = {
    "customers": Constraints(("customer_id", "_load_id", "_load_ts"), TEXT_LIMITS["customers"], unique=(("customer_id",),)),
    "orders": Constraints(("order_id",), unique=(("order_id",),)),
    "order_items": Constraints(("order_item_id",), unique=(("order_item_id",),)),
    "products": Constraints(("product_id",), TEXT_LIMITS["products"], unique=(("product_id",),)),
    "customer_status": Constraints(
        ("customer_id", "status", "event_ts"), TEXT_LIMITS["customer_status"], unique=(("customer_id", "event_ts"),)
    ),
    "dim_date": Constraints(("date_key", "date_actual"), unique=(("date_key",),)),
    "dim_product": Constraints(("product_sk", "product_bk"), unique=(("product_sk",),)),
    "dim_customer": _history("customer_sk"),
    "dim_customer_status": _history("customer_status_sk"),
    "fact_sales": Constraints(
        ("sale_id", "customer_sk", "product_sk", "date_key", "quantity", "amount"),
        rules={"quantity_positive": "quantity > 0", "amount_not_negative": "amount >= 0"},
        unique=(("sale_id",),),
        foreign={
            "customer_sk": ("dim_customer", "customer_sk"),
            "product_sk": ("dim_product", "product_sk"),
            "date_key": ("dim_date", "date_key"),
        },
    ),
    "mart_daily_sales": Constraints(max_length=TEXT_LIMITS["mart_daily_sales"]),
    "mart_customer_360": Constraints(max_length=TEXT_LIMITS["mart_customer_360"], unique=(("customer_bk",),)),
    "mart_customer_status_daily": Constraints(("date_actual", "status"), unique=(("date_actual", "status"),)),
}
