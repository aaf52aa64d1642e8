"""Staging to the cleaned layer. Rows that break a rule are returned beside the good ones, with
the reason; nothing is dropped silently and no bad value stops the load. Keys are INT unless
`key_type` says otherwise. `told` counts the rejected rows while the good ones are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chronostrata.functions import (
    blank_to_null,
    effective_ts,
    is_decimal,
    is_digits,
    to_date_lenient,
    to_int,
    to_money,
    to_ts,
)
from chronostrata.operators.latest import dedupe
from chronostrata.operators.rows import split_rejects
from chronostrata.operators.upsert import snapshot_latest


def key_rules(*keys: str, kind: str = "int") -> dict[str, Column]:
    """A key is digits and fits the key type."""
    return {f"{k}_is_key": is_digits(k) & to_int(k, kind).isNotNull() for k in keys}


def clean_orders(staged: DataFrame, key_type: str = "int", told: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    rules = {
        **key_rules("order_id", "customer_id", kind=key_type),
        "order_date_is_date": to_date_lenient("order_date").isNotNull(),
    }
    good, bad = split_rejects(staged, rules, told)
    typed = good.select(
        to_int("order_id", key_type).alias("order_id"),
        to_date_lenient("order_date").alias("order_date"),
        to_int("customer_id", key_type).alias("customer_id"),
        *_meta(good),
    )
    return _one_per(typed, "order_id"), bad


def clean_items(staged: DataFrame, key_type: str = "int", told: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    rules = {
        **key_rules("order_item_id", "order_id", "product_id", kind=key_type),
        "qty_is_number": is_digits("qty") & to_int("qty").isNotNull(),
        "price_is_decimal": is_decimal("price_at_sale") & to_money("price_at_sale").isNotNull(),
    }
    good, bad = split_rejects(staged, rules, told)
    typed = good.select(
        *[to_int(c, key_type).alias(c) for c in ("order_item_id", "order_id", "product_id")],
        to_int("qty").alias("qty"),
        to_money("price_at_sale").alias("price_at_sale"),
        *_meta(good),
    )
    return _one_per(typed, "order_item_id"), bad


def clean_products(staged: DataFrame, key_type: str = "int", told: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    good, bad = split_rejects(staged, key_rules("product_id", kind=key_type), told)
    typed = good.select(to_int("product_id", key_type).alias("product_id"), F.trim("name").alias("name"), *_meta(good))
    return _one_per(typed, "product_id"), bad


def clean_prices(staged: DataFrame, key_type: str = "int") -> tuple[DataFrame, DataFrame]:
    """Price periods are closed at both ends; a blank end is open."""
    rules = {
        **key_rules("product_id", kind=key_type),
        "valid_from_is_date": to_date_lenient("valid_from").isNotNull(),
        "valid_to_is_date": blank_to_null("valid_to").isNull() | to_date_lenient("valid_to").isNotNull(),
        "price_is_decimal": is_decimal("price") & to_money("price").isNotNull(),
    }
    good, bad = split_rejects(staged, rules)
    return good.select(
        to_int("product_id", key_type).alias("product_id"),
        to_date_lenient("valid_from").alias("valid_from"),
        to_date_lenient("valid_to").alias("valid_to"),
        to_money("price").alias("price"),
    ), bad


def customer_states(staged: DataFrame, key_type: str = "int") -> tuple[DataFrame, DataFrame]:
    """Every staged state of every customer, typed, with its effective time in `eff_ts` (event
    time, load time where that is blank)."""
    rules = {
        **key_rules("customer_id", kind=key_type),
        "event_ts_is_time": blank_to_null("event_ts").isNull() | to_ts("event_ts").isNotNull(),
    }
    good, bad = split_rejects(staged, rules)
    typed = good.select(
        to_int("customer_id", key_type).alias("customer_id"),
        *[blank_to_null(c).alias(c) for c in ("email", "phone", "city")],
        to_ts("event_ts").alias("event_ts"),
        "_load_id",
        "_load_ts",
    )
    return typed.withColumn("eff_ts", effective_ts("event_ts", "_load_ts")), bad


def customer_snapshot(states: DataFrame) -> DataFrame:
    """One row per customer: the newest state."""
    return snapshot_latest(states, "customer_id", F.col("eff_ts"))


def clean_status_events(staged: DataFrame, key_type: str = "int", told: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """All status events, one row per (customer, event time); a replay keeps the first load."""
    rules = {
        **key_rules("customer_id", kind=key_type),
        "status_filled": blank_to_null("status").isNotNull(),
        "event_ts_is_time": to_ts("event_ts").isNotNull(),
    }
    good, bad = split_rejects(staged, rules, told)
    typed = good.select(
        to_int("customer_id", key_type).alias("customer_id"),
        blank_to_null("status").alias("status"),
        to_ts("event_ts").alias("event_ts"),
        "_load_id",
        "_load_ts",
    )
    return dedupe(typed, ["customer_id", "event_ts"], [F.asc("_load_ts"), F.asc("_load_id")]), bad


def _meta(df: DataFrame) -> list[str]:
    return [c for c in ("_load_id", "_load_ts") if c in df.columns]


def _one_per(df: DataFrame, key: str) -> DataFrame:
    """Repeats of a source row: the last load counts. Tables without load metadata come from
    one load and are taken as they are."""
    meta = _meta(df)
    return dedupe(df, key, [F.col(c).desc_nulls_last() for c in reversed(meta)]) if meta else df
