"""Events and orders to sessions (one row per user, session and session number)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickshop.functions import (
    earliest,
    exact_sum,
    round_half_away,
    session_key,
    whole_units,
)
from clickshop.functions.numbers import MINUTE

# Limits beyond which a session is suspicious or impossible.
MAX_EVENTS = 200
MAX_MINUTES = 1_440
# Upper bound in minutes of each duration bucket, the last is open.
DURATION_BUCKETS = [(1, "0-1 min"), (5, "1-5 min"), (15, "5-15 min"), (30, "15-30 min")]
LONGEST_BUCKET = "30+ min"

# Session column -> staged column taken from the session's earliest event.
FIRST_TOUCH = {
    "source": "session_source",
    "medium": "session_medium",
    "campaign": "session_campaign",
    "channel_group": "channel_group",
    "device_category": "device_category",
    "os": "os",
    "browser": "browser",
    "country": "country",
    "city": "city",
}
COUNTED = {
    "pageviews": "is_page_view",
    "item_views": "is_view_item",
    "engaged_events": "is_session_engaged",
    "add_to_cart_count": "is_add_to_cart",
    "checkouts": "is_begin_checkout",
    "purchase_events_raw": "is_purchase",
}
REACHED = {
    "reached_item_view": "is_view_item",
    "reached_cart": "is_add_to_cart",
    "reached_checkout": "is_begin_checkout",
    "reached_shipping": "is_add_shipping_info",
    "reached_payment": "is_add_payment_info",
    "reached_purchase": "is_purchase",
}


def sessions(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Sessions with behaviour from events and revenue from orders only."""
    # User and session id identify a session like their joined text does, as
    # session ids are never negative.
    joined = session_core(events).join(
        order_totals_by_session(orders), ["user_pseudo_id", "ga_session_id"], "left"
    )
    minutes, total = F.col("session_duration_min"), F.col("total_events")
    high, impossible = F.col("is_high_event_session"), F.col("is_impossible_duration")
    quality = F.when(impossible, "invalid").when(high, "suspicious").otherwise("normal")
    (limit, label), *others = DURATION_BUCKETS
    bucket = F.when(minutes <= limit, label)
    for limit, label in others:
        bucket = bucket.when(minutes <= limit, label)
    engaged = F.col("total_engagement_msec") / F.lit(1000) / F.lit(60)
    return joined.withColumns(
        {
            "transaction_count": F.coalesce("transaction_count", F.lit(0).cast("bigint")),
            "session_revenue": F.coalesce("session_revenue", F.lit(0.0)),
            "converted": F.col("reached_purchase") == 1,
            "is_bounce": (total == 1) | (minutes == 0),
            "engagement_minutes": round_half_away(engaged, 2),
            "session_quality": quality,
            "duration_bucket": bucket.otherwise(LONGEST_BUCKET),
            "is_clean_session": ~high & ~impossible,
        }
    )


def session_core(events: DataFrame) -> DataFrame:
    """Everything about a session that its events alone tell, in one aggregate."""
    start, end = F.min("event_timestamp"), F.max("event_timestamp")
    minutes = whole_units(end, start, MINUTE)
    total = F.count(F.lit(1))
    return (
        events.where(F.col("ga_session_id").isNotNull())
        .groupBy("user_pseudo_id", "ga_session_id", "session_number")
        .agg(
            session_key().alias("session_id"),
            F.timestamp_micros(start).alias("session_start_at"),
            F.timestamp_micros(end).alias("session_end_at"),
            F.min("event_date_dt").alias("session_date"),
            minutes.alias("session_duration_min"),
            *[earliest(staged).alias(c) for c, staged in FIRST_TOUCH.items()],
            total.alias("total_events"),
            *[F.count_if(flag).alias(c) for c, flag in COUNTED.items()],
            F.sum("engagement_time_msec").alias("total_engagement_msec"),
            *[(F.count_if(flag) > 0).cast("int").alias(c) for c, flag in REACHED.items()],
            (total > MAX_EVENTS).alias("is_high_event_session"),
            (minutes > MAX_MINUTES).alias("is_impossible_duration"),
            (F.count_if("is_first_visit") > 0).alias("is_new_user"),
            (F.count_if("is_gdpr_deleted") > 0).alias("has_gdpr_deleted"),
            (F.count_if("is_internal_referral") > 0).alias("is_internal"),
        )
    )


def order_totals_by_session(orders: DataFrame) -> DataFrame:
    """Orders and revenue per session; ``orders`` is unique by ``order_key``."""
    return (
        orders.where(F.col("session_id").isNotNull())
        .groupBy("user_pseudo_id", "ga_session_id")
        .agg(
            F.count("order_key").alias("transaction_count"),
            exact_sum(F.col("revenue")).alias("session_revenue"),
        )
    )
