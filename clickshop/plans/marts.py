"""Reporting tables on top of sessions, items and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickshop.functions import exact_sum, ratio, round_half_away, session_key
from clickshop.functions.picks import EVENT_ORDER, SESSION_ORDER

DAILY_DIMENSIONS = [
    "session_date",
    "channel_group",
    "source",
    "medium",
    "country",
    "city",
    "device_category",
    "os",
    "browser",
]
# Landing-page dimension -> staged column.
LANDING_DIMENSIONS = {
    "session_date": "event_date_dt",
    "page_location": "page_location",
    "page_title": "page_title",
    "channel_group": "channel_group",
    "source": "session_source",
    "medium": "session_medium",
    "country": "country",
    "city": "city",
    "device_category": "device_category",
    "os": "os",
    "browser": "browser",
    "language": "language",
}
PRODUCT_DIMENSIONS = [
    "purchase_date",
    "item_id",
    "item_name",
    "item_brand",
    "category_l1",
    "category_l2",
    "category_l3",
    "country",
    "device_category",
    "source",
    "medium",
]
COHORT_DIMENSIONS = [
    "country",
    "device_category",
    "channel_group",
    "source",
    "medium",
    "browser",
    "os",
]
# Fixed value: cohort dimension of users whose first session lacks it.
UNKNOWN = "(unknown)"

# Funnel steps in order: count column -> session column.
FUNNEL_STEPS = {
    "item_views": "reached_item_view",
    "carts": "reached_cart",
    "checkouts": "reached_checkout",
    "shippings": "reached_shipping",
    "payments": "reached_payment",
    "purchases": "reached_purchase",
}
FUNNEL_RATES = {
    "item_to_cart_rate": ("reached_item_view", "reached_cart"),
    "cart_to_checkout_rate": ("reached_cart", "reached_checkout"),
    "checkout_to_shipping_rate": ("reached_checkout", "reached_shipping"),
    "shipping_to_payment_rate": ("reached_shipping", "reached_payment"),
    "payment_to_purchase_rate": ("reached_payment", "reached_purchase"),
}


def mart_daily_performance(sessions: DataFrame) -> DataFrame:
    """Traffic, orders and revenue per day and session attributes."""
    rows, users = F.count(F.lit(1)), F.count_distinct("user_pseudo_id")
    orders, revenue = F.sum("transaction_count"), exact_sum(F.col("session_revenue"))
    converting, new = F.count_if("converted"), F.count_if("is_new_user")
    return sessions.groupBy(*DAILY_DIMENSIONS).agg(
        rows.alias("sessions"),
        users.alias("users"),
        orders.alias("orders"),
        revenue.alias("revenue"),
        converting.alias("converting_sessions"),
        new.alias("new_users"),
        ratio(converting, rows, 4).alias("session_cvr"),
        ratio(revenue, orders, 2).alias("aov"),
        ratio(revenue, rows, 2).alias("revenue_per_session"),
        ratio(revenue, users, 2).alias("arpu"),
        ratio(new, rows, 4).alias("new_user_share"),
    )


def mart_funnel(sessions: DataFrame) -> DataFrame:
    """Sessions reaching each step per day, and step-to-step rates."""

    def reached(step: str) -> Column:
        return F.col(step) == 1

    def rate(step: str, following: str) -> Column:
        both = F.count_if(reached(step) & reached(following))
        return ratio(both, F.count_if(reached(step)), 4)

    return sessions.groupBy("session_date").agg(
        F.count(F.lit(1)).alias("sessions"),
        *[F.count_if(reached(step)).alias(c) for c, step in FUNNEL_STEPS.items()],
        *[rate(*steps).alias(c) for c, steps in FUNNEL_RATES.items()],
    )


def first_pages(events: DataFrame) -> DataFrame:
    """The earliest event with a page of every (user, session).

    Events without a session id form one group per user and are kept.
    """
    page = F.struct(*[F.col(staged).alias(c) for c, staged in LANDING_DIMENSIONS.items()])
    return (
        events.where(F.col("page_location").isNotNull())
        .groupBy("user_pseudo_id", "ga_session_id")
        .agg(F.min_by(page, F.struct(*EVENT_ORDER)).alias("page"))
        .select("user_pseudo_id", "ga_session_id", session_key().alias("session_id"), "page.*")
    )


def mart_landing_pages(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Entry pages and the outcome of the sessions that began there."""
    # Joining on the pair rather than its text reuses the grouping's partitions
    # and spreads pages without a session id, which match nothing, by user.
    outcomes = sessions.select(
        "user_pseudo_id", "ga_session_id", "converted", "session_revenue", "transaction_count"
    )
    landed = first_pages(events).join(outcomes, ["user_pseudo_id", "ga_session_id"], "left")
    rows, converted = F.count(F.lit(1)), F.count_if("converted")
    return landed.groupBy(*LANDING_DIMENSIONS).agg(
        rows.alias("sessions"),
        converted.alias("conversions"),
        F.sum("transaction_count").alias("transactions"),
        exact_sum(F.col("session_revenue")).alias("revenue"),
        ratio(converted, rows, 4).alias("cvr"),
    )


def mart_product_performance(items: DataFrame) -> DataFrame:
    """Orders, units, revenue and mean price per product and market."""
    price = F.col("item_price")
    return items.groupBy(*PRODUCT_DIMENSIONS).agg(
        F.count_distinct("order_key").alias("transactions"),
        F.sum("item_quantity").alias("units_sold"),
        round_half_away(exact_sum(F.col("item_revenue")), 2).alias("revenue"),
        ratio(exact_sum(price), F.count(price), 2).alias("avg_price"),
    )


def mart_retention(sessions: DataFrame) -> DataFrame:
    """Active users per cohort and month since the cohort's first month.

    One aggregate gives every user their first session and the set of months they
    were active in, which is as small as the calendar.  A user is in one cohort
    and appears once per month, so plain counts are distinct users, and the
    cohort's size is its count in month 0, when every member was active.
    """
    month = F.trunc("session_date", "MM")
    dimensions = [F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in COHORT_DIMENSIONS]
    first = F.struct(month.alias("cohort_month"), *dimensions)
    users = (
        sessions.where(F.col("user_pseudo_id").isNotNull())
        .groupBy("user_pseudo_id")
        .agg(
            F.min_by(first, F.struct(*SESSION_ORDER)).alias("first"),
            F.collect_set(month).alias("months"),
        )
    )
    activity = users.select("first.*", F.explode("months").alias("month")).withColumn(
        "month_number", _months_between(F.col("month"), F.col("cohort_month"))
    )
    cohort = ["cohort_month", *COHORT_DIMENSIONS]
    active = activity.groupBy(*cohort, "month_number").agg(
        F.count(F.lit(1)).alias("active_users")
    )
    at_start = F.when(F.col("month_number") == 0, F.col("active_users"))
    size = F.sum(at_start).over(Window.partitionBy(*cohort))
    return active.select(
        "cohort_month",
        "month_number",
        *COHORT_DIMENSIONS,
        "active_users",
        size.alias("cohort_size"),
        ratio(F.col("active_users"), size, 4).alias("retention_rate"),
    )


def _months_between(later: Column, earlier: Column) -> Column:
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("bigint")
