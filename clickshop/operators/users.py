"""Sessions to users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickshop.functions import exact_sum, ratio
from clickshop.functions.picks import SESSION_ORDER

FIRST_TOUCH = [
    "channel_group",
    "source",
    "medium",
    "country",
    "city",
    "device_category",
    "os",
    "browser",
]


def first_session(columns: list[str]) -> Column:
    """``columns`` of a group's earliest session, as a struct."""
    return F.min_by(F.struct(*columns), F.struct(*SESSION_ORDER))


def first_sessions(sessions: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The earliest session of every user; only ``columns``, by default all, are read."""
    columns = columns or sessions.columns
    first = first_session(columns)
    return sessions.groupBy("user_pseudo_id").agg(first.alias("first")).select("first.*")


def user_metrics(sessions: DataFrame) -> DataFrame:
    """Lifetime totals and first-touch attributes of every user, in one aggregate."""
    revenue, orders = exact_sum(F.col("session_revenue")), F.sum("transaction_count")
    totals = sessions.groupBy("user_pseudo_id").agg(
        F.count_distinct("session_id").alias("total_sessions"),
        F.sum("pageviews").alias("total_pageviews"),
        F.avg("session_duration_min").alias("avg_session_duration"),
        F.min("session_start_at").alias("first_seen"),
        F.max("session_end_at").alias("last_seen"),
        F.date_diff(F.max("session_date"), F.min("session_date")).alias("active_days"),
        revenue.alias("total_revenue"),
        orders.alias("purchases"),
        F.count_if("converted").alias("converting_sessions"),
        ratio(revenue, orders, 2).alias("avg_order_value"),
        first_session(FIRST_TOUCH).alias("first"),
    )
    # Sessions without a user are no one's first session.
    known = F.col("user_pseudo_id").isNotNull()
    return totals.select(
        *[c for c in totals.columns if c != "first"],
        *[F.when(known, F.col("first")[c]).alias(c) for c in FIRST_TOUCH],
    )


def mart_user_ltv(user_metrics: DataFrame) -> DataFrame:
    """The user metrics under the name that reports use."""
    return user_metrics
