"""Exploratory reports on volume, conversion, anomalies and completeness.

Distinct users and sessions are counted by grouping twice (session inside user
inside report group) wherever two of them are needed: several distinct counts in
one aggregate would copy every input row once per count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickshop.functions import exact_sum, one_row, ratio, session_key
from clickshop.functions.numbers import DAY, MICROS_PER_SECOND
from clickshop.operators.sessions import MAX_EVENTS
from clickshop.operators.staging import NOT_SET

# Limits used by the reports.
BASE_CHANNEL = "Organic Search"
MANY_SESSIONS = 50
DAY_MINUTES = 1_440
LONG_MINUTES = 480
HEAVY_BUYER_ORDERS = 5
HEAVY_DAY_ORDERS = 30

SESSION_GRAIN = ["user_pseudo_id", "ga_session_id", "session_number"]


def volume(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Events, users, sessions, orders, revenue and their averages."""
    per_session = events.groupBy("user_pseudo_id", session_key().alias("session_id")).agg(
        F.count(F.lit(1)).alias("events")
    )
    per_user = per_session.groupBy("user_pseudo_id").agg(
        F.sum("events").alias("events"), F.count("session_id").alias("sessions")
    )
    traffic = per_user.agg(
        F.sum("events").alias("events"),
        F.count("user_pseudo_id").alias("users"),
        F.sum("sessions").alias("sessions"),
    )
    sales = orders.agg(
        F.count_distinct("transaction_id").alias("transactions"),
        F.count(F.lit(1)).alias("orders"),
        exact_sum(F.col("revenue")).alias("revenue"),
    )
    return one_row(traffic, sales).select(
        "events",
        "users",
        "sessions",
        "transactions",
        "orders",
        "revenue",
        ratio(F.col("revenue"), F.col("orders"), 2).alias("aov"),
        ratio(F.col("sessions"), F.col("users"), 2).alias("sessions_per_user"),
    )


def site_funnel(sessions: DataFrame) -> DataFrame:
    """Sessions per site step, share of all sessions and loss since the last step."""
    steps = {
        "session": F.lit(True),
        "view_item": F.col("reached_item_view") == 1,
        "add_to_cart": F.col("reached_cart") == 1,
        "begin_checkout": F.col("reached_checkout") == 1,
        "add_payment_info": F.col("reached_payment") == 1,
        "purchase": F.col("reached_purchase") == 1,
    }
    counts = sessions.agg(*[F.count_if(reached).alias(step) for step, reached in steps.items()])
    names = list(steps)
    rows = [
        F.struct(
            F.lit(n + 1).alias("step_number"),
            F.lit(step).alias("step"),
            F.col(step).alias("sessions"),
            ratio(F.lit(100) * F.col(step), F.col(names[0]), 2).alias("share_pct"),
            (
                ratio(F.lit(100) * (F.col(names[n - 1]) - F.col(step)), F.col(names[n - 1]), 2)
                if n
                else F.lit(None).cast("double")
            ).alias("loss_pct"),
        )
        for n, step in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def device_conversion(sessions: DataFrame) -> DataFrame:
    """Users, buyers and conversion per device."""
    per_user = sessions.groupBy("device_category", "user_pseudo_id").agg(
        (F.count_if("converted") > 0).alias("bought")
    )
    # Sessions without a user make their device known, but count no user.
    users = F.count("user_pseudo_id")
    buyers = F.count_if(F.col("bought") & F.col("user_pseudo_id").isNotNull())
    return per_user.groupBy("device_category").agg(
        users.alias("users"),
        buyers.alias("buyers"),
        ratio(F.lit(100) * buyers, users, 2).alias("conversion_pct"),
    )


def channel_arpu(sessions: DataFrame) -> DataFrame:
    """Users, revenue and revenue per user of each channel, and against organic."""
    per_user = sessions.groupBy("channel_group", "user_pseudo_id").agg(
        exact_sum(F.col("session_revenue")).alias("revenue")
    )
    users, revenue = F.count("user_pseudo_id"), exact_sum(F.col("revenue"))
    channels = per_user.groupBy("channel_group").agg(
        users.alias("users"), revenue.alias("revenue"), ratio(revenue, users, 2).alias("arpu")
    )
    # One window over the whole result: there are only as many rows as channels.
    base = F.max(F.when(F.col("channel_group") == BASE_CHANNEL, F.col("arpu")))
    return channels.withColumn(
        "arpu_vs_organic", ratio(F.col("arpu"), base.over(Window.partitionBy()), 2)
    )


def country_totals(sessions: DataFrame) -> DataFrame:
    """Sessions, users, orders and revenue per country."""
    per_user = sessions.groupBy("country", "user_pseudo_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("transaction_count").alias("orders"),
        exact_sum(F.col("session_revenue")).alias("revenue"),
    )
    return per_user.groupBy("country").agg(
        F.sum("sessions").alias("sessions"),
        F.count("user_pseudo_id").alias("users"),
        F.sum("orders").alias("orders"),
        exact_sum(F.col("revenue")).alias("revenue"),
    )


def category_totals(items: DataFrame) -> DataFrame:
    """Orders, revenue and products per top category."""
    # Orders inside a category, then its products inside that: one pass, no line copied.
    # An order's share rides on one of its products, so that it counts once.
    per_order = items.groupBy("category_l1", "order_key").agg(
        exact_sum(F.col("item_revenue")).alias("revenue"), F.collect_set("item_id").alias("ids")
    )
    parts = per_order.select(
        "category_l1", "order_key", "revenue", F.posexplode_outer("ids").alias("pos", "item_id")
    )
    once = F.coalesce(F.col("pos") == 0, F.lit(True))
    per_item = parts.groupBy("category_l1", "item_id").agg(
        F.count_if(once & F.col("order_key").isNotNull()).alias("transactions"),
        exact_sum(F.when(once, F.col("revenue"))).alias("revenue"),
    )
    revenue, skus = exact_sum(F.col("revenue")), F.count("item_id")
    return per_item.groupBy("category_l1").agg(
        F.sum("transactions").alias("transactions"),
        revenue.alias("revenue"),
        skus.alias("skus"),
        ratio(revenue, skus, 2).alias("revenue_per_sku"),
    )


def monthly_orders(orders: DataFrame) -> DataFrame:
    """Orders and revenue per calendar month."""
    return orders.groupBy(F.trunc("order_date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), exact_sum(F.col("revenue")).alias("revenue")
    )


def purchase_audit(events: DataFrame) -> DataFrame:
    """Counts of suspicious purchase records, and refunds."""
    txn = F.col("transaction_id")
    purchase, usable = F.col("is_purchase"), txn.isNotNull() & (txn != NOT_SET)
    with_id = F.count_if(purchase & usable)
    ids = F.count_distinct(F.when(purchase & usable, txn))
    revenue, tax = F.col("purchase_revenue"), F.col("tax_value")
    return events.agg(
        F.count_if(purchase).alias("purchase_events"),
        F.count_if("flag_missing_txn_id").alias("missing_ids"),
        with_id.alias("events_with_id"),
        ids.alias("unique_ids"),
        ratio(F.lit(100) * (with_id - ids), with_id, 2).alias("repeated_pct"),
        F.count_if(purchase & (revenue < 0)).alias("negative_revenue"),
        F.count_if(purchase & (tax < 0)).alias("negative_tax"),
        F.count_if(purchase & (F.col("shipping_value") < 0)).alias("negative_shipping"),
        F.count_if(purchase & (tax > revenue)).alias("tax_above_revenue"),
        F.count_if(F.col("event_name") == "refund").alias("refunds"),
    )


def session_anomalies(sessions: DataFrame) -> DataFrame:
    """How many sessions and users are out of the ordinary, and the extremes."""
    minutes = F.col("session_duration_min")
    crosses = _day(F.col("session_start_at")) != _day(F.col("session_end_at"))
    counted = {
        "over_200_events": F.col("is_high_event_session"),
        "over_24_hours": minutes > DAY_MINUTES,
        "over_8_hours": minutes > LONG_MINUTES,
        "instant": minutes == 0,
        "cross_day": crosses,
    }
    per_user = sessions.groupBy("user_pseudo_id").agg(
        F.count_distinct("session_id").alias("sessions"),
        *[F.count_if(met).alias(name) for name, met in counted.items()],
        F.max("total_events").alias("max_events"),
        F.max(minutes).alias("max_minutes"),
    )
    return per_user.agg(
        F.count_if(F.col("sessions") > MANY_SESSIONS).alias("users_over_50_sessions"),
        *[F.sum(name).alias(name) for name in counted],
        F.max("max_events").alias("max_events"),
        F.max("max_minutes").alias("max_minutes"),
    )


def suspicious_event_mix(events: DataFrame) -> DataFrame:
    """What the events of high-event sessions are."""
    mix = _in_sessions(events).groupBy(*SESSION_GRAIN, "event_name").agg(
        F.count(F.lit(1)).alias("events")
    )
    # At most one row per event name is left of each session, and a shop has only
    # so many names.
    in_session = F.sum("events").over(Window.partitionBy(*SESSION_GRAIN))
    return (
        mix.withColumn("in_session", in_session)
        .where(F.col("in_session") > MAX_EVENTS)
        .groupBy("event_name")
        .agg(F.sum("events").alias("events"), F.count(F.lit(1)).alias("sessions"))
    )


def suspicious_peak_rate(events: DataFrame) -> DataFrame:
    """Purchases in high-event sessions and their busiest second."""
    at = F.col("event_timestamp")
    second = (at - F.pmod(at, F.lit(MICROS_PER_SECOND))).alias("second_us")
    per_second = _in_sessions(events).groupBy(*SESSION_GRAIN, second).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_purchase").alias("purchases")
    )
    per_session = per_second.groupBy(*SESSION_GRAIN).agg(
        F.sum("events").alias("events"),
        F.sum("purchases").alias("purchases"),
        F.max("events").alias("peak"),
    )
    return per_session.where(F.col("events") > MAX_EVENTS).agg(
        F.count(F.lit(1)).alias("suspicious_sessions"),
        F.count_if(F.col("purchases") > 0).alias("sessions_with_purchase"),
        F.sum("purchases").alias("purchase_events"),
        F.max("peak").alias("peak_events_per_second"),
    )


def param_completeness(events: DataFrame) -> DataFrame:
    """Events that lack what their kind should carry."""
    empty = F.coalesce(F.size("items") <= 0, F.lit(True))
    cart, view, purchase = F.col("is_add_to_cart"), F.col("is_page_view"), F.col("is_purchase")
    return events.agg(
        F.count_if(cart).alias("carts"),
        F.count_if(cart & empty).alias("carts_without_items"),
        F.count_if(view).alias("page_views"),
        F.count_if(view & F.col("page_location").isNull()).alias("page_views_without_url"),
        F.count_if(purchase).alias("purchases"),
        F.count_if(purchase & empty).alias("purchases_without_items"),
    )


def traffic_flags(sessions: DataFrame) -> DataFrame:
    """Share of sessions with deleted or internal traffic sources."""
    rows = F.count(F.lit(1))
    deleted, internal = F.count_if("has_gdpr_deleted"), F.count_if("is_internal")
    return sessions.agg(
        rows.alias("sessions"),
        deleted.alias("gdpr_deleted"),
        ratio(F.lit(100) * deleted, rows, 2).alias("gdpr_deleted_pct"),
        internal.alias("internal_referral"),
        ratio(F.lit(100) * internal, rows, 2).alias("internal_referral_pct"),
    )


def heavy_buyers(orders: DataFrame) -> DataFrame:
    """Users with more than five orders, their span and their busiest day."""
    per_day = (
        orders.where(F.col("user_pseudo_id").isNotNull())
        .groupBy("user_pseudo_id", "order_date")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    first, last = F.min("order_date"), F.max("order_date")
    per_user = per_day.groupBy("user_pseudo_id").agg(
        F.sum("orders").alias("orders"),
        first.alias("first_order"),
        last.alias("last_order"),
        F.date_diff(last, first).alias("span_days"),
        F.max("orders").alias("max_orders_per_day"),
        (F.max("orders") > HEAVY_DAY_ORDERS).alias("over_30_in_a_day"),
    )
    return per_user.where(F.col("orders") > HEAVY_BUYER_ORDERS)


def revenue_analysis_orders(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    """Orders whose session lasted less than a day."""
    ordinary = sessions.where(F.col("session_duration_min") < DAY_MINUTES)
    return orders.join(ordinary, ["user_pseudo_id", "ga_session_id"], "left_semi")


def reconciliation(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue at order grain and at session grain, and the difference."""
    totals = one_row(
        orders.agg(exact_sum(F.col("revenue")).alias("order_revenue")),
        sessions.agg(exact_sum(F.col("session_revenue")).alias("session_revenue")),
    )
    difference = F.col("session_revenue") - F.col("order_revenue")
    return totals.withColumn("difference", ratio(difference, F.lit(1), 2))


def ids_shared_by_users(deduped: DataFrame) -> DataFrame:
    """Transaction ids whose orders belong to more than one user."""
    return (
        deduped.groupBy("transaction_id")
        .agg(F.count_distinct("user_pseudo_id").alias("users"))
        .where("users > 1")
    )


def long_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with a flag for more than eight hours."""
    return sessions.withColumn("is_long_session", F.col("session_duration_min") > LONG_MINUTES)


def _in_sessions(events: DataFrame) -> DataFrame:
    return events.where(F.col("ga_session_id").isNotNull())


def _day(at: Column) -> Column:
    micros = F.unix_micros(at)
    return micros - F.pmod(micros, F.lit(DAY * MICROS_PER_SECOND))
