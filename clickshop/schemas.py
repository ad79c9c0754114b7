"""Column types of every relation, as Spark DDL strings.

``RAW_EVENT`` is the read schema of the event source.  It names only the nested
fields that are used, so Parquet never reads the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

ITEMS = """array<struct<
    item_id: string, item_name: string, item_brand: string, item_variant: string,
    item_category: string, price: double, quantity: bigint, item_revenue: double,
    promotion_id: string, promotion_name: string, item_list_index: string>>"""

RAW_EVENT = f"""
    event_date string,
    event_timestamp bigint,
    event_name string,
    user_pseudo_id string,
    user_id string,
    platform string,
    event_params array<struct<
        key: string,
        value: struct<string_value: string, int_value: bigint>>>,
    traffic_source struct<source: string, medium: string, name: string>,
    device struct<
        category: string, operating_system: string, language: string,
        web_info: struct<browser: string>>,
    geo struct<continent: string, country: string, region: string, city: string>,
    ecommerce struct<
        transaction_id: string, purchase_revenue: double, tax_value: double,
        shipping_value: double, unique_items: bigint>,
    items {ITEMS}
"""

STAGED_EVENTS = f"""
    event_date string, event_date_dt date, event_at timestamp, event_timestamp bigint,
    user_pseudo_id string, user_id string, platform string, event_name string,
    ga_session_id bigint, session_number bigint,
    page_location string, page_title string, page_referrer string,
    session_engaged_raw string, engagement_time_msec bigint,
    session_source_raw string, session_medium_raw string, session_campaign string,
    traffic_source string, traffic_medium string, traffic_campaign string,
    device_category string, os string, browser string, language string,
    continent string, country string, region string, city string,
    transaction_id string, purchase_revenue double, tax_value double,
    shipping_value double, unique_items bigint, items {ITEMS},
    is_purchase boolean, is_add_to_cart boolean, is_begin_checkout boolean,
    is_add_payment_info boolean, is_add_shipping_info boolean, is_view_item boolean,
    is_page_view boolean, is_session_start boolean, is_first_visit boolean,
    is_session_engaged boolean, session_source string, session_medium string,
    channel_group string, is_internal_referral boolean, is_gdpr_deleted boolean,
    flag_missing_txn_id boolean, flag_null_revenue boolean, event_id bigint
"""

DEDUPED_PURCHASES = f"""{STAGED_EVENTS},
    seconds_since_prev_event bigint, order_cluster bigint, order_key string
"""

FCT_ORDERS = """
    order_key string, transaction_id string, order_date date, user_pseudo_id string,
    ga_session_id bigint, session_id string, source string, medium string,
    channel_group string, device_category string, country string, revenue double
"""

FCT_ORDER_ITEMS = """
    order_key string, transaction_id string, user_pseudo_id string, ga_session_id bigint,
    session_id string, purchased_at timestamp, purchase_date date,
    transaction_revenue double, tax_value double, shipping_value double,
    transaction_item_count bigint, channel_group string, source string, medium string,
    device_category string, country string,
    item_id string, item_name string, item_brand string, item_variant string,
    item_category_raw string, category_l1 string, category_l2 string, category_l3 string,
    item_price double, item_quantity bigint, item_revenue double,
    promotion_id string, promotion_name string, list_position string, item_rank bigint,
    flag_invalid_price boolean, flag_null_quantity boolean, flag_null_revenue boolean,
    is_primary_item boolean
"""

SESSIONS = """
    user_pseudo_id string, ga_session_id bigint, session_number bigint, session_id string,
    session_start_at timestamp, session_end_at timestamp, session_date date,
    session_duration_min bigint,
    source string, medium string, campaign string, channel_group string,
    device_category string, os string, browser string, country string, city string,
    total_events bigint, pageviews bigint, item_views bigint, engaged_events bigint,
    add_to_cart_count bigint, checkouts bigint, purchase_events_raw bigint,
    total_engagement_msec bigint,
    reached_item_view int, reached_cart int, reached_checkout int,
    reached_shipping int, reached_payment int, reached_purchase int,
    is_high_event_session boolean, is_impossible_duration boolean, is_new_user boolean,
    has_gdpr_deleted boolean, is_internal boolean,
    transaction_count bigint, session_revenue double,
    converted boolean, is_bounce boolean, engagement_minutes double,
    session_quality string, duration_bucket string, is_clean_session boolean
"""

USER_METRICS = """
    user_pseudo_id string, total_sessions bigint, total_pageviews bigint,
    avg_session_duration double, first_seen timestamp, last_seen timestamp,
    active_days int, total_revenue double, purchases bigint, converting_sessions bigint,
    avg_order_value double, channel_group string, source string, medium string,
    country string, city string, device_category string, os string, browser string
"""

DAILY_PERFORMANCE = """
    session_date date, channel_group string, source string, medium string,
    country string, city string, device_category string, os string, browser string,
    sessions bigint, users bigint, orders bigint, revenue double,
    converting_sessions bigint, new_users bigint, session_cvr double, aov double,
    revenue_per_session double, arpu double, new_user_share double
"""

FUNNEL = """
    session_date date, sessions bigint, item_views bigint, carts bigint,
    checkouts bigint, shippings bigint, payments bigint, purchases bigint,
    item_to_cart_rate double, cart_to_checkout_rate double,
    checkout_to_shipping_rate double, shipping_to_payment_rate double,
    payment_to_purchase_rate double
"""

LANDING_PAGES = """
    session_date date, page_location string, page_title string, channel_group string,
    source string, medium string, country string, city string, device_category string,
    os string, browser string, language string, sessions bigint, conversions bigint,
    transactions bigint, revenue double, cvr double
"""

PRODUCT_PERFORMANCE = """
    purchase_date date, item_id string, item_name string, item_brand string,
    category_l1 string, category_l2 string, category_l3 string, country string,
    device_category string, source string, medium string,
    transactions bigint, units_sold bigint, revenue double, avg_price double
"""

RETENTION = """
    cohort_month date, month_number bigint, country string, device_category string,
    channel_group string, source string, medium string, browser string, os string,
    active_users bigint, cohort_size bigint, retention_rate double
"""

DATA_QUALITY = """
    check_name string, issue_count bigint, issue_pct double, check_status string,
    status_sort int, audit_ts timestamp
"""

# The warehouse's relations by name, in build order.
RELATIONS = {
    "stg_events": STAGED_EVENTS,
    "int_purchase_events_deduped": DEDUPED_PURCHASES,
    "fct_orders": FCT_ORDERS,
    "fct_order_items": FCT_ORDER_ITEMS,
    "int_sessions": SESSIONS,
    "int_user_metrics": USER_METRICS,
    "mart_user_ltv": USER_METRICS,
    "mart_daily_performance": DAILY_PERFORMANCE,
    "mart_funnel": FUNNEL,
    "mart_landing_pages": LANDING_PAGES,
    "mart_product_performance": PRODUCT_PERFORMANCE,
    "mart_retention": RETENTION,
    "mart_data_quality": DATA_QUALITY,
}


def columns_of(ddl: str) -> list[tuple[str, str]]:
    """Names and types declared by a DDL string (needs a live session)."""
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(ddl)]


def conforming(df: DataFrame, relation: str) -> DataFrame:
    """``df`` itself, or an error that lists how it differs from ``relation``."""
    declared = columns_of(RELATIONS[relation])
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema]
    if actual != declared:
        missing = [c for c in declared if c not in actual]
        unexpected = [c for c in actual if c not in declared]
        raise ValueError(
            f"{relation}: missing {missing}, unexpected {unexpected}"
            if missing or unexpected
            else f"{relation}: columns are out of order"
        )
    return df
