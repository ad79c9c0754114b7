"""Raw nested events to typed, flat, flagged events (one row per event)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickshop.functions import param

# Staged column, parameter key of the event source, value field.
PARAMS = [
    ("ga_session_id", "ga_session_id", "int_value"),
    ("session_number", "ga_session_number", "int_value"),
    ("page_location", "page_location", "string_value"),
    ("page_title", "page_title", "string_value"),
    ("page_referrer", "page_referrer", "string_value"),
    ("session_engaged_raw", "session_engaged", "string_value"),
    ("engagement_time_msec", "engagement_time_msec", "int_value"),
    ("session_source_raw", "source", "string_value"),
    ("session_medium_raw", "medium", "string_value"),
    ("session_campaign", "campaign", "string_value"),
]

# Placeholders that stand for "unknown" in the source.
OBFUSCATED = "<Other>"
NOT_SET = "(not set)"
NO_MEDIUM = "(none)"
GDPR_DELETED = "(data deleted)"
OWN_SHOP = "shop.googlemerchandisestore.com"

# Event names that get a flag column.
FLAGGED_EVENTS = [
    "purchase",
    "add_to_cart",
    "begin_checkout",
    "add_payment_info",
    "add_shipping_info",
    "view_item",
    "page_view",
    "session_start",
    "first_visit",
]

# Media of each channel.
CHANNEL_MEDIA = {
    "Organic Search": ["organic"],
    "Paid Search": ["cpc", "ppc", "paid"],
    "Email": ["email", "e-mail", "mail"],
    "Organic Social": ["social", "social-network"],
    "Referral": ["referral"],
    "Affiliates": ["affiliate"],
}
DIRECT_SOURCE = "(direct)"


def stage_events(raw: DataFrame) -> DataFrame:
    """Typed events.  Duplicates are kept; nothing is filtered or shuffled.

    ``event_id`` orders events of one instant.  A source without one gets a hash
    of the whole record, so that reruns pick the same event.
    """
    return _with_flags(event_fields(raw))


def event_fields(raw: DataFrame) -> DataFrame:
    """Parameters and nested fields as plain columns."""
    if "event_id" in raw.columns:
        event_id = F.col("event_id")
    else:
        event_id = F.xxhash64(*raw.columns)
    return raw.select(
        "event_date",
        F.to_date("event_date", "yyyyMMdd").alias("event_date_dt"),
        F.timestamp_micros("event_timestamp").alias("event_at"),
        "event_timestamp",
        "user_pseudo_id",
        "user_id",
        "platform",
        "event_name",
        *[param(key, field).alias(column) for column, key, field in PARAMS],
        _unless(F.col("traffic_source.source"), OBFUSCATED).alias("traffic_source"),
        _unless(F.col("traffic_source.medium"), OBFUSCATED).alias("traffic_medium"),
        _unless(F.col("traffic_source.name"), OBFUSCATED).alias("traffic_campaign"),
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("os"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("device.language").alias("language"),
        F.col("geo.continent").alias("continent"),
        F.col("geo.country").alias("country"),
        F.col("geo.region").alias("region"),
        _unless(F.col("geo.city"), NOT_SET).alias("city"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        F.col("ecommerce.tax_value").alias("tax_value"),
        F.col("ecommerce.shipping_value").alias("shipping_value"),
        F.col("ecommerce.unique_items").alias("unique_items"),
        "items",
        event_id.alias("event_id"),
    )


def clean_medium(raw: DataFrame) -> DataFrame:
    """Events per first-touch medium, and the medium with "none" as unknown."""
    medium = F.col("traffic_source.medium")
    counted = raw.groupBy(medium.alias("medium")).agg(F.count(F.lit(1)).alias("events"))
    return counted.select("medium", _unless(F.col("medium"), NO_MEDIUM).alias("medium_clean"), "events")


def channel_group(medium: Column, source: Column) -> Column:
    """Marketing channel of a session's raw medium and source."""
    pairs = [(name, channel) for channel, names in CHANNEL_MEDIA.items() for name in names]
    by_medium = F.create_map(*[F.lit(text) for pair in pairs for text in pair])
    by_source = F.when(source == DIRECT_SOURCE, "Direct").otherwise("Other")
    return F.coalesce(F.try_element_at(by_medium, medium), by_source)


def _with_flags(events: DataFrame) -> DataFrame:
    name, source, medium = F.col("event_name"), F.col("traffic_source"), F.col("traffic_medium")
    raw_source, raw_medium = F.col("session_source_raw"), F.col("session_medium_raw")
    txn = F.col("transaction_id")
    is_purchase = name == "purchase"
    columns = [c for c in events.columns if c != "event_id"]
    return events.select(
        *columns,
        *[(name == e).alias(f"is_{e}") for e in FLAGGED_EVENTS],
        (F.col("session_engaged_raw") == "1").alias("is_session_engaged"),
        _unless(raw_source, OBFUSCATED).alias("session_source"),
        F.when(~raw_medium.isin(OBFUSCATED, NO_MEDIUM), raw_medium).alias("session_medium"),
        channel_group(raw_medium, raw_source).alias("channel_group"),
        ((source == OWN_SHOP) & (medium == "referral")).alias("is_internal_referral"),
        (source == GDPR_DELETED).alias("is_gdpr_deleted"),
        (is_purchase & (txn.isNull() | (txn == NOT_SET))).alias("flag_missing_txn_id"),
        (is_purchase & F.col("purchase_revenue").isNull()).alias("flag_null_revenue"),
        "event_id",
    )


def _unless(x: Column, placeholder: str) -> Column:
    return F.nullif(x, F.lit(placeholder))
