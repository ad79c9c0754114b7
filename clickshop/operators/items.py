"""Orders to their items (one row per product line of an order)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickshop.functions import session_key
from clickshop.operators.orders import ORDER_INPUT
from clickshop.operators.staging import NOT_SET

# Staged columns that order items need, for callers that want nothing else.
ITEM_INPUT = [*ORDER_INPUT, "event_at", "tax_value", "shipping_value", "unique_items", "items"]


def fct_order_items(deduped: DataFrame) -> DataFrame:
    """Item lines with category levels, rank within the order and quality flags.

    ``deduped`` holds one row per order, so an order's lines are exactly its own
    ``items`` array.  Sorting that array ranks them without any shuffle.
    """
    placed = F.transform(
        "items",
        lambda i: F.struct(
            i["item_list_index"].isNull().alias("unplaced"),
            i["item_list_index"].alias("list_position"),
            i["item_id"].alias("item_id"),
            i["item_revenue"].alias("item_revenue"),
            i["quantity"].alias("quantity"),
            i.alias("item"),
        ),
    )
    lines = deduped.select(
        "order_key",
        "transaction_id",
        "user_pseudo_id",
        "ga_session_id",
        session_key().alias("session_id"),
        F.col("event_at").alias("purchased_at"),
        F.col("event_date_dt").alias("purchase_date"),
        F.col("purchase_revenue").alias("transaction_revenue"),
        "tax_value",
        "shipping_value",
        F.col("unique_items").alias("transaction_item_count"),
        "channel_group",
        F.col("session_source").alias("source"),
        F.col("session_medium").alias("medium"),
        "device_category",
        "country",
        F.posexplode(F.sort_array(placed)).alias("position", "line"),
    )
    item = F.col("line.item")
    levels = F.split(F.btrim(item["item_category"], F.lit("/")), "/")
    price = item["price"].try_cast("double")
    rank = F.col("position").cast("bigint") + 1
    header = [c for c in lines.columns if c not in ("position", "line")]
    return lines.select(
        *header,
        item["item_id"].alias("item_id"),
        item["item_name"].alias("item_name"),
        F.nullif(item["item_brand"], F.lit(NOT_SET)).alias("item_brand"),
        F.nullif(item["item_variant"], F.lit(NOT_SET)).alias("item_variant"),
        item["item_category"].alias("item_category_raw"),
        *[F.get(levels, n).alias(f"category_l{n + 1}") for n in range(3)],
        price.alias("item_price"),
        item["quantity"].alias("item_quantity"),
        item["item_revenue"].alias("item_revenue"),
        F.nullif(item["promotion_id"], F.lit(NOT_SET)).alias("promotion_id"),
        F.nullif(item["promotion_name"], F.lit(NOT_SET)).alias("promotion_name"),
        item["item_list_index"].alias("list_position"),
        rank.alias("item_rank"),
        ((price <= 0) | price.isNull()).alias("flag_invalid_price"),
        item["quantity"].isNull().alias("flag_null_quantity"),
        item["item_revenue"].isNull().alias("flag_null_revenue"),
        (rank == 1).alias("is_primary_item"),
    )
