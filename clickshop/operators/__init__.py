"""Models from raw events up to orders, sessions and users."""

from clickshop.operators.items import fct_order_items
from clickshop.operators.orders import (
    dedupe_purchases,
    event_gaps,
    fct_orders,
    first_purchase_per_id,
    order_clusters,
    order_starts,
)
from clickshop.operators.sessions import order_totals_by_session, session_core, sessions
from clickshop.operators.staging import (
    channel_group,
    clean_medium,
    event_fields,
    stage_events,
)
from clickshop.operators.users import first_sessions, mart_user_ltv, user_metrics

__all__ = [
    "channel_group",
    "clean_medium",
    "dedupe_purchases",
    "event_fields",
    "event_gaps",
    "fct_order_items",
    "fct_orders",
    "first_purchase_per_id",
    "first_sessions",
    "mart_user_ltv",
    "order_clusters",
    "order_starts",
    "order_totals_by_session",
    "session_core",
    "sessions",
    "stage_events",
    "user_metrics",
]
