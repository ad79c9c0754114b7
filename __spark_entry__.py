"""

Each query derives raw events from the given tables, runs the library on them and
returns whole results.  Timestamps leave as zone-free values and item arrays as their
size and as ordered text, so that both engines can be compared column by column.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T  # noqa: E402

from clickshop import operators as ops  # noqa: E402
from clickshop.functions import exact_sum  # noqa: E402
from clickshop.operators.items import ITEM_INPUT  # noqa: E402
from clickshop.operators.orders import ORDER_INPUT  # noqa: E402
from clickshop.operators.sessions import FIRST_TOUCH  # noqa: E402
from clickshop.plans import audit, checks, marts, profile, reach  # noqa: E402
from clickshop.schemas import RELATIONS  # noqa: E402
from clickshop.session import configure, shared_folder  # noqa: E402
from clickshop.plans.warehouse import build, replace_days  # noqa: E402
from clickshop.sources import Shards, Store, events_from_tables, scan_events, write_shards  # noqa: E402
from clickshop.sources.events import in_date_range, write_events  # noqa: E402
from clickshop.streaming import order_stream, scan_event_stream  # noqa: E402
from parity import oracle  # noqa: E402

try:
    import clickshop.llm.queries as llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("clickshop.llm", "clickshop.llm.queries"):
        raise
    llm = None  # the library works without this subpackage

Query = Callable[[SparkSession, str], DataFrame]


class Warehouse(Mapping[str, DataFrame]):
    """All relations over the given tables, unwritten, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.raw = events_from_tables(spark, sf_dir)

    def __getitem__(self, relation: str) -> DataFrame:
        return getattr(self, relation)

    def __iter__(self) -> Iterator[str]:
        return iter(RELATIONS)

    def __len__(self) -> int:
        return len(RELATIONS)

    @cached_property
    def stg_events(self) -> DataFrame:
        return ops.stage_events(self.raw)

    @cached_property
    def order_events(self) -> DataFrame:
        return self.stg_events.select(*ORDER_INPUT)

    @cached_property
    def int_purchase_events_deduped(self) -> DataFrame:
        return ops.dedupe_purchases(self.stg_events)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return ops.fct_orders(ops.dedupe_purchases(self.stg_events, ORDER_INPUT))

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return ops.fct_order_items(ops.dedupe_purchases(self.stg_events, ITEM_INPUT))

    @cached_property
    def int_sessions(self) -> DataFrame:
        return ops.sessions(self.stg_events, self.fct_orders)

    @cached_property
    def int_user_metrics(self) -> DataFrame:
        return ops.user_metrics(self.int_sessions)

    @cached_property
    def mart_user_ltv(self) -> DataFrame:
        return ops.mart_user_ltv(self.int_user_metrics)

    @cached_property
    def mart_daily_performance(self) -> DataFrame:
        return marts.mart_daily_performance(self.int_sessions)

    @cached_property
    def mart_funnel(self) -> DataFrame:
        return marts.mart_funnel(self.int_sessions)

    @cached_property
    def mart_landing_pages(self) -> DataFrame:
        return marts.mart_landing_pages(self.stg_events, self.int_sessions)

    @cached_property
    def mart_product_performance(self) -> DataFrame:
        return marts.mart_product_performance(self.fct_order_items)

    @cached_property
    def mart_retention(self) -> DataFrame:
        return marts.mart_retention(self.int_sessions)

    @cached_property
    def mart_data_quality(self) -> DataFrame:
        return audit.mart_data_quality(self.stg_events, self.int_sessions, _as_of())


def entry(spark: SparkSession) -> DataFrame:
    """Orders and revenue per day and channel, from raw events."""
    return queries()["daily_channel_revenue"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {name: _on_tables(report) for name, report in _reports().items()}
    if llm is not None:
        found |= llm.queries()
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if llm is not None:
        found |= llm.oracle_sql()
    return found


def _reports() -> dict[str, Callable[[Warehouse], DataFrame]]:
    reports = {
        "daily_channel_revenue": _daily_channel_revenue,
        # Reading and staging
        "scan_event_range": _scan_event_range,
        "scan_shard_times": _scan_shard_times,
        "stage_events": lambda w: w.stg_events.drop("event_id"),
        "stage_event_params": _event_params,
        "stage_nested_fields": _nested_fields,
        "stage_channel_group": lambda w: w.stg_events.select(
            "event_id", "session_source_raw", "session_medium_raw", "channel_group"
        ),
        "stage_flags": _stage_flags,
        "first_touch_medium": lambda w: ops.clean_medium(w.raw),
        # Orders and items
        "order_gaps": lambda w: ops.order_starts(w.order_events),
        "order_clusters": lambda w: ops.order_clusters(w.order_events),
        "orders_deduped": lambda w: w.int_purchase_events_deduped.drop("event_id"),
        "orders_first_seen_simple": lambda w: ops.first_purchase_per_id(w.order_events).select(
            "transaction_id", "event_timestamp", "user_pseudo_id", "purchase_revenue"
        ),
        "purchase_gaps": lambda w: ops.event_gaps(w.order_events),
        "fct_orders": lambda w: w.fct_orders,
        "fct_order_items": lambda w: w.fct_order_items,
        "item_categories": lambda w: w.fct_order_items.groupBy(
            "item_category_raw", "category_l1", "category_l2", "category_l3"
        ).agg(F.count(F.lit(1)).alias("lines")),
        # Sessions and users
        "sessions_core": lambda w: ops.session_core(w.stg_events).drop(*FIRST_TOUCH),
        "sessions_first_touch": lambda w: ops.session_core(w.stg_events).select(
            "session_id", "session_number", *FIRST_TOUCH
        ),
        "sessions_revenue": lambda w: w.int_sessions.select(
            "session_id", "session_number", "transaction_count", "session_revenue"
        ),
        "sessions_full": lambda w: w.int_sessions,
        "user_first_session": lambda w: ops.first_sessions(w.int_sessions).select(
            "user_pseudo_id", "session_id", "session_number", "session_start_at"
        ),
        "user_metrics": lambda w: w.int_user_metrics,
        "mart_user_ltv": lambda w: w.mart_user_ltv,
        # Reporting tables
        "mart_daily_performance": lambda w: w.mart_daily_performance,
        "mart_funnel": lambda w: w.mart_funnel,
        "mart_landing_pages": lambda w: w.mart_landing_pages,
        "mart_product_performance": lambda w: w.mart_product_performance,
        "mart_retention": lambda w: w.mart_retention,
        "mart_data_quality": lambda w: w.mart_data_quality,
        # Through storage
        "stored_daily_performance": _stored_daily_performance,
        "stored_days_replaced": _stored_days_replaced,
        "views_by_name": _views_by_name,
        "checks_while_writing": _checks_while_writing,
        "users_per_month": _users_per_month,
        "stored_freshness": _stored_freshness,
        "stream_orders": _stream_orders,
        # Checks
        "check_not_null": lambda w: checks.not_null_report(w.stg_events),
        "check_unique": lambda w: checks.check_report(w, checks.UNIQUE_CHECKS),
        "check_freshness": lambda w: audit.freshness(w.stg_events, _as_of()),
        "check_orders_reconcile_totals": _order_totals,
        "missing_order_ids": _missing_order_ids,
        "reconcile_revenue": lambda w: profile.reconciliation(w.int_sessions, w.fct_orders),
        "txn_ids_shared_by_users": lambda w: profile.ids_shared_by_users(w.fct_orders),
        # Exploratory reports
        "profile_volume": lambda w: profile.volume(w.stg_events, w.fct_orders),
        "profile_site_funnel": lambda w: profile.site_funnel(w.int_sessions),
        "profile_device_conversion": lambda w: profile.device_conversion(w.int_sessions),
        "profile_channel_arpu": lambda w: profile.channel_arpu(w.int_sessions),
        "profile_country": lambda w: profile.country_totals(w.int_sessions),
        "profile_category": lambda w: profile.category_totals(w.fct_order_items),
        "profile_monthly_orders": lambda w: profile.monthly_orders(w.fct_orders),
        "profile_purchase_audit": lambda w: profile.purchase_audit(w.stg_events),
        "profile_session_anomalies": lambda w: profile.session_anomalies(w.int_sessions),
        "profile_suspicious_event_mix": lambda w: profile.suspicious_event_mix(w.stg_events),
        "profile_suspicious_peak_rate": lambda w: profile.suspicious_peak_rate(w.stg_events),
        "profile_param_completeness": lambda w: profile.param_completeness(w.stg_events),
        "profile_traffic_flags": lambda w: profile.traffic_flags(w.int_sessions),
        "profile_heavy_buyers": lambda w: profile.heavy_buyers(w.fct_orders),
        "profile_revenue_analysis": lambda w: profile.revenue_analysis_orders(
            w.fct_orders, w.int_sessions
        ),
        "profile_long_sessions": lambda w: profile.long_sessions(w.int_sessions).select(
            "session_id", "session_number", "session_duration_min", "is_long_session"
        ),
    }
    for check in checks.BUSINESS_CHECKS:
        reports[f"check_{check.name}"] = _checked(check)
    return reports


def _on_tables(report: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: _comparable(report(Warehouse(configure(spark), sf_dir)))


def _checked(check: checks.Check) -> Callable[[Warehouse], DataFrame]:
    return lambda w: checks.check_report(w, [check])


def _as_of() -> Column:
    return F.lit(oracle.AS_OF).cast("timestamp")


def _daily_channel_revenue(w: Warehouse) -> DataFrame:
    orders, revenue = F.count(F.lit(1)), exact_sum(F.col("revenue"))
    return w.fct_orders.groupBy("order_date", "channel_group").agg(
        orders.alias("orders"), revenue.alias("revenue")
    )


def _scan_event_range(w: Warehouse) -> DataFrame:
    return in_date_range(w.raw, *oracle.SCAN_RANGE).select(
        "event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id"
    )


def _scan_shard_times(w: Warehouse) -> DataFrame:
    """Events stored by day suffix, their files' times indexed, and some hours of some days read."""
    path = _new_folder(w.spark)
    prefix = write_shards(w.raw, f"{path}/events")
    shards = Shards(w.spark, f"{path}/events", f"{path}/zones", prefix)
    shards.index()
    return shards.scan(*oracle.SCAN_RANGE, *oracle.SCAN_TIMES, with_event_id=True).select(
        "event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id"
    )


def _event_params(w: Warehouse) -> DataFrame:
    return w.stg_events.select(
        "event_id",
        "event_date_dt",
        "event_at",
        "ga_session_id",
        "session_number",
        "engagement_time_msec",
        "page_location",
        "page_title",
        "page_referrer",
        "session_engaged_raw",
        "session_source_raw",
        "session_medium_raw",
        "session_campaign",
        "items",
    )


def _nested_fields(w: Warehouse) -> DataFrame:
    return w.stg_events.select(
        "event_id",
        "traffic_source",
        "traffic_medium",
        "traffic_campaign",
        "device_category",
        "os",
        "browser",
        "language",
        "continent",
        "country",
        "region",
        "city",
        "transaction_id",
        "purchase_revenue",
        "tax_value",
        "shipping_value",
        "unique_items",
        "session_source",
        "session_medium",
    )


def _stage_flags(w: Warehouse) -> DataFrame:
    flags = [f.name for f in w.stg_events.schema if isinstance(f.dataType, T.BooleanType)]
    return w.stg_events.select("event_id", *flags)


def _order_totals(w: Warehouse) -> DataFrame:
    (check,) = [c for c in checks.BUSINESS_CHECKS if c.name == "orders_reconcile"]
    return check.totals(w)


def _missing_order_ids(w: Warehouse) -> DataFrame:
    """Ids of usable purchases that reach no order line: purchases sent without products."""
    (check,) = [c for c in checks.BUSINESS_CHECKS if isinstance(c, checks.CompletenessCheck)]
    return check.violations({"stg_events": w.stg_events, "fct_orders": w.fct_order_items})


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/shop-{uuid.uuid4().hex}"


def _stored_daily_performance(w: Warehouse) -> DataFrame:
    """Raw events written, a date range scanned, all relations built, one read back."""
    path = _new_folder(w.spark)
    write_events(w.raw, f"{path}/events")
    raw = scan_events(w.spark, f"{path}/events", *oracle.SCAN_RANGE, with_event_id=True)
    return build(raw, Store(w.spark, path=f"{path}/tables"), _as_of(), by_day=True)["mart_daily_performance"]


def _stored_days_replaced(w: Warehouse) -> DataFrame:
    """Relations built without some days, which then come late; the sessions after that."""
    path = _new_folder(w.spark)
    write_events(w.raw, f"{path}/events")
    raw = scan_events(w.spark, f"{path}/events", *oracle.SCAN_RANGE, with_event_id=True)
    late = F.col("event_date").between(*oracle.LATE_DAYS)
    store = Store(w.spark, path=f"{path}/tables")
    build(raw.where(~late), store, _as_of(), by_day=True)
    dates = raw.where(late).select(F.to_date("event_date", "yyyyMMdd").cast("string").alias("day")).distinct()
    days = [r.day for r in dates.collect()]
    return replace_days(raw.where(late), store, days, _as_of())["int_sessions"]


def _views_by_name(w: Warehouse) -> DataFrame:
    """Orders and sessions stored, registered as views, and asked in SQL."""
    store = Store(w.spark, path=f"{_new_folder(w.spark)}/tables")
    orders = store.write("fct_orders", w.fct_orders)
    store.write("int_sessions", ops.sessions(w.stg_events, orders))
    store.register_views()
    return w.spark.sql(oracle.VIEW_SQL.format(sessions="int_sessions"))


def _checks_while_writing(w: Warehouse) -> DataFrame:
    """Row checks of two relations, counted by the jobs that write them."""
    store = Store(w.spark, path=f"{_new_folder(w.spark)}/tables")
    draft = store.begin()
    orders = draft.write("fct_orders", w.fct_orders, checks.row_metrics("fct_orders"))
    draft.write("int_sessions", ops.sessions(w.stg_events, orders), checks.row_metrics("int_sessions"))
    draft.commit()
    own = [c for c in checks.ALL_CHECKS if isinstance(c, checks.RowCheck) and c.relation in store.metrics()]
    return checks.written_report(store, own)


def _stored_freshness(w: Warehouse) -> DataFrame:
    """Age of the newest stored event, read from file footers."""
    store = Store(w.spark, path=f"{_new_folder(w.spark)}/tables")
    store.write("stg_events", w.stg_events)
    return audit.stored_freshness(store, _as_of())


def _stream_orders(w: Warehouse) -> DataFrame:
    """Orders of the events as a stream of files, of runs that the watermark has closed."""
    path = _new_folder(w.spark)
    write_events(w.raw, f"{path}/events")
    staged = ops.stage_events(scan_event_stream(w.spark, f"{path}/events", with_event_id=True))
    sink = order_stream(staged).writeStream.format("parquet").outputMode("append")
    query = sink.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/orders")
    query.awaitTermination()
    return w.spark.read.parquet(f"{path}/orders")


def _users_per_month(w: Warehouse) -> DataFrame:
    """Distinct users per month and channel, from the bitmaps of its days."""
    sessions = w.int_sessions.select("session_date", "channel_group", "user_pseudo_id")
    numbers = reach.number_values(sessions.select("user_pseudo_id"), f"{_new_folder(w.spark)}/users")
    daily = reach.reach(sessions, numbers, "user_pseudo_id", ["session_date", "channel_group"])
    month = F.trunc("session_date", "month").alias("month")
    return reach.reached(reach.merged(daily, [month, "channel_group"]), ["month", "channel_group"])


def _comparable(df: DataFrame) -> DataFrame:
    """``df`` with zone-free timestamps, and item arrays as their size and ordered text."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            columns.append(column.cast("timestamp_ntz").alias(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(F.size(column).cast("bigint").alias("item_count"))
            columns.append(_items_text(column).alias("items_text"))
        else:
            columns.append(column)
    return df.select(*columns)


def _items_text(items: Column) -> Column:
    def text(item: Column) -> Column:
        fields = [
            item["item_id"],
            item["item_list_index"],
            item["price"].cast("decimal(18,2)"),
            item["quantity"],
            item["item_revenue"].cast("decimal(18,2)"),
            item["item_variant"],
            item["item_category"],
            item["promotion_id"],
        ]
        return F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("-")) for f in fields])

    return F.array_join(F.array_sort(F.transform(items, text)), ";")
