"""Purchase events to real orders.

One transaction id can be sent twice for one purchase (repeats within the hour)
and can also be given to different purchases (days apart).  A new order starts
whenever more than an hour passes between consecutive events of an id.

All events of an id inside one clock hour are less than an hour apart, so they
can never be split.  They are therefore merged into one *burst* first, a grouped
aggregate that shrinks on the map side, and the windows below see at most one
row per id and hour, however often the id was sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickshop.functions import session_key, whole_units
from clickshop.functions.numbers import HOUR, MICROS_PER_SECOND, SECOND
from clickshop.functions.picks import EVENT_ORDER

# Fixed value: seconds between two events of one id that make them two orders.
MAX_GAP_SECONDS = 3_600

# Slices of ``event_gaps`` for each shuffle partition, so that they even out.
SLICES_PER_TASK = 4

_HOUR_MICROS = HOUR * MICROS_PER_SECOND

# Staged columns that fct_orders reads, for callers that want orders only.
ORDER_INPUT = [
    "event_timestamp",
    "event_id",
    "is_purchase",
    "flag_missing_txn_id",
    "transaction_id",
    "event_date_dt",
    "user_pseudo_id",
    "ga_session_id",
    "session_source",
    "session_medium",
    "channel_group",
    "device_category",
    "country",
    "purchase_revenue",
]


def usable_purchases(events: DataFrame) -> DataFrame:
    """Purchase events that carry a usable transaction id."""
    return events.where(F.col("is_purchase") & ~F.col("flag_missing_txn_id"))


def dedupe_purchases(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The first event of every order, keyed by ``order_key``.

    Only ``columns`` of the events, by default all, are read and shuffled, besides
    those that decide.
    """
    columns = columns or events.columns
    starts = _bursts(events, [*dict.fromkeys([*EVENT_ORDER, *columns])]).where("starts_order")
    # An id may literally be spelled like another id's numbered key, so the key
    # itself decides once more.  Both ids have one stem, so no row moves for that.
    per_key = Window.partitionBy("stem", "order_key").orderBy(*[F.col("first")[c] for c in EVENT_ORDER])
    return (
        starts.withColumn("rank", F.row_number().over(per_key))
        .where("rank = 1")
        .select(
            *[F.col("first")[c].alias(c) for c in columns],
            "seconds_since_prev_event",
            "order_cluster",
            "order_key",
        )
    )


def event_gaps(events: DataFrame) -> DataFrame:
    """Every usable purchase event with the silence since its predecessor of the same id.

    Events are cut into slices of even size by id and time, so a hot id spans as many tasks as it
    fills.  Within a slice an event looks back one row; the first event of an id in a
    slice takes the last time of the id's slice before.  Only these first events of an id
    meet in one window, one per slice; the others stay spread by slice.
    """
    at = F.col("event_timestamp")
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = (
        usable_purchases(events)
        .select("transaction_id", *EVENT_ORDER)
        .repartitionByRange(SLICES_PER_TASK * tasks, "transaction_id", *EVENT_ORDER)
        .withColumn("slice", F.spark_partition_id())
    )
    own = Window.partitionBy("transaction_id", "slice")
    in_time = own.orderBy(*EVENT_ORDER)
    looked_back = sliced.select(
        "*",
        F.lag(at).over(in_time).alias("before"),
        (F.row_number().over(in_time) == 1).alias("opens"),
        F.max(at).over(own).alias("last"),
    )
    apart = F.when(F.col("opens"), -1).otherwise(F.col("slice"))
    slices = Window.partitionBy("transaction_id", "lane").orderBy("slice")
    carried = F.when(F.col("opens"), F.lag("last").over(slices)).otherwise(F.col("before"))
    return looked_back.withColumn("lane", apart).select(
        "event_id",
        "transaction_id",
        F.timestamp_micros(at).alias("event_at"),
        whole_units(at, carried, SECOND).alias("seconds_since_prev_event"),
    )


def order_starts(events: DataFrame) -> DataFrame:
    """Where each id starts a new order, with the silence before it."""
    return (
        _bursts(events, list(EVENT_ORDER))
        .where("starts_order")
        .select(
            "transaction_id",
            F.timestamp_micros("first_us").alias("started_at"),
            "seconds_since_prev_event",
            "order_cluster",
        )
    )


def order_clusters(events: DataFrame) -> DataFrame:
    """Every order of every id: its extent and how many events reported it."""
    return (
        _bursts(events, list(EVENT_ORDER))
        .groupBy("stem", "transaction_id", "order_cluster", "order_key")
        .agg(
            F.timestamp_micros(F.min("first_us")).alias("first_event_at"),
            F.timestamp_micros(F.max("last_us")).alias("last_event_at"),
            F.sum("events").alias("purchase_events"),
        )
        .drop("stem")
    )


def first_purchase_per_id(events: DataFrame) -> DataFrame:
    """The earlier, simpler rule: the first event of each id is its only order."""
    first = F.min_by(F.struct(*events.columns), F.struct(*EVENT_ORDER))
    return (
        usable_purchases(events)
        .groupBy("transaction_id")
        .agg(first.alias("first"))
        .select(*[F.col("first")[c].alias(c) for c in events.columns])
    )


def fct_orders(deduped: DataFrame) -> DataFrame:
    """One row per real order: the only source of revenue."""
    return deduped.select(
        "order_key",
        "transaction_id",
        F.col("event_date_dt").alias("order_date"),
        "user_pseudo_id",
        "ga_session_id",
        session_key().alias("session_id"),
        F.col("session_source").alias("source"),
        F.col("session_medium").alias("medium"),
        "channel_group",
        "device_category",
        "country",
        F.col("purchase_revenue").alias("revenue"),
    )


def _bursts(events: DataFrame, columns: list[str]) -> DataFrame:
    """One row per id and clock hour, tagged with its order; ``columns`` of its first event."""
    at = F.col("event_timestamp")
    merged = (
        usable_purchases(events)
        .groupBy("transaction_id", (at - F.pmod(at, F.lit(_HOUR_MICROS))).alias("hour_us"))
        .agg(
            F.min(at).alias("first_us"),
            F.max(at).alias("last_us"),
            F.count(F.lit(1)).alias("events"),
            F.min_by(F.struct(*columns), F.struct(*EVENT_ORDER)).alias("first"),
        )
    )
    per_id = Window.partitionBy("stem", "transaction_id")
    in_time = per_id.orderBy("hour_us")
    silence = whole_units(F.col("first_us"), F.lag("last_us").over(in_time), SECOND)
    gap = F.col("seconds_since_prev_event")
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        merged.withColumn("stem", order_stem(F.col("transaction_id")))
        .repartition("stem")  # serves the windows by id and, later, by key
        .withColumn("seconds_since_prev_event", silence)
        .withColumn("starts_order", gap.isNull() | (gap > MAX_GAP_SECONDS))
        .withColumn("order_cluster", F.sum(F.col("starts_order").cast("bigint")).over(so_far))
        .withColumn("order_key", _order_key(F.max("order_cluster").over(per_id)))
    )


def order_stem(transaction_id: Column) -> Column:
    """What ids share whose orders could get one key: an id without numbers of orders at its end."""
    return F.regexp_replace(transaction_id, r"(_c[0-9]+)+$", "")


def _order_key(clusters: Column) -> Column:
    txn = F.col("transaction_id")
    numbered = F.concat(txn, F.lit("_c"), F.col("order_cluster").cast("string"))
    return F.when(clusters == 1, txn).otherwise(numbered)
