"""Orders as a stream: runs of an id's purchases, kept as state until they cannot go on.

A session window joins events up to its gap, the gap included.  Whole seconds count, so one microsecond less than
the next second after ``MAX_GAP_SECONDS`` joins exactly the events that the batch rule joins.  Spark keeps open runs in its state store, merges runs that a late event
connects, and gives each run once, when the watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickshop.operators.orders import MAX_GAP_SECONDS, usable_purchases
from clickshop.schemas import RAW_EVENT

#: How late an event may come after the newest one.
LATENESS = "2 hours"
RUN_GAP = f"{MAX_GAP_SECONDS} seconds 999999 microseconds"


def scan_event_stream(spark: SparkSession, path: str, *, with_event_id: bool = False) -> DataFrame:
    """Raw events of a folder that ``write_events`` writes to, as files arrive."""
    schema = f"{RAW_EVENT}, event_id bigint" if with_event_id else RAW_EVENT
    return spark.readStream.schema(schema).parquet(path)


def order_stream(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Runs of usable purchases of each id, from a stream of staged events; append mode.

    Purchases without a time are left out, and those later than ``lateness`` are dropped, as their
    run may be out already.
    """
    at = F.col("event_at")
    return (
        usable_purchases(events)
        .select("transaction_id", "event_at")
        .where(at.isNotNull())
        .withWatermark("event_at", lateness)
        .groupBy("transaction_id", F.session_window(at, RUN_GAP))
        .agg(
            F.min(at).alias("first_event_at"),
            F.max(at).alias("last_event_at"),
            F.count(F.lit(1)).alias("purchase_events"),
        )
        .drop("session_window")
    )
