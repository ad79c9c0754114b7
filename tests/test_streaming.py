"""Orders as a stream of files against the batch result."""

from __future__ import annotations

import pytest
from conftest import DAY, HOUR, MINUTE, SECOND
from pyspark.sql import functions as F

from clickshop.operators import order_clusters, stage_events
from clickshop.operators.orders import MAX_GAP_SECONDS
from clickshop.streaming import order_stream, scan_event_stream

COLUMNS = ["transaction_id", "first_event_at", "last_event_at", "purchase_events"]


class Feed:
    """A folder that files are added to, and the runs that have come out of it."""

    def __init__(self, spark, shop, folder) -> None:
        self.spark, self.shop, self.folder = spark, shop, str(folder)
        self.given: list[dict] = []
        shop.raw().write.parquet(f"{self.folder}/in")
        self.dropped = 0
        self.lateness = "10 minutes"

    def add(self, *events: dict) -> None:
        rows = [{"event_id": len(self.given) + i, **e} for i, e in enumerate(events)]
        self.given += rows
        self.shop.raw(*rows).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        raw = scan_event_stream(self.spark, f"{self.folder}/in", with_event_id=True)
        runs = order_stream(stage_events(raw), self.lateness).writeStream.outputMode("append").format("parquet")
        query = runs.option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start(f"{self.folder}/out")
        assert query.awaitTermination(120)
        for step in query.recentProgress:
            self.dropped += sum(o["numRowsDroppedByWatermark"] for o in step["stateOperators"])

    def out(self) -> list:
        return sorted(map(tuple, self.spark.read.parquet(f"{self.folder}/out").select(*COLUMNS).collect()))

    def batch(self, without: tuple[str, ...] = ()) -> list:
        events = stage_events(self.shop.raw(*self.given)).where(~F.col("transaction_id").isin(*without))
        return sorted(map(tuple, order_clusters(events).select(*COLUMNS).collect()))


@pytest.fixture
def feed(spark, shop, tmp_path) -> Feed:
    return Feed(spark, shop, tmp_path)


def buy(txn: str | None, at: int) -> dict:
    return {"name": "purchase", "txn": txn, "at": at, "revenue": 1.0}


GAP = MAX_GAP_SECONDS * SECOND


def test_runs_equal_the_batch_result(feed):
    feed.lateness = "3 hours"
    # Just inside the gap, just outside, over several files, and a run joined in its middle.
    feed.add(buy("A", 0), buy("B", 0), buy("B", GAP + SECOND - 1), buy("C", 0), buy("C", GAP + SECOND), buy(None, 5))
    feed.add(buy("A", GAP), buy("D", GAP), buy("A", 2 * GAP + SECOND - 1), {"name": "view_item", "at": GAP})
    feed.add(buy("E", 3 * GAP), buy("E", 3 * GAP + 100 * MINUTE), buy("A", 3 * HOUR + 2 * SECOND - 1))
    feed.add(buy("E", 3 * GAP + 50 * MINUTE), buy("D", 5 * GAP))
    feed.add(buy("last", 10 * DAY))
    assert feed.out() == feed.batch(without=("last",))
    assert feed.dropped == 0


def test_late_rows_are_dropped_and_counted(feed):
    feed.add(buy("A", 0), buy("B", 5 * HOUR))
    feed.add(buy("A", 30 * MINUTE), buy("B", 5 * HOUR + MINUTE))  # the first run of A is out
    feed.add(buy("last", 10 * DAY))
    runs = {(r[0], r[3]) for r in feed.out()}
    assert runs == {("A", 1), ("B", 2)} and feed.dropped == 1


def test_open_runs_wait(feed):
    feed.add(buy("A", 0), buy("A", 10 * MINUTE))
    assert feed.out() == []
    feed.add(buy("A", 20 * MINUTE))
    feed.add(buy("last", DAY))
    assert [r[3] for r in feed.out()] == [3]
