from __future__ import annotations

import random

from conftest import DAY, HOUR, MINUTE, SECOND, T0, values
from pyspark.sql import functions as F

from clickshop.operators import (
    dedupe_purchases,
    event_gaps,
    fct_order_items,
    fct_orders,
    first_purchase_per_id,
    order_clusters,
    order_starts,
)
from clickshop.operators.orders import MAX_GAP_SECONDS, ORDER_INPUT
from clickshop.schemas import conforming


def buy(txn: str | None, at: int, **more) -> dict:
    return {"name": "purchase", "txn": txn, "at": at, "revenue": 1.0, **more}


def test_gap_decides_between_repeat_and_new_order(shop):
    events = shop.events(
        buy("same", 0),
        buy("same", 0),
        buy("hour", 0),
        buy("hour", HOUR),
        buy("nearly", 0),
        buy("nearly", HOUR + 999_999),
        buy("over", 0),
        buy("over", HOUR + SECOND),
    )
    assert values(dedupe_purchases(events), "order_key") == [
        "hour",
        "nearly",
        "over_c1",
        "over_c2",
        "same",
    ]


def test_chain_of_short_gaps_is_one_order(shop):
    events = shop.events(*[buy("T", n * 50 * MINUTE) for n in range(10)])
    assert values(dedupe_purchases(events), "order_key", "event_timestamp") == [("T", T0)]
    cluster = order_clusters(events).first()
    assert (cluster.purchase_events, cluster.order_cluster) == (10, 1)


def test_first_event_is_kept_with_the_silence_before_it(shop):
    events = shop.events(
        buy("T", 10 * MINUTE, revenue=2.0),
        buy("T", 5 * MINUTE, revenue=1.0),
        buy("T", 3 * DAY, revenue=4.0),
        buy("T", 3 * DAY + SECOND, revenue=3.0),
    )
    kept = values(
        dedupe_purchases(events), "order_key", "purchase_revenue", "seconds_since_prev_event"
    )
    assert kept == [("T_c1", 1.0, None), ("T_c2", 4.0, 3 * 86_400 - 600)]
    assert order_starts(events).count() == 2


def test_equal_times_are_settled_by_event_id(shop):
    events = shop.events(
        buy("T", 0, revenue=1.0, event_id=9), buy("T", 0, revenue=2.0, event_id=3)
    )
    assert values(dedupe_purchases(events), "purchase_revenue") == [2.0]


def test_users_sharing_an_id_within_the_hour_are_one_order(shop):
    events = shop.events(buy("T", 0, user="ann"), buy("T", MINUTE, user="bob"))
    assert values(dedupe_purchases(events), "order_key", "user_pseudo_id") == [("T", "ann")]


def test_id_spelled_like_a_numbered_key(shop):
    events = shop.events(buy("X", 0), buy("X", DAY), buy("X_c1", HOUR), buy("X_c2", 0))
    assert values(dedupe_purchases(events), "order_key", "transaction_id") == [
        ("X_c1", "X"),
        ("X_c2", "X_c2"),
    ]


def test_unusable_purchases_are_left_out(shop):
    events = shop.events(buy(None, 0), buy("(not set)", 0), {"name": "page_view", "txn": "T"})
    assert dedupe_purchases(events).count() == 0
    assert first_purchase_per_id(events).count() == 0


def test_simple_rule_keeps_one_event_per_id(shop):
    events = shop.events(buy("T", DAY, revenue=2.0), buy("T", 0, revenue=1.0))
    assert values(first_purchase_per_id(events), "purchase_revenue") == [1.0]


def test_order_without_session_has_no_session_id(shop):
    orders = fct_orders(dedupe_purchases(shop.events(buy("T", 0, session=None))))
    conforming(orders, "fct_orders")
    assert values(orders, "order_key", "session_id") == [("T", None)]


def test_against_brute_force_with_a_hot_id(shop):
    rng = random.Random(11)
    events = []
    for number in range(1_500):
        txn = "hot" if rng.random() < 0.4 else f"T{rng.randrange(40)}"
        at = rng.randrange(0, 40 * DAY, SECOND // 2)
        if rng.random() < 0.5:
            at = at // (90 * MINUTE) * (90 * MINUTE) + rng.choice([0, 1, HOUR, HOUR + SECOND])
        events.append(buy(txn, at, event_id=number))
    expected = []
    for txn in {e["txn"] for e in events}:
        own = sorted((T0 + e["at"], e["event_id"]) for e in events if e["txn"] == txn)
        starts = [
            (at, gap)
            for (at, _), gap in zip(
                own,
                [None, *[(b[0] - a[0]) // SECOND for a, b in zip(own, own[1:], strict=False)]],
                strict=True,
            )
            if gap is None or gap > MAX_GAP_SECONDS
        ]
        for cluster, (at, gap) in enumerate(starts, 1):
            key = txn if len(starts) == 1 else f"{txn}_c{cluster}"
            expected.append((key, txn, cluster, at, gap))
    staged = shop.events(*events).select(*ORDER_INPUT)
    found = values(
        dedupe_purchases(staged),
        "order_key",
        "transaction_id",
        "order_cluster",
        "event_timestamp",
        "seconds_since_prev_event",
    )
    assert found == sorted(expected, key=str)


def items_of(shop, *orders: list | None):
    events = [buy(f"T{n}", 0, items=items) for n, items in enumerate(orders)]
    return fct_order_items(dedupe_purchases(shop.events(*events)))


def test_orders_without_items_vanish(shop):
    lines = items_of(shop, [], None, [{"id": "a"}])
    conforming(lines, "fct_order_items")
    assert values(lines, "order_key", "item_id") == [("T2", "a")]


def test_items_rank_by_stored_position_then_id(shop):
    lines = items_of(
        shop,
        [
            {"id": "none", "position": None},
            {"id": "two", "position": "2"},
            {"id": "b", "position": "10"},
            {"id": "a", "position": "10"},
            {"id": None, "position": "10"},
        ],
    )
    assert values(lines, "item_rank", "item_id", "is_primary_item") == [
        (1, None, True),
        (2, "a", False),
        (3, "b", False),
        (4, "two", False),
        (5, "none", False),
    ]


def test_category_levels(shop):
    categories = [None, "", "Bags", "/Home/Apparel/Men/Shirts/", "Home//Hats"]
    lines = items_of(shop, [{"id": str(n), "category": c} for n, c in enumerate(categories)])
    assert values(lines, "item_id", "category_l1", "category_l2", "category_l3") == [
        ("0", None, None, None),
        ("1", "", None, None),
        ("2", "Bags", None, None),
        ("3", "Home", "Apparel", "Men"),
        ("4", "Home", "", "Hats"),
    ]


def test_item_quality_flags(shop):
    lines = items_of(
        shop,
        [
            {"id": "ok"},
            {"id": "free", "price": 0.0},
            {"id": "minus", "price": -1.0},
            {"id": "unknown", "price": None, "quantity": None, "revenue": None},
        ],
    )
    flags = ["flag_invalid_price", "flag_null_quantity", "flag_null_revenue"]
    assert values(lines, "item_id", *flags) == [
        ("free", True, False, False),
        ("minus", True, False, False),
        ("ok", False, False, False),
        ("unknown", True, True, True),
    ]


def test_text_prices_are_cast_safely(shop):
    deduped = dedupe_purchases(shop.events(buy("T", 0, items=[{"id": "a"}, {"id": "b"}])))
    text = deduped.withColumn(
        "items",
        F.transform(
            "items",
            lambda i: i.withField(
                "price", F.when(i["item_id"] == "a", F.lit("oops")).otherwise(F.lit("2.5"))
            ),
        ),
    )
    assert values(fct_order_items(text), "item_id", "item_price") == [("a", None), ("b", 2.5)]


def test_every_usable_purchase_has_its_gap(shop):
    events = shop.events(buy("T", 0), buy("T", 5 * SECOND), buy("U", SECOND), buy(None, 0))
    assert values(event_gaps(events), "transaction_id", "seconds_since_prev_event") == [
        ("T", 5),
        ("T", None),
        ("U", None),
    ]


def _hot_purchases(spark, rows: int):
    """Purchases of which every third has one id, in one second of one hour or spread."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(rows).select(
        n.alias("event_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("T"), n % 50)).alias("transaction_id"),
        F.when(n % 101 == 7, None).when(hot, n * 7 % 900_000).otherwise(n * n % 997 * SECOND).alias("event_timestamp"),
        F.lit(True).alias("is_purchase"),
        (n % 7 == 1).alias("flag_missing_txn_id"),
    )


def test_gaps_of_a_hot_id_over_many_slices(spark):
    events = _hot_purchases(spark, 20_000)
    last: dict[str, int | None] = {}
    expected = []
    rows = [r for r in events.collect() if not r.flag_missing_txn_id]
    by_time = lambda r: (r.event_timestamp is not None, r.event_timestamp or 0, r.event_id)
    for r in sorted(rows, key=by_time):
        at, before = r.event_timestamp, last.get(r.transaction_id)
        gap = None if at is None or before is None else (at - before) // SECOND
        expected.append((r.event_id, r.transaction_id, gap))
        last[r.transaction_id] = at
    found = event_gaps(events).select("event_id", "transaction_id", "seconds_since_prev_event")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_gaps_spread_a_hot_id_over_tasks(spark):
    gaps = event_gaps(_hot_purchases(spark, 60_000))
    sizes = sorted(r["count"] for r in gaps.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
