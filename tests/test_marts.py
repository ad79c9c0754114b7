from __future__ import annotations

import datetime as dt

from conftest import DAY, MINUTE, SECOND, only, values

from clickshop.operators import dedupe_purchases, fct_order_items, fct_orders, sessions
from clickshop.plans import marts, profile
from clickshop.schemas import conforming


def sessions_of(events):
    return sessions(events, fct_orders(dedupe_purchases(events)))


def test_daily_performance(shop):
    visits = sessions_of(
        shop.events(
            {"user": "ann", "name": "first_visit"},
            {"user": "ann", "name": "purchase", "txn": "T1", "revenue": 1.0, "at": MINUTE},
            {"user": "ann", "session": 2, "at": SECOND},
            {"user": "bob", "name": "purchase", "txn": "T2", "revenue": 2.01},
        )
    )
    mart = marts.mart_daily_performance(visits)
    conforming(mart, "mart_daily_performance")
    row = only(mart)
    assert (row["sessions"], row["users"], row["orders"], row["revenue"]) == (3, 2, 2, 3.01)
    assert (row["session_cvr"], row["new_user_share"]) == (0.6667, 0.3333)
    assert (row["aov"], row["revenue_per_session"], row["arpu"]) == (1.51, 1.0, 1.51)


def test_daily_performance_without_orders(shop):
    row = only(marts.mart_daily_performance(sessions_of(shop.events({}))))
    assert (row["aov"], row["revenue"], row["session_cvr"]) == (None, 0.0, 0.0)


def test_funnel_rates_need_both_steps(shop):
    visits = sessions_of(
        shop.events(
            {"session": 1, "name": "view_item"},
            {"session": 1, "name": "add_to_cart"},
            {"session": 2, "name": "view_item"},
            {"session": 3, "name": "add_to_cart"},
            {"session": 3, "name": "begin_checkout"},
        )
    )
    mart = marts.mart_funnel(visits)
    conforming(mart, "mart_funnel")
    row = only(mart)
    assert (row["item_views"], row["carts"], row["checkouts"], row["payments"]) == (2, 2, 1, 0)
    assert (row["item_to_cart_rate"], row["cart_to_checkout_rate"]) == (0.5, 0.5)
    assert row["payment_to_purchase_rate"] is None


def test_landing_pages_take_the_first_page(shop):
    events = shop.events(
        {"name": "session_start"},
        {"at": 2, "params": {"page_location": "/b"}},
        {"at": 1, "params": {"page_location": "/a"}},
        {"name": "purchase", "txn": "T", "revenue": 4.0, "at": 3},
    )
    mart = marts.mart_landing_pages(events, sessions_of(events))
    conforming(mart, "mart_landing_pages")
    row = only(mart)
    assert (row["page_location"], row["sessions"], row["transactions"]) == ("/a", 1, 1)
    assert (row["revenue"], row["cvr"]) == (4.0, 1.0)


def test_pages_without_session_stay_with_unknown_outcome(shop):
    page = {"session": None, "params": {"page_location": "/a"}}
    events = shop.events(page, {**page, "at": 1}, {**page, "user": "bob"}, {"user": "eve"})
    row = only(marts.mart_landing_pages(events, sessions_of(events)))
    assert (row["sessions"], row["conversions"], row["cvr"]) == (2, 0, 0.0)
    assert row["transactions"] is None and row["revenue"] is None


def test_product_performance(shop):
    events = shop.events(
        *[
            {
                "name": "purchase",
                "txn": f"T{n}",
                "items": [
                    {"id": "a", "price": price, "quantity": 2, "revenue": 3.0},
                    {"id": "a", "price": None, "quantity": None, "revenue": None},
                ],
            }
            for n, price in enumerate([1.0, 2.0])
        ]
    )
    mart = marts.mart_product_performance(fct_order_items(dedupe_purchases(events)))
    conforming(mart, "mart_product_performance")
    row = only(mart)
    assert (row["transactions"], row["units_sold"], row["revenue"]) == (2, 4, 6.0)
    assert row["avg_price"] == 1.5


def test_retention_across_a_year_end(shop):
    events = shop.events(
        {"user": "ann", "session": 1, "date": "20231130"},
        {"user": "ann", "session": 2, "date": "20240131", "at": DAY},
        {"user": "ann", "session": 3, "date": "20240115", "at": 2 * DAY},
        {"user": "bob", "session": 1, "date": "20231101"},
        {"user": None, "session": 1, "date": "20231101"},
    )
    mart = marts.mart_retention(sessions_of(events))
    conforming(mart, "mart_retention")
    assert values(mart, "cohort_month", "month_number", "active_users", "retention_rate") == [
        (dt.date(2023, 11, 1), 0, 2, 1.0),
        (dt.date(2023, 11, 1), 2, 1, 0.5),
    ]
    assert set(values(mart, "source", "cohort_size")) == {("(unknown)", 2)}


def test_retention_month_before_the_first_session(shop):
    # The source's date of the later session lies in the month before.
    events = shop.events(
        {"session": 1, "date": "20240301"}, {"session": 2, "date": "20240229", "at": 1}
    )
    mart = marts.mart_retention(sessions_of(events))
    assert values(mart, "month_number", "retention_rate") == [(-1, 1.0), (0, 1.0)]


def test_suspicious_sessions_are_profiled_without_a_join(shop):
    busy = [{"at": n * 100_000} for n in range(205)]
    events = shop.events(*busy, {"name": "purchase", "txn": "T", "at": 1}, {"user": "bob"})
    assert values(profile.suspicious_event_mix(events), "event_name", "events", "sessions") == [
        ("page_view", 205, 1),
        ("purchase", 1, 1),
    ]
    row = only(profile.suspicious_peak_rate(events))
    assert list(row.values()) == [1, 1, 1, 11]


def test_orders_of_day_long_sessions_are_left_out_of_the_analysis(shop):
    events = shop.events(
        {"user": "ann"},
        {"user": "ann", "name": "purchase", "txn": "long", "at": 1440 * MINUTE},
        {"user": "bob", "name": "purchase", "txn": "short"},
        {"user": "eve", "name": "purchase", "txn": "none", "session": None},
    )
    orders = fct_orders(dedupe_purchases(events))
    kept = profile.revenue_analysis_orders(orders, sessions(events, orders))
    assert values(kept, "order_key") == ["short"]


def test_param_completeness_counts_null_and_empty_items(shop):
    events = shop.events(
        {"name": "add_to_cart", "items": None},
        {"name": "add_to_cart", "items": [{}]},
        {"name": "purchase", "items": []},
        {"name": "page_view"},
    )
    row = only(profile.param_completeness(events))
    assert list(row.values()) == [2, 1, 1, 1, 1, 1]


def test_heavy_buyers(shop):
    def order(user: str, n: int) -> dict:
        day = f"202403{1 + n // 31:02d}"
        return {"name": "purchase", "txn": f"{user}{n}", "user": user, "date": day}

    events = shop.events(
        *[order("ann", n) for n in range(32)], *[order("bob", n) for n in range(5)]
    )
    row = only(profile.heavy_buyers(fct_orders(dedupe_purchases(events))))
    assert (row["user_pseudo_id"], row["orders"], row["span_days"]) == ("ann", 32, 1)
    assert (row["max_orders_per_day"], row["over_30_in_a_day"]) == (31, True)


def test_shared_ids(shop):
    events = shop.events(
        {"name": "purchase", "txn": "S", "user": "ann"},
        {"name": "purchase", "txn": "S", "user": "bob", "at": DAY},
        {"name": "purchase", "txn": "own", "user": "bob"},
    )
    shared = profile.ids_shared_by_users(dedupe_purchases(events))
    assert values(shared, "transaction_id", "users") == [("S", 2)]


def test_groups_of_unknown_users_stay(shop):
    visits = sessions_of(
        shop.events(
            {"user": "ann"},
            {"user": None, "device": ("tv", "x", "en", "x"), "params": {"medium": "cpc"}},
        )
    )
    devices = profile.device_conversion(visits)
    assert values(devices, "device_category", "users", "buyers") == [("desktop", 1, 0), ("tv", 0, 0)]
    channels = profile.channel_arpu(visits)
    assert values(channels, "channel_group", "users") == [("Other", 1), ("Paid Search", 0)]


def test_category_totals_count_orders_and_products_once(shop):
    lines = [{"id": "a"}, {"id": "a", "position": "2"}, {"id": None, "category": None}]
    events = shop.events(
        {"name": "purchase", "txn": "T1", "items": lines},
        {"name": "purchase", "txn": "T2", "items": lines[:1], "at": SECOND},
    )
    totals = profile.category_totals(fct_order_items(dedupe_purchases(events)))
    assert "Expand" not in totals._jdf.queryExecution().executedPlan().toString()
    assert values(totals, "category_l1", "transactions", "skus", "revenue") == [
        ("Home", 2, 1, 15.0),
        (None, 1, 0, 5.0),
    ]
