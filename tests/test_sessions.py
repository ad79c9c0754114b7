from __future__ import annotations

import datetime as dt

import pytest
from conftest import DAY, MINUTE, SECOND, only, values
from pyspark.sql import functions as F

from clickshop.operators import (
    dedupe_purchases,
    fct_orders,
    first_sessions,
    mart_user_ltv,
    sessions,
    user_metrics,
)
from clickshop.schemas import conforming


def sessions_of(events):
    return sessions(events, fct_orders(dedupe_purchases(events)))


def test_columns_and_types(shop):
    conforming(sessions_of(shop.events({})), "int_sessions")


def test_counters_and_reached_steps(shop):
    row = only(
        sessions_of(
            shop.events(
                {"name": "page_view", "params": {"engagement_time_msec": 61_000}},
                {"name": "view_item", "at": MINUTE, "params": {"session_engaged": "1"}},
                {"name": "add_to_cart", "at": 2 * MINUTE},
                {"name": "first_visit", "at": 2 * MINUTE},
                {"name": "purchase", "at": 3 * MINUTE, "txn": "T", "revenue": 5.5},
                {"name": "purchase", "at": 3 * MINUTE, "txn": "T", "revenue": 5.5},
            )
        )
    )
    assert row["session_id"] == "ann-1"
    assert (row["total_events"], row["pageviews"], row["engaged_events"]) == (6, 1, 1)
    assert (row["purchase_events_raw"], row["transaction_count"]) == (2, 1)
    assert (row["session_revenue"], row["engagement_minutes"]) == (5.5, 1.02)
    assert (row["reached_cart"], row["reached_checkout"], row["reached_purchase"]) == (1, 0, 1)
    assert row["converted"] and row["is_new_user"] and not row["is_bounce"]
    assert (row["session_quality"], row["duration_bucket"]) == ("normal", "1-5 min")


def test_without_orders_or_engagement(shop):
    row = only(sessions_of(shop.events({})))
    assert (row["transaction_count"], row["session_revenue"]) == (0, 0.0)
    assert row["total_engagement_msec"] is None and row["engagement_minutes"] is None
    assert row["is_bounce"]


def test_events_without_session_are_left_out(shop):
    assert sessions_of(shop.events({"session": None})).count() == 0


def test_first_touch_prefers_known_values_only_at_the_first_instant(shop):
    row = only(
        sessions_of(
            shop.events(
                {"event_id": 1, "params": {"medium": "cpc"}},
                {"event_id": 2, "params": {"source": "mail", "medium": "email"}},
                {"at": SECOND, "params": {"source": "late", "campaign": "late"}},
            )
        )
    )
    assert (row["source"], row["medium"], row["campaign"]) == ("mail", "cpc", None)


def test_an_event_without_a_time_hides_no_first_touch(shop):
    known = {"source": "mail", "medium": "email"}
    events = shop.events({"event_id": 1, "params": known}, {"event_id": 2, "params": {"source": "x"}})
    untimed = F.when(F.col("event_id") == 1, F.col("event_timestamp"))
    row = only(sessions_of(events.withColumn("event_timestamp", untimed)))
    assert (row["source"], row["medium"], row["device_category"]) == ("mail", "email", "desktop")


def test_first_sessions_of_some_columns(shop):
    visits = sessions_of(shop.events({}, {"session": 2, "at": SECOND}))
    assert values(first_sessions(visits, ["session_id"]), "session_id") == ["ann-1"]


def test_flags_count_null_as_not_met(shop):
    row = only(sessions_of(shop.events({"first": (None, None, None)})))
    assert (row["has_gdpr_deleted"], row["is_internal"]) == (False, False)


@pytest.mark.parametrize(
    ("length", "minutes", "bucket", "impossible"),
    [
        (MINUTE + 59 * SECOND, 1, "0-1 min", False),
        (2 * MINUTE, 2, "1-5 min", False),
        (15 * MINUTE, 15, "5-15 min", False),
        (30 * MINUTE, 30, "15-30 min", False),
        (1440 * MINUTE + 59 * SECOND, 1440, "30+ min", False),
        (1441 * MINUTE, 1441, "30+ min", True),
    ],
)
def test_duration_is_truncated(shop, length, minutes, bucket, impossible):
    row = only(sessions_of(shop.events({}, {"at": length})))
    assert row["session_duration_min"] == minutes
    assert row["duration_bucket"] == bucket
    assert row["is_impossible_duration"] is impossible
    assert row["session_quality"] == ("invalid" if impossible else "normal")


def test_many_events_are_suspicious(shop):
    row = only(sessions_of(shop.events(*[{"at": n} for n in range(201)])))
    assert row["is_high_event_session"] and not row["is_clean_session"]
    assert row["session_quality"] == "suspicious"


def test_two_numbers_of_one_session_both_get_its_revenue(shop):
    rows = sessions_of(
        shop.events(
            {"params": {"ga_session_number": 1}},
            {"params": {"ga_session_number": 2}},
            {"name": "purchase", "txn": "T", "revenue": 3.0},
        )
    )
    assert values(rows, "session_id", "session_number", "session_revenue") == [
        ("ann-1", 1, 3.0),
        ("ann-1", 2, 3.0),
    ]


def test_revenue_does_not_depend_on_addition_order(shop):
    amounts = [0.1, 0.2, 0.3, 1e9, -1e9, 0.7]
    for order in (amounts, amounts[::-1]):
        events = shop.events(
            *[
                {"name": "purchase", "txn": f"T{n}", "revenue": amount, "at": n}
                for n, amount in enumerate(order)
            ]
        )
        assert only(sessions_of(events))["session_revenue"] == 1.3


def test_user_metrics(shop):
    visits = sessions_of(
        shop.events(
            {"session": 1, "params": {"source": "a", "medium": "cpc"}},
            {"session": 1, "name": "purchase", "at": MINUTE, "txn": "T1", "revenue": 10.0},
            {"session": 1, "name": "purchase", "at": MINUTE, "txn": "T2", "revenue": 5.01},
            {"session": 2, "at": 5 * DAY, "date": "20240306", "params": {"source": "b"}},
            {"user": "bob", "geo": ("x", "Peru", "y", "Lima")},
        )
    )
    metrics = user_metrics(visits)
    conforming(metrics, "int_user_metrics")
    rows = {r.user_pseudo_id: r for r in metrics.collect()}
    ann, bob = rows["ann"], rows["bob"]
    assert (ann.total_sessions, ann.purchases, ann.converting_sessions) == (2, 2, 1)
    assert (ann.total_revenue, ann.avg_order_value, ann.active_days) == (15.01, 7.51, 5)
    assert (ann.source, ann.channel_group) == ("a", "Paid Search")
    assert ann.avg_session_duration == 0.5
    assert (bob.avg_order_value, bob.total_revenue, bob.country) == (None, 0.0, "Peru")
    assert mart_user_ltv(metrics).collect() == metrics.collect()


def test_first_session_ties_are_settled_by_session_id(shop):
    visits = sessions_of(shop.events({"session": 2}, {"session": 1}))
    assert values(first_sessions(visits), "session_id") == ["ann-1"]


def test_unknown_user_has_no_first_touch(shop):
    metrics = user_metrics(sessions_of(shop.events({"user": None})))
    row = only(metrics)
    assert row["user_pseudo_id"] is None and row["device_category"] is None
    assert row["first_seen"] is not None and row["total_sessions"] == 0


def test_session_date_follows_the_source_calendar(shop):
    row = only(sessions_of(shop.events({"date": "20240302"}, {"date": "20240229", "at": 1})))
    assert row["session_date"] == dt.date(2024, 2, 29)
