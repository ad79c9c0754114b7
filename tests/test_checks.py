from __future__ import annotations

import pytest
from conftest import DAY, HOUR, MINUTE, SECOND, T0, only, values
from pyspark.sql import functions as F

from clickshop.operators import (
    dedupe_purchases,
    fct_order_items,
    fct_orders,
    mart_user_ltv,
    sessions,
    user_metrics,
)
from clickshop.plans import audit, checks, marts, profile
from clickshop.schemas import conforming


def at(micros: int):
    return F.timestamp_micros(F.lit(T0 + micros))


def relations(events) -> dict:
    deduped = dedupe_purchases(events)
    orders = fct_orders(deduped)
    visits = sessions(events, orders)
    users = user_metrics(visits)
    return {
        "stg_events": events,
        "int_purchase_events_deduped": deduped,
        "fct_orders": orders,
        "fct_order_items": fct_order_items(deduped),
        "int_sessions": visits,
        "int_user_metrics": users,
        "mart_user_ltv": mart_user_ltv(users),
        "mart_daily_performance": marts.mart_daily_performance(visits),
        "mart_funnel": marts.mart_funnel(visits),
        "mart_retention": marts.mart_retention(visits),
    }


@pytest.fixture
def sound(shop) -> dict:
    return relations(
        shop.events(
            {},
            {"name": "view_item", "at": 1},
            {"name": "purchase", "txn": "T", "revenue": 9.0, "items": [{}], "at": 2},
            {"user": "bob", "session": 4},
        )
    )


def test_sound_relations_pass_everything(sound):
    report = checks.check_report(sound)
    assert report.count() == 22
    assert report.where("status != 'pass' or violations != 0").count() == 0
    assert all(c.violations(sound).count() == 0 for c in checks.ALL_CHECKS)


def with_column(relation: str, column: str, value):
    # Columns can only be made once a session runs, so the value stays plain here.
    return lambda t: {**t, relation: t[relation].withColumn(column, F.lit(value))}


def emptied(relation: str):
    return lambda t: {**t, relation: t[relation].limit(0)}


def doubled(relation: str):
    return lambda t: {**t, relation: t[relation].union(t[relation])}


BROKEN = {
    "aov_not_negative": with_column("mart_daily_performance", "aov", -0.01),
    "orders_complete": emptied("fct_orders"),
    "funnel_rates_at_most_one": with_column("mart_funnel", "payment_to_purchase_rate", 1.01),
    "ltv_not_negative": with_column("mart_user_ltv", "total_revenue", -0.01),
    "orders_reconcile": emptied("fct_orders"),
    "retention_starts_at_one": with_column("mart_retention", "retention_rate", 0.99),
    "retention_within_bounds": with_column("mart_retention", "retention_rate", 1.01),
    "revenue_reconciles": with_column("fct_orders", "revenue", 10.01),
    "session_revenue_not_negative": with_column("int_sessions", "session_revenue", -0.01),
    "sessions_reconcile": doubled("int_sessions"),
    "user_revenue_reconciles": with_column("int_user_metrics", "total_revenue", 5.6),
    **{
        f"not_null_{relation}_{column}": with_column(relation, column, None)
        for relation, column in checks.REQUIRED_COLUMNS
    },
    **{
        f"unique_{relation}_{column}": doubled(relation)
        for relation, column in checks.UNIQUE_KEYS
    },
}


def test_every_check_has_a_broken_case():
    assert set(BROKEN) == {c.name for c in checks.ALL_CHECKS}


@pytest.mark.parametrize("name", BROKEN)
def test_check_fires(sound, name):
    change = BROKEN[name]
    (check,) = [c for c in checks.ALL_CHECKS if c.name == name]
    broken = change(sound)
    assert check.violations(broken).count() > 0
    report = only(checks.check_report(broken, [check]))
    assert report["status"] == "fail" and report["violations"] > 0


def test_totals_within_tolerance_pass(sound):
    (check,) = [c for c in checks.ALL_CHECKS if c.name == "revenue_reconciles"]
    near = {**sound, "fct_orders": sound["fct_orders"].withColumn("revenue", F.lit(10.0))}
    assert check.violations(near).count() == 0


def test_nothing_to_compare_passes(sound):
    (check,) = [c for c in checks.ALL_CHECKS if c.name == "orders_reconcile"]
    bare = {**sound, "int_sessions": sound["int_sessions"].limit(0)}
    assert check.violations(bare).count() == 0
    assert only(check.summary(bare))["violations"] == 0


def test_purchase_without_session_breaks_reconciliation(shop):
    built = relations(
        shop.events({}, {"name": "purchase", "txn": "T", "revenue": 5.0, "session": None})
    )
    failed = values(checks.check_report(built).where("status = 'fail'"), "check_name")
    assert failed == ["orders_reconcile", "revenue_reconciles", "user_revenue_reconciles"]
    assert only(profile.reconciliation(built["int_sessions"], built["fct_orders"])) == {
        "order_revenue": 5.0,
        "session_revenue": 0.0,
        "difference": -5.0,
    }


def test_two_numbers_of_a_session_break_uniqueness(shop):
    built = relations(shop.events({}, {"params": {"ga_session_number": 2}}))
    failed = values(checks.check_report(built).where("status = 'fail'"), "check_name")
    assert failed == ["unique_int_sessions_session_id"]


def audit_of(events, now):
    visits = sessions(events, fct_orders(dedupe_purchases(events)))
    mart = audit.mart_data_quality(events, visits, now)
    conforming(mart, "mart_data_quality")
    return {r.check_name: r for r in mart.collect()}


def test_audit_counts_and_statuses(shop):
    rows = audit_of(
        shop.events(
            {"name": "purchase", "txn": None, "revenue": 1.0},
            {"name": "purchase", "txn": "T", "revenue": -1.0},
            {"name": "purchase", "txn": "T", "revenue": 1.0},
            {"user": "bob", "at": 1441 * MINUTE},
            {"user": "bob"},
        ),
        at(1441 * MINUTE + 30 * MINUTE),
    )
    columns = ("issue_count", "issue_pct", "check_status", "status_sort")
    found = {name: tuple(row[c] for c in columns) for name, row in rows.items()}
    assert found == {
        "missing_transaction_id": (1, 33.33, "FAILED", 3),
        "duplicate_transaction_id_before_clustering": (1, 33.33, "WARNING", 2),
        "negative_revenue": (1, 33.33, "FAILED", 3),
        "high_event_sessions": (0, 0.0, "PASSED", 1),
        "impossible_duration": (1, 50.0, "FAILED", 3),
        "data_freshness": (0, None, "PASSED", 1),
    }


def test_audit_without_purchases_or_sessions(shop):
    rows = audit_of(shop.events({"session": None}), at(0))
    assert [rows[c].issue_pct for c in ("missing_transaction_id", "high_event_sessions")] == [
        None,
        None,
    ]
    assert {r.check_status for r in rows.values()} == {"PASSED"}


@pytest.mark.parametrize(
    ("hours", "status"), [(0, "PASSED"), (1, "WARNING"), (49, "WARNING"), (50, "ERROR")]
)
def test_audit_freshness(shop, hours, status):
    row = audit_of(shop.events({}), at(hours * HOUR))["data_freshness"]
    assert (row.issue_count, row.check_status) == (hours, status)


@pytest.mark.parametrize(
    ("age", "status"),
    [
        (23 * HOUR, "pass"),
        (24 * HOUR, "pass"),
        (24 * HOUR + SECOND, "warn"),
        (25 * HOUR, "warn"),
        (48 * HOUR, "warn"),
        (49 * HOUR, "error"),
    ],
)
def test_freshness(shop, age, status):
    row = only(audit.freshness(shop.events({}, {"at": -DAY}), at(age)))
    assert (row["freshness_status"], row["age_hours"]) == (status, age // HOUR)


def test_clock_is_the_default(shop):
    events = shop.events({})
    assert only(audit.freshness(events))["freshness_status"] == "error"
